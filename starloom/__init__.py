"""Star schemas on Spark: read raw files, build facts and dimensions, load and check them."""

__version__ = "0.1.0"
