"""Dense surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.session import scratch_path

# About 250 bytes per file: the offsets of this many files fit every executor.
BROADCAST_FILES = 250_000


def number_stored_rows(stored: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Number the rows of a frame that is read straight from Parquet files: start, start + 1, ...

    A row's number is its position in its file plus the rows of the files before. Nothing is sorted
    or shuffled, and a task that is run again finds the same numbers. The rows per file come from
    the file footers; that table has one row per file, so putting it in order takes one small task.
    """
    placed = stored.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    if len(stored.inputFiles()) <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, "_file").select(
        (F.col("_offset") + F.col("_row") + F.lit(start)).alias(name),
        *[f"`{c}`" for c in stored.columns],
    )


def with_dense_id(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Number the rows of any frame start, start + 1, ... without a gap.

    The frame is written once to the shared folder, which fixes the order of its rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    df.write.parquet(path)
    return number_stored_rows(spark.read.schema(df.schema).parquet(path), name, start)
