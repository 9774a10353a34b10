"""Column expressions. All are built-in Spark expressions; there is no Python UDF in the library."""
