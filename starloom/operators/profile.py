"""Missing values, duplicates and missing keys, each counted in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.values import is_missing


def missing_counts(df: DataFrame) -> DataFrame:
    """One row: the number of null or NaN values of every column, under its own name."""
    return df.agg(*[F.count_if(is_missing(f.name, f.dataType)).alias(f.name) for f in df.schema])


def missing_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, missing values, rows, missing share in percent."""
    total = "_total_rows"
    wide = df.agg(
        F.count(F.lit(1)).alias(total),
        *[F.count_if(is_missing(f.name, f.dataType)).alias(f.name) for f in df.schema],
    )
    long = wide.unpivot([total], [f"`{c}`" for c in df.columns], "column_name", "missing")
    return long.select(
        "column_name",
        "missing",
        F.col(total).alias("n_rows"),
        (F.try_divide(F.col("missing").cast("double"), F.col(total).cast("double")) * 100).alias(
            "missing_percent"
        ),
    )


def sparse_columns(df: DataFrame, threshold_percent: float = 85.0) -> list[str]:
    """Names of the columns with more than the given share missing. Runs one job."""
    over = missing_profile(df).where(F.col("missing_percent") > threshold_percent)
    found = {row["column_name"] for row in over.select("column_name").collect()}
    return [c for c in df.columns if c in found]


def drop_sparse_columns(df: DataFrame, threshold_percent: float = 85.0) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold_percent))


def duplicate_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and how many rows go when one per key is kept."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias("n_duplicates"),
    )


def missing_key_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, and rows in which every key column is missing."""
    types = {f.name: f.dataType for f in df.schema}
    all_missing = reduce(lambda a, b: a & b, [is_missing(c, types[c]) for c in key])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(all_missing).alias("n_missing_key")
    )


def table_profile(df: DataFrame, key: Sequence[str], required: Sequence[str]) -> DataFrame:
    """One row: rows, duplicates on ``key``, rows in which all ``required`` columns are missing.

    Grouping by the key carries the missing rows along, so the table is read and shuffled once.
    """
    types = {f.name: f.dataType for f in df.schema}
    all_missing = reduce(lambda a, b: a & b, [is_missing(c, types[c]) for c in required])
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(all_missing).alias("_missing")
    )
    rows = F.coalesce(F.sum("_n"), F.lit(0))
    return per_key.agg(
        rows.alias("n_rows"),
        (rows - F.count(F.lit(1))).alias("n_duplicates"),
        F.coalesce(F.sum("_missing"), F.lit(0)).alias("n_missing_key"),
    )
