"""Profiles that add up: counts and sketches of every column by month, merged without the rows.

Distinct values and quantiles of a table cannot be added up, sketches of them can. Each month keeps one
row per column: counts, a HyperLogLog sketch of its values and, for numbers, a quantile sketch. A month that is
loaded again replaces its own rows; the profile of any span of months is a merge of a few kilobytes each. Values
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.values import is_missing

LOG_BUCKETS = 14
# Distinct counts are off by less than this share of the true ones, 997 times of 1000: three standard errors.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_BUCKETS / 2)
QUANTILE_SIZE = 400
RANK_ERROR = 0.01  # quantiles: the share of rows between the true place of a value and the one asked for


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def column_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per value of ``by`` and column: ``column_name``, ``n_rows``, ``n_missing``, ``distinct_sketch``, ``quantile_sketch``.

    One grouping by ``by``; null and NaN are missing and in no sketch.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    chosen = [c for c in (columns if columns is not None else df.columns) if c not in by]

    def parts(name: str) -> Column:
        c, kind = F.col(f"`{name}`"), kinds[name]
        there = F.when(~is_missing(name, kind), c)
        value = there.cast("bigint") if isinstance(kind, T.IntegralType) else there.cast("string")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(is_missing(name, kind)).alias("n_missing"),
            F.hll_sketch_agg(value, F.lit(LOG_BUCKETS)).alias("distinct_sketch"),
            (F.kll_sketch_agg_double(there.cast("double"), F.lit(QUANTILE_SIZE)) if _numeric(kind) else F.lit(None).cast("binary")).alias("quantile_sketch"),
        )

    grouped = df.groupBy(*by).agg(F.array(*[parts(c) for c in chosen]).alias("_columns"))
    return grouped.select(*by, F.explode("_columns").alias("c")).select(*by, "c.*")


def merged_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """One row per column over all rows of ``sketches``: counts, about how many distinct values, and quantiles of numbers.

    Quantiles of a column without a number are null.
    """
    merged = sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("_kll"), F.count("quantile_sketch").alias("_numeric"),
    )
    some = (F.col("_numeric") > 0) & (F.col("n_missing") < F.col("n_rows"))
    found = [F.when(some, F.kll_sketch_get_quantile_double("_kll", F.lit(float(q)))).alias(f"q{q:g}") for q in quantiles]
    return merged.select("column_name", "n_rows", "n_missing", "n_distinct", *found)
