"""Grouped aggregations over many columns at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def min_per_key(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(*[F.min(c).alias(c) for c in columns])


def sum_per_key(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(*[F.sum(c).alias(c) for c in columns])


def avg_per_key(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(*[F.avg(c).alias(c) for c in columns])


def sum_where(value: str | Column, by: str | Column, values: Mapping[str, str]) -> list[Column]:
    """Pivot as aggregate columns: ``{value of by: output column}``, null where there is no row.

    Lets a pivot share one grouping with other aggregates. The values are given, so no job is
    needed to find them, and every column is there even if no row has its value.
    """
    by = F.col(by) if isinstance(by, str) else by
    value = F.col(value) if isinstance(value, str) else value
    return [F.sum(F.when(by == v, value)).alias(name) for v, name in values.items()]


def pivot_sum(
    df: DataFrame, key: Sequence[str], by: str, values: Mapping[str, str], value: str
) -> DataFrame:
    """One column per listed value of ``by``, holding the sum of ``value``.

    One shuffle; the built-in pivot groups by key and value first and then by key again.
    """
    return df.groupBy(*key).agg(*sum_where(value, by, values))
