"""Casts, recodes, missing values and duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.values import recode, to_int
from starloom.operators.joins import broadcast_if_small
from starloom.session import scratch_path


def cast_columns(
    df: DataFrame, ints: Sequence[str] = (), doubles: Sequence[str] = (), texts: Sequence[str] = ()
) -> DataFrame:
    """Cast many columns in one projection; text that is no number becomes null."""
    casts: dict[str, Column] = {c: to_int(f"`{c}`") for c in ints}
    casts |= {c: F.col(f"`{c}`").try_cast("double") for c in doubles}
    casts |= {c: F.col(f"`{c}`").cast("string") for c in texts}
    return df.withColumns(casts)


def recode_columns(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """Apply one value mapping per column."""
    return df.withColumns({c: recode(c, mapping) for c, mapping in rules.items()})


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def drop_rows_missing_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the rows in which every one of ``columns`` is null or NaN."""
    return df.dropna("all", subset=list(columns))


def distinct_rows(df: DataFrame) -> DataFrame:
    """The distinct rows, where few repeat. Runs a job that shuffles a number for each row; rows whose number is no other's stay
    where they are, and only the others are shuffled in whole. Not for columns of maps or doubles.
    """
    marked = df.withColumn("_row", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    path = scratch_path(df.sparkSession, "repeated-rows")
    marked.groupBy("_row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_row").write.parquet(path)
    again = broadcast_if_small(df.sparkSession.read.schema("_row bigint").parquet(path))
    once = marked.join(again, "_row", "left_anti").select(*[f"`{c}`" for c in df.columns])
    return once.union(marked.join(again, "_row", "left_semi").select(*[f"`{c}`" for c in df.columns]).distinct())


def latest_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties broken by the other columns in turn.

    An aggregate, not a ranking window: each task reduces its own rows first, so a key holding a
    large part of the table sends one row per task and never gathers in one place.
    """
    rest = [c for c in df.columns if c not in key and c not in order_by]
    best = F.max(F.struct(*order_by, *rest)).alias("_best")
    picked = df.groupBy(*key).agg(best)
    return picked.select(
        *[F.col(c) if c in key else F.col("_best").getField(c).alias(c) for c in df.columns]
    )


def one_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key where no time tells which is newest: the smallest row in column order."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_best"))
    return picked.select(
        *[F.col(c) if c in key else F.col("_best").getField(c).alias(c) for c in df.columns]
    )


def distinct_values(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct values, null left out, found in any of ``columns`` (all of one type).

    One scan for all columns together; each task removes its own repeats before the shuffle.
    """
    values = df.select(F.explode(F.array(*[F.col(f"`{c}`") for c in columns])).alias(name))
    return values.where(F.col(name).isNotNull()).distinct()
