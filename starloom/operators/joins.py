"""Left joins that stand up to null and hot keys, and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import scratch_path

# Spark refuses to broadcast above 8 GB; a dimension far below that fits every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's upper estimate of the frame's size; None where the session does not tell."""
    plan = getattr(df, "_jdf", None)  # absent in a remote session
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if its estimated size is within ``limit``.

    Otherwise it is returned as it is: the join then shuffles, and adaptive execution splits
    partitions that turn out too large. File sizes are those on disk, hence a low limit.
    """
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df


def find_hot_keys(df: DataFrame, key: Sequence[str], min_rows: int) -> DataFrame:
    """Keys that occur in at least ``min_rows`` rows, stored in the shared folder. Runs a job.

    At most (rows / min_rows) keys can qualify. They are stored so that a join knows their true size
    and broadcasts them only if it is small.
    """
    known = df.where(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in key]))
    counts = known.groupBy(*[f"`{c}`" for c in key]).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") >= min_rows).drop("_n")
    path = scratch_path(df.sparkSession, "hot-keys")
    hot.write.parquet(path)
    return df.sparkSession.read.schema(hot.schema).parquet(path)


def _flag_hot(df: DataFrame, key: Sequence[str], hot: DataFrame) -> DataFrame:
    """Adds _hot: true where the key stands in ``hot``, whose columns are in the order of ``key``."""
    names = [f"_hot_{i}" for i in range(len(key))]
    marked = broadcast_if_small(hot.toDF(*names).withColumn("_hot", F.lit(True)))
    matches = reduce(
        lambda a, b: a & b, [df[f"`{c}`"] == marked[n] for c, n in zip(key, names, strict=True)]
    )
    return df.join(marked, matches, "left").drop(*names)


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    *,
    spread_by: Sequence[str] = (),
    salts: int = 1,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left outer equi-join on ``{left column: right column}``; every match and every left row is kept.

    * Left rows with a null key match nothing, but would all be shuffled to one task. Given
      ``spread_by``, columns that tell rows apart, their hash joins the key and scatters these rows over all
      tasks.
    * A hot key is split by adaptive execution at run time. Where that is off or too late,
      ``salts`` > 1 splits left keys over that many tasks and repeats their right rows as often:
      only the keys in ``hot`` (see :func:`find_hot_keys`), or all of them without it. Such a join is always
      shuffled: Catalyst estimates the right side without its repeats and would broadcast it through the driver.

    The numbers depend on the row alone, so a recomputed task sends each row to the same place as
    before. Name only ``spread_by`` columns that the result needs anyway: they are read.
    """
    if not spread_by:
        if salts > 1:
            raise ValueError("salts need spread_by columns")
        condition = reduce(
            lambda a, b: a & b, [left[f"`{lk}`"] == right[f"`{rk}`"] for lk, rk in on.items()]
        )
        return left.join(right, condition, "left")

    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in spread_by])
    null_key = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in on])
    # With one salt the number is 0 on both sides. It is still computed from the row: a constant
    # would be folded out of the join key and the null rows would meet again in one task.
    left_number = F.pmod(row_hash, F.lit(salts))
    key_hash = F.xxhash64(*[F.col(f"`{c}`") for c in on.values()])
    zero = F.pmod(key_hash, F.lit(1))
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    right_number = F.explode(every_salt) if salts > 1 else zero
    if hot is not None and salts > 1:
        left = _flag_hot(left, list(on), hot)
        right = _flag_hot(right, list(on.values()), hot)
        left_number = F.when(F.col("_hot"), left_number).otherwise(F.pmod(row_hash, F.lit(1)))
        right_number = F.explode(F.when(F.col("_hot"), every_salt).otherwise(F.array(zero)))

    left_side = left.withColumn("_part", F.when(null_key, row_hash).otherwise(left_number)).drop("_hot")
    right_side = right.withColumn("_right_part", right_number).drop("_hot")
    if salts > 1:
        right_side = right_side.hint("merge")
    condition = left_side["_part"] == right_side["_right_part"]
    for left_key, right_key in on.items():
        condition = condition & (left_side[f"`{left_key}`"] == right_side[f"`{right_key}`"])
    return left_side.join(right_side, condition, "left").drop("_part", "_right_part")


def star_join(
    fact: DataFrame, *dimensions: tuple[DataFrame, str, str], spread_by: Sequence[str] = ()
) -> DataFrame:
    """Left-join a fact to dimensions given as ``(dimension, fact column, dimension key)``.

    Small dimensions are broadcast. For the others the fact is shuffled, and ``spread_by`` scatters
    its rows without a code as in :func:`left_join`.
    """
    for dimension, foreign_key, key in dimensions:
        side = broadcast_if_small(dimension)
        spread = spread_by if side is dimension else ()
        fact = left_join(fact, side, {foreign_key: key}, spread_by=spread)
    return fact


def orphans(fact: DataFrame, foreign_key: str, dimension: DataFrame, key: str) -> DataFrame:
    """Fact codes that the dimension lacks, with the number of fact rows of each.

    The fact is reduced to its distinct codes before anything is joined. Null codes are not orphans.
    """
    codes = (
        fact.where(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("code"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = dimension.select(F.col(key).alias("_known"))
    return codes.join(known, codes["code"] == known["_known"], "left_anti")
