"""Values over time: intervals in which a value held, and the value that held at a moment.

A key may hold a large part of all rows. Its rows are therefore cut by time into buckets that are worked on
apart; what goes from one bucket to the next is one row per key and bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "month"


def _bucket(ts: str, bucket: str) -> Column:
    return F.date_trunc(bucket, F.col(ts))


def validity_intervals(
    events: DataFrame, key: Sequence[str], values: Sequence[str], ts: str, *, bucket: str = BUCKET
) -> DataFrame:
    """One row per key and run of equal values: the key, the values, ``valid_from`` and ``valid_to``, which is null for
    the last run, else the start of the next one.

    Of several rows of a moment the greatest values count. Rows without a time are left out. Nulls are values.
    """
    value = F.struct(*values)
    known = events.where(F.col(ts).isNotNull()).groupBy(*key, F.col(ts).alias("_ts")).agg(F.max(value).alias("_value"))
    inside = Window.partitionBy(*key, "_bucket").orderBy("_ts")
    before = known.withColumn("_bucket", _bucket("_ts", bucket)).withColumn("_before", F.lag("_value").over(inside))
    # the first row of each bucket stays, as its bucket does not know the one before
    changes = before.where(F.col("_before").isNull() | ~F.col("_value").eqNullSafe(F.col("_before"))).drop("_before", "_bucket")
    whole = Window.partitionBy(*key).orderBy("_ts")
    marked = changes.withColumn("_before", F.lag("_value").over(whole))
    starts = marked.where(F.col("_before").isNull() | ~F.col("_value").eqNullSafe(F.col("_before")))
    return starts.select(
        *key, *[F.col("_value").getField(v).alias(v) for v in values], F.col("_ts").alias("valid_from"),
        F.lead("_ts").over(whole).alias("valid_to"),
    )


def value_then(
    events: DataFrame, history: DataFrame, key: Sequence[str], value: str, ts: str, valid_from: str = "valid_from", *,
    name: str, bucket: str = BUCKET,
) -> DataFrame:
    """``events`` with the column ``name``: the ``value`` of the last row of ``history`` at or before the event's time.

    Null where there is none, where the key is null, or where the event has no time. Both sides go through one window per key and
    bucket; a bucket starts from the last value of the buckets before it.
    """
    rows = events.select(*key, F.col(ts).alias("_ts"), F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("_row"))
    changes = history.where(F.col(valid_from).isNotNull()).select(*key, F.col(valid_from).alias("_ts"), F.struct(F.col(value).alias("v")).alias("_value"))
    rows, changes = (df.withColumn("_bucket", _bucket("_ts", bucket)) for df in (rows, changes))

    last = changes.groupBy(*key, "_bucket").agg(F.max_by("_value", "_ts").alias("_value"))
    wanted = rows.where(F.col("_bucket").isNotNull()).select(*key, "_bucket").distinct()
    earlier = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        last.unionByName(wanted.join(last, [*key, "_bucket"], "left_anti"), allowMissingColumns=True)
        .withColumn("_value", F.last("_value", ignorenulls=True).over(earlier))
        .where(F.col("_value").isNotNull())
    )
    # in the order of a moment: what the bucket starts from, changes, events
    both = (
        carried.withColumn("_kind", F.lit(0))
        .unionByName(changes.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(rows.withColumn("_kind", F.lit(2)), allowMissingColumns=True)
    )
    order = Window.partitionBy(*key, "_bucket").orderBy(F.col("_kind") != 0, "_ts", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_then", F.last("_value", ignorenulls=True).over(order)).where("_kind = 2")
    there = F.lit(True)
    for c in key:
        there &= F.col(c).isNotNull()
    then = F.when(there & F.col("_ts").isNotNull(), F.col("_then").getField("v"))
    return found.select("_row.*", then.alias(name))
