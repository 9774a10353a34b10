"""Tables stored by the hash of a key, so that two of them join on it without moving a row.

All rows of a key are in one bucket, hence a key with very many rows would make one bucket, and the one task that joins
it, as large as that key. Rows of such hot keys, and rows without a key, are therefore stored apart, in a partition of
their own: :func:`bucketed_left_join` reads them in ordinary splits and joins them to the few rows of the other
table that they can match.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.joins import broadcast_if_small, find_hot_keys, left_join
from starloom.session import scratch_path
from starloom.sinks.publish import new_version, switch_partitions
from starloom.sinks.tables import drop_table, table_location

APART = "_apart"
BUCKET_BYTES = 64 << 20  # of values; a task that sorts them takes about five times as much
APART_ROWS = 2_000_000  # a key of so many rows in a bucket twice as large is stored apart in any case


def bucket_count(df: DataFrame, least: int = 1) -> int:
    """Buckets for a table, or the larger of two that share a key, so that one is a task's work whatever their size. Runs a job.

    Values count eight bytes, text its own length as well.
    """
    long = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    row = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c in long], F.lit(8 * len(df.columns)).cast("long"))
    return max(least, -(-(df.agg(F.sum(row)).first()[0] or 0) // BUCKET_BYTES))


def _unknown(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])


def _marked(df: DataFrame, key: Sequence[str], hot_rows: int | None) -> DataFrame:
    """Adds the column that tells rows to be stored apart."""
    if hot_rows is None:
        return df.withColumn(APART, _unknown(key))
    hot = find_hot_keys(df, key, hot_rows)
    names = [f"_hot_{i}" for i in range(len(key))]
    listed = broadcast_if_small(hot.toDF(*names).withColumn("_listed", F.lit(True)))
    same = reduce(lambda a, b: a & b, [df[f"`{c}`"] == listed[n] for c, n in zip(key, names, strict=True)])
    marked = df.join(listed, same, "left").withColumn(APART, _unknown(key) | F.col("_listed").isNotNull())
    return marked.drop(*names, "_listed")


def load_bucketed(
    df: DataFrame, table: str, key: Sequence[str], n_buckets: int, *, location: str, hot_rows: int | None = None
) -> int:
    """Load ``df`` into ``table``, stored in ``n_buckets`` buckets by ``key``; returns the rows written.

    The table is created at the first load. Later ones must name the same key and buckets; they replace the rows, readers see
    the old ones or the new. Keys of at least ``hot_rows`` rows, which are counted, are stored apart; without it, those that
    alone would be too much for a task. :func:`bucket_count` tells how many buckets a table needs.
    """
    reserved = [c for c in df.columns if c.lower() == APART]
    if reserved:
        raise ValueError(f"the column {APART} is added by the load")
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    names = ", ".join(f"`{c}`" for c in key)
    if not spark.catalog.tableExists(table):
        spark.sql(
            f"CREATE TABLE {table} ({columns}, `{APART}` boolean) USING parquet PARTITIONED BY (`{APART}`) "
            f"CLUSTERED BY ({names}) INTO {int(n_buckets)} BUCKETS LOCATION '{location}'"
        )
    elif bucket_spec(spark, table) != (tuple(key), n_buckets):
        raise ValueError(f"{table} is stored by {bucket_spec(spark, table)}")
    elif [(f.name, f.dataType) for f in spark.table(table).drop(APART).schema] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{table} has other columns")
    bucket = F.pmod(F.hash(*[F.col(f"`{c}`") for c in key]), F.lit(n_buckets))
    if hot_rows is None:
        known = df.where(~_unknown(key)).groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
        hot_rows = APART_ROWS if (known.agg(F.max("n")).first()[0] or 0) > 2 * APART_ROWS else None
    marked = _marked(df, key, hot_rows)
    row = F.xxhash64(*[f"`{c}`" for c, t in df.dtypes if not t.startswith("map")])
    # One task writes a bucket, as one file; rows stored apart go to all tasks, by their own hash.
    laid_out = marked.repartitionById(n_buckets, F.when(F.col(APART), F.pmod(row, F.lit(n_buckets))).otherwise(bucket).cast("int"))
    written = Observation()
    counted = laid_out.observe(written, F.count(F.lit(1)).alias("n"))
    folder = new_version(table_location(spark, table))
    database, _, _ = table.rpartition(".")
    staged = f"{database + '.' if database else ''}load_{uuid.uuid4().hex}"
    try:
        writer = counted.write.format("parquet").partitionBy(APART).bucketBy(n_buckets, *key).sortBy(*key)
        writer.option("path", folder).saveAsTable(staged)
        switch_partitions(spark, table, [APART], folder, drop_others=True)
    finally:
        drop_table(spark, staged)  # the folder stays: it is not the catalog's own
    return int(written.get["n"])


def bucket_spec(spark: SparkSession, table: str) -> tuple[tuple[str, ...], int]:
    """The key and the number of buckets that a table is stored by; no key and 0 if it has none."""
    listed = spark.catalog.listColumns(table)
    key = tuple(c.name for c in listed if c.isBucket)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    return key, int(described[-1]["data_type"]) if described else 0


def bucketed_left_join(spark: SparkSession, left: str, right: str, on: Mapping[str, str], *, spread_by: Sequence[str]) -> DataFrame:
    """Left outer join of two tables that :func:`load_bucketed` has stored, on the keys they are stored by.

    Rows in buckets are joined where they are stored, without an exchange. Left rows stored apart are joined to the right rows of their
    keys, which are looked up first: a broadcast if these are few, else a shuffle that ``spread_by`` scatters null keys
    in. Every match and every left row is kept. A right key with very many rows makes its bucket large: put the
    table whose keys repeat on the left.
    """
    specs = bucket_spec(spark, left), bucket_spec(spark, right)
    if specs[0][0] != tuple(on) or specs[1][0] != tuple(on.values()) or specs[0][1] != specs[1][1]:
        raise ValueError(f"{left} and {right} are stored by {specs[0]} and {specs[1]}, not alike by {dict(on)}")
    rows, others = spark.table(left), spark.table(right).drop(APART)
    kinds = [(rows.schema[a].dataType, others.schema[b].dataType) for a, b in on.items()]
    if any(a != b for a, b in kinds):
        raise ValueError(f"keys of other types do not share buckets: {kinds}")
    shared = {c.lower() for c in rows.columns} & {c.lower() for c in others.columns}
    if shared:
        raise ValueError(f"columns of both tables: {sorted(shared)}")

    even = rows.where(~F.col(APART)).drop(APART)
    same = reduce(lambda a, b: a & b, [even[f"`{a}`"] == others[f"`{b}`"] for a, b in on.items()])
    joined = even.join(others, same, "left")

    apart = rows.where(APART).drop(APART)
    keys = apart.where(~_unknown(list(on))).select(*[F.col(f"`{c}`").alias(f"_key_{i}") for i, c in enumerate(on)]).distinct()
    path = scratch_path(spark, "keys-apart")
    keys.write.parquet(path)
    keys = broadcast_if_small(spark.read.schema(keys.schema).parquet(path))
    wanted = reduce(lambda a, b: a & b, [others[f"`{c}`"] == keys[f"_key_{i}"] for i, c in enumerate(on.values())])
    path = scratch_path(spark, "rows-apart")
    others.join(keys, wanted, "left_semi").write.parquet(path)
    few = broadcast_if_small(spark.read.schema(others.schema).parquet(path))
    return joined.union(left_join(apart, few, on, spread_by=spread_by))
