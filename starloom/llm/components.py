"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lost executors take nothing with them."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least of u and all its neighbours in these edges."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id in an edge of (``a``, ``b``), smallest ones excepted.

    Every round hangs nodes on the smallest neighbour they know, without ever listing a
    component in one place; the number of rounds grows with the logarithm of the longest path.
    """
    graph = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    while True:
        both = graph.union(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = _least(large)
        small = least.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        graph = stored(small, "components")
        now = graph.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return graph.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = now


def joined_components(found: DataFrame, edges: DataFrame) -> DataFrame:
    """The components of :func:`components` after some more edges: only their components are gone through once more."""
    for side in ("a", "b"):
        label = found.select(F.col("id").alias(side), F.col("component").alias("_to"))
        edges = edges.join(label, side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
    above = components(edges)
    to = above.select(F.col("id").alias("component"), F.col("component").alias("_to"))
    moved = found.join(to, "component", "left").select("id", F.coalesce("_to", "component").alias("component"))
    return stored(moved.union(above), "components")


MAX_BROADCAST_IDS = 2_000_000  # a list of ids is broadcast up to this counted length, about 32 MB


def broadcast_if_few(ids: DataFrame, limit: int = MAX_BROADCAST_IDS) -> DataFrame:
    """The stored list of ids, marked for a broadcast if its rows, which are counted, are few."""
    return F.broadcast(ids) if ids.count() <= limit else ids
