"""Documents in shards of bounded text, which ask about keys that may stand in other shards too.

A shard's number is a hash of the id. Each shard announces every key it holds once, so that a key of
a third of all documents is announced at most once per shard; a window over the key answers every
shard, and the answers come back to the documents by the shard's number. Spark reuses the
one shuffle of the documents for every round.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.text import release

SHARD = "_shard"
SHARD_BYTES = 4 << 20


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def sharded(docs: DataFrame, id_col: str, text_col: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents with the number of their shard; the number of shards follows the bytes of text."""
    n = max(1, -(-text_bytes(docs, text_col) // shard_bytes))
    return docs.withColumn(SHARD, F.pmod(F.xxhash64(F.lit("shard"), id_col), F.lit(n)))


def announce(shards: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """What ``work`` makes of the documents of one shard at a time."""

    def each(table):
        found = work(table)
        release()
        return found

    return shards.groupBy(SHARD).applyInArrow(each, schema)


def answer(shards: DataFrame, answers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str):
    """What ``work`` makes of the documents of one shard and the answers to it."""

    def each(table, answered):
        found = work(table, answered)
        release()
        return found

    return shards.groupBy(SHARD).cogroup(answers.groupBy(SHARD)).applyInArrow(each, schema)


def empty(schema: str) -> pa.Table:
    """No rows; the schema's names with types that Spark accepts."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}
    pairs = [p.rsplit(" ", 1) for p in schema.split(", ")]
    return pa.table({n.strip("`"): pa.array([], kinds[k]) for n, k in pairs})
