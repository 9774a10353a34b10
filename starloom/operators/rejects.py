"""Good and bad records of one scan: both are kept, and their numbers must add up to what was read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sinks.publish import file_system

OUTCOME, REASON, FILE, LINE = "_outcome", "_reason", "_file", "_line"
REJECT_SCHEMA = "file string, reason string, line string"


class RejectedError(Exception):
    """More records were rejected than the load allows."""


def lost_in_cast(raw: Column | str, typed: Column | str) -> Column:
    """A value was there that the cast could not take; blank text counts as none."""
    raw, typed = (F.col(c) if isinstance(c, str) else c for c in (raw, typed))
    return (F.trim(raw.cast("string")) != "") & typed.isNull()


def first_reason(rules: Mapping[str, Column]) -> Column:
    """The name of the first rule that holds, else null."""
    return F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules.items()], F.lit(None).cast("string"))


@dataclass(frozen=True)
class Split:
    """Where the records went. ``loaded`` and ``rejected`` are read from what was written."""

    loaded: DataFrame
    rejected: DataFrame
    n_read: int
    n_loaded: int
    n_rejected: int
    path: str | None = None  # the folder of both, if it holds nothing else

    def check(self, name: str, allowed: int) -> None:
        """Raise a :class:`RejectedError` that shows some of the records if there are too many."""
        if self.n_rejected > allowed:
            some = [f"{r.file}: {r.reason}: {r.line}" for r in self.rejected.limit(3).collect()]
            raise RejectedError(f"{name}: {self.n_rejected} of {self.n_read} records rejected, {allowed} allowed: {some}")

    def drop_loaded(self) -> None:
        """Delete the copy of the good rows once they stand in their table; the bad ones stay."""
        if self.path is not None:
            files, folder = file_system(self.loaded.sparkSession, f"{self.path}/{OUTCOME}=loaded")
            files.delete(folder, True)


def stored_split(spark: SparkSession, path: str, schema: T.StructType, counts: tuple[int, int, int]) -> Split:
    """The split that was written to ``path``."""
    kinds = T.StructType.fromDDL(f"{FILE} string, {REASON} string, {LINE} string")
    whole = spark.read.schema(T.StructType([*schema, *kinds, T.StructField(OUTCOME, T.StringType())])).parquet(path)
    rejected = whole.where(F.col(OUTCOME) == "rejected")
    return Split(
        whole.where(F.col(OUTCOME) == "loaded").select(*schema.fieldNames()),
        rejected.select(F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(LINE).alias("line")),
        *counts,
        path,
    )


def split_rejects(records: DataFrame, path: str) -> Split:
    """Write ``records``, which name their ``_file``, ``_line`` and the ``_reason`` of a rejection, in one scan.

    Good rows lose these three columns, bad ones all others. The counts come from the rows as they are written.
    """
    columns = [c for c in records.columns if c not in (FILE, LINE, REASON)]
    bad = F.col(REASON).isNotNull()
    kept = [F.when(~bad, F.col(f"`{c}`")).alias(c) for c in columns]
    told = [F.when(bad, F.col(c)).alias(c) for c in (FILE, REASON, LINE)]
    counted = Observation()
    out = records.select(*kept, *told, F.when(bad, "rejected").otherwise("loaded").alias(OUTCOME)).observe(
        counted,
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(F.col(OUTCOME) == "loaded").alias("n_loaded"),
        F.count_if(F.col(OUTCOME) == "rejected").alias("n_rejected"),
    )
    out.write.partitionBy(OUTCOME).parquet(path)
    n = counted.get
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in records.schema if f.name in columns])
    return stored_split(records.sparkSession, path, schema, (int(n["n_read"]), int(n["n_loaded"]), int(n["n_rejected"])))


def reject_checks(spark: SparkSession, splits: Mapping[str, Split], written: Mapping[str, int], allowed: int) -> DataFrame:
    """Report rows of the quality checks: records rejected, and records that are neither in the table nor rejected."""
    rows = []
    for name, s in splits.items():
        rows.append((name, "rejected", s.n_rejected, s.n_rejected <= allowed))
        missing = s.n_read - written[name] - s.n_rejected
        rows.append((name, "reconciled", missing, missing == 0))
    return spark.createDataFrame(rows, "table_name string, check_name string, value bigint, passed boolean")
