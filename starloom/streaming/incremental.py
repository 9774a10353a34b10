"""Stage only the files that no earlier run has seen."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.rejects import FILE, LINE, REASON, Split
from starloom.schemas import LOG_JSON
from starloom.sources.logs import checked_log, log_columns

BATCH_COLUMN = "batch_id"
STREAM_COLUMN = "stream_id"
ANY_AGE = "36500d"


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of what stands in a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


def _stream_id(spark: SparkSession, progress: str) -> str | None:
    """The id that a stream keeps in its checkpoint folder; None before its first run."""
    if "metadata" not in _names(spark, progress):
        return None
    lines = spark.read.text(f"{progress.rstrip('/')}/metadata").collect()
    return json.loads("".join(line.value for line in lines))["id"]


def stage_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    progress: str,
    schema: T.StructType | str,
    *,
    fmt: str = "json",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_batch: int | None = None,
    max_file_age: str = ANY_AGE,
    **options,
) -> int:
    """Load the files that are new in ``source`` since the last run, then stop; returns the rows added.

    ``progress`` is the stream's checkpoint folder; its id is part of the names below ``target``. Each
    batch overwrites its own folder ``target/stream_id=.../batch_id=N``: a batch that is repeated after a
    failure replaces what it wrote before, so no row is staged twice. A target that holds batches
    of another stream is refused: with a new ``progress`` folder all files would be staged once more.

    ``max_files_per_batch`` cuts a large backlog into several batches. A file counts as new however old
    it is, unless ``max_file_age`` says otherwise. The list of files seen grows with the source;
    ``cleanSource="archive"`` with ``sourceArchiveDir`` keeps it short.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    reader = reader.options(**{"maxFileAge": max_file_age, **options})
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    rows = reader.load(source)
    if transform is not None:
        rows = transform(rows)

    base = target.rstrip("/")
    stream = _stream_id(spark, progress)
    others = [
        n
        for n in _names(spark, base)
        if n.startswith((f"{STREAM_COLUMN}=", f"{BATCH_COLUMN}=")) and n != f"{STREAM_COLUMN}={stream}"
    ]
    if others:
        raise ValueError(f"{target} holds batches of another stream: {others}")
    added = 0

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal added
        # a batch that returns counts as done, so whatever goes wrong here has to raise
        own = stream or _stream_id(spark, progress)
        if own is None:
            raise RuntimeError(f"{progress} does not name its stream")
        counted = Observation()
        batch.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
            f"{base}/{STREAM_COLUMN}={own}/{BATCH_COLUMN}={batch_id}"
        )
        added += int(counted.get["n"])

    query = (
        rows.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return added


def stage_new_logs(spark: SparkSession, source: str, target: str, progress: str, **options) -> int:
    """:func:`stage_new_files` for the activity log, in any depth of folders. Lines that are rejected are
    staged too, with their text and the reason.
    """
    return stage_new_files(
        spark,
        source,
        target,
        progress,
        "value string",
        fmt="text",
        transform=checked_log,
        **{"recursiveFileLookup": True, **options},
    )


def staged_log(spark: SparkSession, target: str) -> Split:
    """The good and the bad lines of everything staged so far."""
    good = spark.createDataFrame([], LOG_JSON).select(*log_columns()).schema
    told = T.StructType.fromDDL(f"{FILE} string, {LINE} string, {REASON} string")
    staged = read_staged(spark, target, T.StructType([*good, *told]))
    n, bad = staged.agg(F.count(F.lit(1)), F.count(REASON)).first()
    rejected = staged.where(F.col(REASON).isNotNull())
    return Split(
        staged.where(F.col(REASON).isNull()).select(*good.fieldNames()),
        rejected.select(F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(LINE).alias("line")),
        n, n - bad, bad,
    )


def read_staged(
    spark: SparkSession, target: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Everything staged so far, without the numbers of stream and batch.

    With ``schema``, that of the staged rows, a target that no run has filled yet has no rows.
    """
    reader = spark.read
    if schema is not None:
        if not _names(spark, target):
            return spark.createDataFrame([], schema)
        declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        reader = reader.schema(declared)
    return reader.parquet(target).drop(BATCH_COLUMN, STREAM_COLUMN)
