"""Session settings the library relies on, and the shared folder it may write scratch data to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Timestamps carry no zone, so the session zone only has to be fixed; adaptive execution picks
# partition counts, join strategies and skew splits from the sizes it measures.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_MB = 1024 * 1024
_MAX_SHUFFLE_PARTITIONS = 50_000
_MAX_SCAN_TASKS = 200_000


def sized_conf(scanned_bytes: int, shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Partition settings for a job of known size.

    Adaptive execution merges shuffle partitions that turn out small but splits a large one only
    if it is skewed, so there must be enough to begin with: about 256 MB each, which a task sorts
    in memory, and two per core. Past 50,000 the bookkeeping for every pair of map and reduce task
    costs more than somewhat larger partitions, which spill. Scans get 128 MB splits, or larger
    ones where that would be more than 200,000 tasks (100 TB: 500 MB).
    """
    partitions = max(2 * cores, -(-shuffled_bytes // (256 * _MB)))
    split = max(128 * _MB, -(-scanned_bytes // _MAX_SCAN_TASKS))
    return {
        "spark.sql.shuffle.partitions": str(min(_MAX_SHUFFLE_PARTITIONS, partitions)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * _MB),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def build_session(app: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            conf = {"spark.ui.enabled": "false", **conf}
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="starloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/starloom/{label}-{uuid.uuid4().hex}"
