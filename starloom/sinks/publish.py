"""Versioned loads: rows go to a folder of their own, and only then does the table point at it.

Until a load is through, readers see the rows of the one before; a load that fails changes nothing that they
see. One statement switches an unpartitioned table, one each partition of a partitioned one.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

_VERSION = re.compile(r"^(.*)\.versions/v-(\d+)-[0-9a-f]+(?:/.*)?$")


def base_folder(location: str) -> str:
    """The folder that a table had when it was created, whatever version it points at now."""
    found = _VERSION.match(location.rstrip("/"))
    return found.group(1) if found else location.rstrip("/")


def new_version(location: str) -> str:
    """A new, unused folder for one load of the table at ``location``; names grow with time."""
    return f"{base_folder(location)}.versions/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def file_system(spark: SparkSession, folder: str):
    """Hadoop's file system of a folder, and the folder as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _unescaped(spark: SparkSession, text: str) -> str | None:
    catalog = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return None if text == "__HIVE_DEFAULT_PARTITION__" else catalog.unescapePathName(text)


Values = tuple[str | None, ...]


def partition_folders(spark: SparkSession, folder: str, columns: Sequence[str]) -> dict[Values, str]:
    """The folder of every partition that was written below ``folder``, by the text of its values."""
    files, path = file_system(spark, folder)
    found: dict[Values, str] = {(): folder}
    for column in columns:
        deeper = {}
        for values, at in found.items():
            for status in files.listStatus(spark._jvm.org.apache.hadoop.fs.Path(at)):
                name = status.getPath().getName()
                if status.isDirectory() and name.startswith(f"{column}="):
                    deeper[*values, _unescaped(spark, name[len(column) + 1 :])] = f"{at}/{name}"
        found = deeper
    return found


def table_partitions(spark: SparkSession, table: str, columns: Sequence[str]) -> set[Values]:
    """The partitions that the catalog knows, by the text of their values."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    names = [dict(part.split("=", 1) for part in row[0].split("/")) for row in rows]
    return {tuple(_unescaped(spark, n[c]) for c in columns) for n in names}


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(columns: Sequence[str], values: Values) -> str:
    pairs = zip(columns, values, strict=True)
    return "PARTITION (" + ", ".join(f"`{c}` = {'null' if v is None else _literal(v)}" for c, v in pairs) + ")"


def switch_table(spark: SparkSession, table: str, folder: str) -> None:
    """Let an unpartitioned table show the rows of ``folder``."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(folder)}")
    spark.catalog.refreshTable(table)


def switch_partitions(
    spark: SparkSession, table: str, columns: Sequence[str], folder: str, *, drop_others: bool
) -> dict[Values, str]:
    """Let the table show the partitions written below ``folder``; returns these.

    Partitions that are not there are left alone, or dropped. Nothing else of the table is listed.
    """
    written = partition_folders(spark, folder, columns)
    known = table_partitions(spark, table, columns)
    for values, at in written.items():
        if values in known:
            spark.sql(f"ALTER TABLE {table} {_spec(columns, values)} SET LOCATION {_literal(at)}")
    new = [f"{_spec(columns, values)} LOCATION {_literal(at)}" for values, at in written.items() if values not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(new))
    gone = [_spec(columns, values) for values in known - written.keys()] if drop_others else []
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(gone))
    spark.catalog.refreshTable(table)
    return written


def _shown(spark: SparkSession, table: str, location: str, partitioned: bool) -> set[str]:
    """The folders that a table or its partitions point at."""
    shown = {location}
    if partitioned:
        database, _, name = table.rpartition(".")
        catalog = spark._jsparkSession.sharedState().externalCatalog()
        parts = catalog.listPartitions(database or spark.catalog.currentDatabase(), name, spark._jvm.scala.Option.apply(None))
        shown |= {parts.apply(i).storage().locationUri().get().toString() for i in range(parts.size())}
    return shown


def drop_old_versions(
    spark: SparkSession, table: str, location: str, *, partitioned: bool, older_than_hours: float = 24.0
) -> list[str]:
    """Delete the versions that the table no longer shows and that no reader may still be reading; returns them."""
    files, folder = file_system(spark, f"{base_folder(location)}.versions")
    if not files.exists(folder):
        return []
    used = {m.group(0).rsplit("/", 1)[-1] for s in _shown(spark, table, location, partitioned) for m in re.finditer(r"v-\d{20}-[0-9a-f]+", s)}
    limit = time.time_ns() - int(older_than_hours * 3600e9)
    dropped = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name not in used and int(name.split("-")[1]) < limit:
            files.delete(status.getPath(), True)
            dropped.append(name)
    return dropped
