"""Parquet writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.readwriter import DataFrameWriter


def arrange(
    df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> DataFrame:
    """Lay rows out for writing.

    Partitioned output is rebalanced on the partition columns: few files per partition, while a
    partition too large for one task is split. Sorted output is range-partitioned and sorted, so
    that row groups carry narrow key ranges and readers can skip them.
    """
    if sort_by and not partition_by:
        return df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    return df


def _writer(df: DataFrame, partition_by: Sequence[str], replace: str) -> DataFrameWriter:
    writer = df.write.format("parquet").mode("append" if replace == "nothing" else "overwrite")
    if partition_by:
        overwrite = "dynamic" if replace == "partitions" else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", overwrite)
    return writer


def write_parquet(
    df: DataFrame,
    path: str | None,
    partition_by: Sequence[str] | None = None,
    *,
    sort_by: Sequence[str] = (),
    columns: Sequence[str] | str | None = None,
    replace: str = "all",
) -> DataFrame:
    """Write ``df`` if a path is given and return it in any case.

    ``replace="all"`` overwrites the whole output, ``"partitions"`` only the partitions that occur
    in ``df`` (reload of one month), ``"nothing"`` appends.
    """
    if replace not in ("all", "partitions", "nothing"):
        raise ValueError(f"replace must be all, partitions or nothing, not {replace!r}")
    if replace == "partitions" and not partition_by:
        raise ValueError("replace='partitions' needs partition_by")
    if path is not None:
        out = df if columns is None or columns == "*" else df.select(*columns)
        parts = tuple(partition_by or ())
        _writer(arrange(out, parts, sort_by), parts, replace).save(path)
    return df
