"""Catalog tables made from contracts: create, drop, load by column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import CONTRACTS, TableContract
from starloom.sinks.parquet import arrange
from starloom.sinks.publish import drop_old_versions, new_version, switch_partitions, switch_table


def create_table(
    spark: SparkSession,
    contract: TableContract,
    table: str | None = None,
    location: str | None = None,
) -> None:
    """Create the table if it is missing; its columns, types and partitions come from the contract."""
    spark.sql(contract.ddl(table, location))


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def qualified(database: str | None, name: str) -> str:
    return f"{database}.{name}" if database else name


def create_tables(spark: SparkSession, names: Sequence[str], database: str | None = None) -> None:
    for name in names:
        create_table(spark, CONTRACTS[name], qualified(database, name))


def drop_tables(spark: SparkSession, names: Sequence[str], database: str | None = None) -> None:
    for name in names:
        drop_table(spark, qualified(database, name))


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Exactly the contract's columns, found by name and cast to the declared types."""
    missing = [c for c in contract.columns if c not in df.columns]
    if missing:
        raise ValueError(f"{contract.name}: missing columns {missing}")
    return df.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in contract.schema]
    )


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    # The table's details follow its columns, one of which may have the same name.
    return described.where("col_name = 'Location'").collect()[-1]["data_type"]


def load_table(
    df: DataFrame,
    contract: TableContract,
    table: str | None = None,
    *,
    mode: str = "overwrite",
    location: str | None = None,
) -> int:
    """Load ``df`` into the contract's table, creating it if needed; returns the rows written.

    ``overwrite`` replaces the table, ``overwrite_partitions`` only the partitions present in
    ``df``, so that loading the same data twice leaves it once; ``append`` adds the rows.
    The rows are counted while they are written, not by a second scan.

    Replaced rows are written to a new version folder beside the table's, which the table or its
    partitions are pointed at when all is written: readers see the old rows or the new ones.
    """
    if mode not in ("overwrite", "overwrite_partitions", "append"):
        raise ValueError(f"unknown load mode {mode!r}")
    if mode == "overwrite_partitions" and not contract.partition_by:
        raise ValueError(f"{contract.name} has no partitions")
    spark = df.sparkSession
    table = table or contract.name
    create_table(spark, contract, table, location)
    written = Observation()
    laid_out = arrange(conform(df, contract), contract.partition_by, contract.sort_by)
    # Counted after the last shuffle, where a task that is run again does not count twice.
    counted = laid_out.observe(written, F.count(F.lit(1)).alias("n"))
    if mode == "append":
        # insertInto goes by position; the table holds its partition columns last.
        ordered = counted.select(*[f"`{c}`" for c in spark.table(table).columns])
        ordered.write.insertInto(table)
        return int(written.get["n"])
    folder = new_version(table_location(spark, table))
    if contract.partition_by:
        counted.write.partitionBy(*contract.partition_by).parquet(folder)
        switch_partitions(spark, table, contract.partition_by, folder, drop_others=mode == "overwrite")
    else:
        counted.write.parquet(folder)
        switch_table(spark, table, folder)
    return int(written.get["n"])


def clean_table(spark: SparkSession, contract: TableContract, table: str | None = None, older_than_hours: float = 24.0) -> list[str]:
    """Delete replaced versions of a table that are old enough that nobody reads them any more."""
    table = table or contract.name
    location = table_location(spark, table)
    return drop_old_versions(spark, table, location, partitioned=bool(contract.partition_by), older_than_hours=older_than_hours)
