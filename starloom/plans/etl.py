"""One call per source: read, build, write if a path is given, return the frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from starloom.plans.country import build_country
from starloom.plans.immigration import SOURCE_COLUMNS, build_dates, build_immigration
from starloom.plans.state import build_state
from starloom.schemas import TEMPERATURE
from starloom.sinks.parquet import write_parquet
from starloom.sources.files import read_delimited, read_demographics, read_lookup, read_table


def etl_immigration(
    spark: SparkSession,
    input_path: str,
    output_path: str | None = None,
    date_output_path: str | None = None,
    input_format: str = "csv",
    columns: Sequence[str] = SOURCE_COLUMNS,
    load_size: int | None = None,
    partition_by: Sequence[str] | None = ("i94yr", "i94mon"),
    **options,
) -> DataFrame:
    """Arrivals fact and, if ``date_output_path`` is given, its date dimension.

    Where the fact is written, the dates are read back from it instead of from the raw records.
    """
    raw = read_table(
        spark, input_path, input_format, columns=columns, load_size=load_size, **options
    )
    fact = build_immigration(raw, columns)
    write_parquet(fact, output_path, partition_by)
    if date_output_path is not None:
        stored = fact
        if output_path is not None:
            stored = spark.read.schema(fact.schema).parquet(output_path)
        write_parquet(build_dates(stored), date_output_path)
    return fact


def etl_states(
    spark: SparkSession,
    input_path: str,
    output_path: str | None = None,
    columns: Sequence[str] | str = "*",
    load_size: int | None = None,
    partition_by: Sequence[str] | None = None,
    sep: str = ";",
    missing: str = "zero",
    **options,
) -> DataFrame:
    """State dimension. By default one Parquet table: partitioning it by state gives tiny files."""
    cities = read_demographics(spark, input_path, sep, load_size=load_size, **options)
    return write_parquet(
        build_state(cities, missing=missing), output_path, partition_by, columns=columns
    )


def etl_countries(
    spark: SparkSession,
    input_path: str,
    codes_path: str,
    output_path: str | None = None,
    columns: Sequence[str] | str = "*",
    load_size: int | None = None,
    partition_by: Sequence[str] | None = None,
    recode_first: bool = True,
    **options,
) -> DataFrame:
    """Country dimension from temperature readings and the country code list."""
    readings = read_delimited(spark, input_path, TEMPERATURE, load_size=load_size, **options)
    country = build_country(readings, read_lookup(spark, codes_path), recode_first=recode_first)
    return write_parquet(country, output_path, partition_by, columns=columns)
