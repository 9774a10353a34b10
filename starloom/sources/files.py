"""Generic, delimited, lookup and monthly file scans; previews and schema listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.values import to_int
from starloom.operators.rejects import FILE, LINE, REASON

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# the last one in a path: of the file name, else of the nearest folder
MONTH_PATTERN = r"(?i)^.*_(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)(\d{2})"


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    *,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | str | None = None,
    load_size: int | None = None,
    **options,
) -> DataFrame:
    """Scan any installed format, keep ``columns`` and, for trial runs only, ``load_size`` rows.

    CSV files are read with a header unless ``header`` says otherwise.
    """
    if fmt == "csv":
        options = {"header": True, **options}
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path if isinstance(path, str) else list(path))
    if columns is not None and columns != "*":
        df = df.select(*columns)
    if load_size is not None:
        df = df.limit(load_size)
    return df


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    sep: str = ",",
    corrupt_column: str | None = None,
    **options,
) -> DataFrame:
    """Delimited text with a header line. Without a schema the types are inferred, which costs an
    extra pass over the files; with one, the header must name its columns in the same order.
    ``corrupt_column`` collects the lines that do not fit the schema.
    """
    if schema is None:
        return read_table(spark, path, "csv", sep=sep, **{"inferSchema": True, **options})
    options = {"enforceSchema": False, **options}
    if corrupt_column is not None:
        declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*declared.fields, T.StructField(corrupt_column, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column, **options}
    return read_table(spark, path, "csv", schema=schema, sep=sep, **options)


def read_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "csv",
    *,
    columns: Sequence[str],
    load_size: int | None = None,
    **options,
) -> DataFrame:
    """As :func:`read_table`, with the file and the text of every record, and a reason if it does not fit.

    Delimited records are read as text under the names of the header; one with too few or too many values is
    unreadable. Other formats hold only records that fit; their text is JSON.
    """
    if fmt != "csv":
        df = read_table(spark, path, fmt, load_size=load_size, **options)
        return df.select(*columns, F.col("_metadata.file_path").alias(FILE), F.to_json(F.struct("*")).alias(LINE), F.lit(None).cast("string").alias(REASON))
    names = read_table(spark, path, fmt, **{**options, "inferSchema": False}).columns
    bad = "_corrupt"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, bad]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, **options}
    df = read_table(spark, path, fmt, schema=schema, **options)
    if load_size is not None:
        df = df.limit(load_size)
    line = F.coalesce(F.col(bad), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names])))
    unreadable = F.when(F.col(bad).isNotNull(), "unreadable").alias(REASON)
    return df.select(*columns, F.col("_metadata.file_path").alias(FILE), line.alias(LINE), unreadable)


def read_lookup(
    spark: SparkSession, path: str, columns: Sequence[str] = ("Code", "Country"), sep: str = ";"
) -> DataFrame:
    """Code list with a header; every column is text and only ``columns`` are kept."""
    return read_table(spark, path, "csv", columns=list(columns), sep=sep)


def read_state_lookup(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    return read_lookup(spark, path, ("Code", "State"), sep)


# Output column -> (accepted header names, is it a whole number).
_CITY_MEASURES = {
    "Median Age": (("Median Age",), False),
    "Male Population": (("Male Population",), True),
    "Female Population": (("Female Population",), True),
    "Total Population": (("Total Population",), True),
    "Number of Veterans": (("Number of Veterans", "Number Veterans"), True),
    "Foreign-born": (("Foreign-born",), True),
    "Average Household Size": (("Average Household Size",), False),
    "Count": (("Count",), True),
}


def read_demographics(spark: SparkSession, path: str, sep: str = ";", **options) -> DataFrame:
    """City demographics, one row per city and group. Columns are found by header name, so their
    order does not matter and both spellings of the veterans column are accepted.
    """
    raw = read_table(spark, path, "csv", sep=sep, **options)
    return demographics_columns(raw)


def demographics_columns(raw: DataFrame) -> DataFrame:
    measures = []
    for name, (headers, whole) in _CITY_MEASURES.items():
        header = next((h for h in headers if h in raw.columns), None)
        if header is None:
            raise ValueError(f"demographics have none of the columns {headers}")
        value = F.col(f"`{header}`")
        measures.append((to_int(value) if whole else value.try_cast("double")).alias(name))
    return raw.select("City", "State", "`State Code`", "Race", *measures)


def read_monthly(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    *,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """A set of files (or folders) named ``..._apr16...``, one per month, read as one table.

    The month is read from the file name, else from the nearest folder, in upper or lower case.
    Adds source_file, source_month (1-12) and source_year (two digits, as named).
    """
    df = read_table(spark, path, fmt, schema=schema, **options)
    chosen = list(columns) if columns is not None else df.columns
    where = F.col("_metadata.file_path")
    month = F.lower(F.regexp_extract(where, MONTH_PATTERN, 1))
    numbers = F.array(*[F.lit(m) for m in MONTHS])
    return df.select(
        *chosen,
        F.col("_metadata.file_name").alias("source_file"),
        F.nullif(F.array_position(numbers, month), F.lit(0)).cast("int").alias("source_month"),
        F.regexp_extract(where, MONTH_PATTERN, 2).try_cast("int").alias("source_year"),
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )
