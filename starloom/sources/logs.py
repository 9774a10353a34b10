"""JSON scans of the music service: activity logs and song metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.calendar import epoch_millis_ts
from starloom.functions.values import to_bigint
from starloom.operators.rejects import FILE, LINE, REASON, first_reason, lost_in_cast
from starloom.schemas import LOG_JSON, SONG_JSON

_CORRUPT = "_corrupt"


def log_columns() -> list[Column]:
    """Staging columns from the log's JSON keys."""
    return [
        F.col("artist"),
        F.col("auth"),
        F.col("firstName").alias("first_name"),
        F.col("gender"),
        F.col("itemInSession").alias("item_in_session"),
        F.col("lastName").alias("last_name"),
        F.col("length"),
        F.col("level"),
        F.col("location"),
        F.col("method"),
        F.col("page"),
        to_bigint("registration").alias("registration"),
        F.col("sessionId").alias("session_id"),
        F.col("song"),
        F.col("status"),
        epoch_millis_ts("ts").alias("ts"),
        F.col("userAgent").alias("user_agent"),
        to_bigint("userId").alias("user_id"),
    ]


def _read_json(
    spark: SparkSession, path: str, schema: T.StructType, corrupt_column: str | None, options: dict
) -> DataFrame:
    options = {"recursiveFileLookup": True, **options}
    if corrupt_column is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    return spark.read.schema(schema).options(**options).json(path)


def read_log_events(
    spark: SparkSession, path: str, *, corrupt_column: str | None = None, **options
) -> DataFrame:
    """Activity log, one JSON object per line, in any depth of folders.

    ``corrupt_column`` collects the lines that are no JSON or hold a value of another type.
    """
    kept = [] if corrupt_column is None else [F.col(corrupt_column)]
    return _read_json(spark, path, LOG_JSON, corrupt_column, options).select(*log_columns(), *kept)


def read_songs(
    spark: SparkSession, path: str, *, corrupt_column: str | None = None, **options
) -> DataFrame:
    """Song metadata, matched by key name, in any depth of folders; ``corrupt_column`` as for the log."""
    return _read_json(spark, path, SONG_JSON, corrupt_column, options)


def parsed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON lines (``value``) as columns, with the line's text and, if it is no JSON or a value has another
    type, the reason. Blank lines are none. Needs a frame read straight from text files.
    """
    whole = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    read = lines.where(F.trim("value") != "").select(
        F.from_json("value", whole, options).alias("r"), F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE)
    )
    unreadable = F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull()
    return read.select(*[F.col(f"r.`{f.name}`") for f in schema], LINE, FILE, F.when(unreadable, "unreadable").alias(REASON))


def checked_log(lines: DataFrame) -> DataFrame:
    """Staging columns of the log's lines; a line is rejected if it cannot be read or a number in it is none."""
    raw = parsed_lines(lines, LOG_JSON)
    lost = {c: lost_in_cast(c, to_bigint(c)) for c in ("userId", "registration")}
    reason = F.coalesce(REASON, first_reason(lost)).alias(REASON)
    return raw.select(*log_columns(), LINE, FILE, reason)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(path)


def read_checked_log(spark: SparkSession, path: str) -> DataFrame:
    return checked_log(read_lines(spark, path))


def read_checked_songs(spark: SparkSession, path: str) -> DataFrame:
    return parsed_lines(read_lines(spark, path), SONG_JSON)
