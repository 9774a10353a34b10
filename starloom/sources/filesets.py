"""Sets of files, one member per month, whose schemas differ: compared, widened where nothing is lost, read as one table.

Members are few (files or folders named by month), their rows are not. Members of one schema are one scan, so that a set
of a hundred months with three layouts is three scans; projections and filters reach each of them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.values import to_int
from starloom.operators.rejects import FILE, REASON
from starloom.sinks.publish import file_system
from starloom.sources.files import MONTH_PATTERN, MONTHS, read_checked, read_table

_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
_DOUBLE_DIGITS = 15  # whole numbers of so many digits are exact in a double


class SchemaConflict(Exception):
    """The members of a file set cannot be read as one table."""


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    digits = _DIGITS.get(kind.simpleString())
    return T.DecimalType(digits, 0) if digits else None


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both exactly; None if there is none.

    bigint and double have none: neither holds all values of the other.
    """
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    names = {a.simpleString(), b.simpleString()}
    if "void" in names:
        return b if a.simpleString() == "void" else a
    if names == {"float", "double"}:
        return T.DoubleType()
    if names <= {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    exact = [d for d in (_as_decimal(a), _as_decimal(b)) if d is not None]
    if len(exact) == 2:
        scale = max(d.scale for d in exact)
        whole = max(d.precision - d.scale for d in exact)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if len(exact) == 1 and names & {"float", "double"}:
        return T.DoubleType() if exact[0].scale == 0 and exact[0].precision <= _DOUBLE_DIGITS else None
    return None


def members(spark: SparkSession, path: str) -> list[str]:
    """The files or folders of a set, in the order of their names.

    A pattern gives what it matches. A folder gives the files and folders in it that are named by month, or
    itself if there are none. Nothing below a member is listed here.
    """
    files, pattern = file_system(spark, path)
    found = list(files.globStatus(pattern) or [])
    if not found:
        raise FileNotFoundError(path)
    if len(found) == 1 and found[0].isDirectory():
        inside = [s for s in files.listStatus(found[0].getPath()) if re.match(MONTH_PATTERN, s.getPath().getName())]
        found = inside or found
    return sorted(str(s.getPath().toString()) for s in found)


@dataclass(frozen=True)
class FileSet:
    """Members with the schema of each, and the one they are read as. Names count as Spark compares them: in any case."""

    schemas: Mapping[str, T.StructType]
    schema: T.StructType
    fmt: str
    options: Mapping[str, object]
    conflicts: tuple[str, ...] = ()

    def groups(self) -> list[tuple[T.StructType, list[str]]]:
        """Members that are alike in names, order and types, together."""
        alike: dict[str, tuple[T.StructType, list[str]]] = {}
        for member, schema in self.schemas.items():
            layout = repr([(f.name, f.dataType) for f in schema])
            alike.setdefault(layout, (schema, []))[1].append(member)
        return list(alike.values())


def scan_set(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    *,
    required: Sequence[str] = (),
    on_conflict: str = "fail",
    **options,
) -> FileSet:
    """Compare the schemas of a set's members; only footers and headers are read.

    A column's type is the narrowest that holds every member's values exactly. Where there is none the set is
    refused, or with ``on_conflict="text"`` the column is read as text. Each member must have the ``required`` columns;
    others may be missing from some and are null there. Files of one member must agree.
    """
    if on_conflict not in ("fail", "text"):
        raise ValueError(f"on_conflict must be fail or text, not {on_conflict!r}")
    merged = {**options, "mergeSchema": True} if fmt in ("parquet", "orc") else options
    schemas = {m: read_table(spark, m, fmt, **merged).schema for m in members(spark, path)}
    if not any(len(s) for s in schemas.values()):
        raise SchemaConflict(f"{path}: no member has a column")
    kinds: dict[str, T.DataType] = {}
    names: dict[str, str] = {}
    conflicts: list[str] = []
    for schema in schemas.values():
        for f in schema:
            key = f.name.lower()
            names.setdefault(key, f.name)
            if key in conflicts:
                continue
            both = wider(kinds[key], f.dataType) if key in kinds else f.dataType
            if both is None:
                conflicts.append(key)
            kinds[key] = both if both is not None else T.StringType()
    if conflicts and on_conflict == "fail":
        told = {names[c]: sorted({s[n].dataType.simpleString() for s in schemas.values() for n in s.names if n.lower() == c}) for c in conflicts}
        raise SchemaConflict(f"{path}: no exact common type: {told}")
    for member, schema in schemas.items():
        lacking = [c for c in required if c.lower() not in {n.lower() for n in schema.names}]
        if lacking:
            raise SchemaConflict(f"{member}: missing columns {lacking}")
    common = T.StructType([T.StructField(names[k], kind) for k, kind in kinds.items()])
    return FileSet(schemas, common, fmt, options, tuple(names[c] for c in conflicts))


def set_report(spark: SparkSession, found: FileSet) -> DataFrame:
    """One row per column of the set: how many members have it and lack it, the types it has there, and the one it is read as."""
    rows = []
    for place, field in enumerate(found.schema):
        held = [f.dataType.simpleString() for s in found.schemas.values() for f in s if f.name.lower() == field.name.lower()]
        rows.append((place, field.name, len(held), len(found.schemas) - len(held), sorted(set(held)), field.dataType.simpleString(), field.name in found.conflicts))
    schema = "position int, column_name string, n_members int, n_missing int, held_types array<string>, read_type string, conflict boolean"
    return spark.createDataFrame(rows, schema)


def _month_parts(where: Column) -> tuple[Column, Column]:
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(where, MONTH_PATTERN, 1)))
    return F.nullif(month, F.lit(0)).cast("int"), F.regexp_extract(where, MONTH_PATTERN, 2).try_cast("int")


def read_set(spark: SparkSession, found: FileSet, columns: Sequence[str] | None = None) -> DataFrame:
    """The set as one table, columns found by name and cast to the common type, null where a member lacks them.

    Adds source_file, source_month (1-12) and source_year (two digits, as named).
    """
    wanted = [f for f in found.schema if columns is None or f.name.lower() in {c.lower() for c in columns}]
    frames = []
    for schema, paths in found.groups():
        df = read_table(spark, paths, found.fmt, schema=schema, **found.options)
        here = {n.lower(): n for n in schema.names}
        chosen = [
            (F.col(f"`{here[f.name.lower()]}`") if f.name.lower() in here else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
        month, year = _month_parts(F.col("_metadata.file_path"))
        frames.append(df.select(*chosen, F.col("_metadata.file_name").alias("source_file"), month.alias("source_month"), year.alias("source_year")))
    return reduce(DataFrame.union, frames)


def other_month(year: Column, month: Column, file_year: Column, file_month: Column) -> Column:
    """True where a row's own year and month are known and are not those its file is named after; never null."""
    differs = (month != file_month) | (F.pmod(year, F.lit(100)) != file_year)
    return F.coalesce(differs, F.lit(False))


def month_report(df: DataFrame, year: Column, month: Column) -> DataFrame:
    """Rows of each file's month, how many are of another month or year, and how many do not know theirs. One aggregation."""
    misplaced = other_month(year, month, F.col("source_year"), F.col("source_month"))
    return df.groupBy("source_year", "source_month").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(misplaced).alias("n_other_month"),
        F.count_if(year.isNull() | month.isNull()).alias("n_unknown"),
    )


def read_checked_set(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    *,
    columns: Sequence[str],
    required: Sequence[str] = (),
    year: str,
    month: str,
    load_size: int | None = None,
    **options,
) -> tuple[DataFrame, FileSet]:
    """:func:`read_checked` of every member, as one table of ``columns``, and the set itself.

    Records whose ``year`` and ``month`` are not those of their file are given the reason ``other month``. Columns that
    a member lacks are null in its records.
    """
    found = scan_set(spark, path, fmt, required=[*required, year, month], **options)
    absent = {c.lower() for c in columns} - {n.lower() for n in found.schema.names}
    if absent:
        raise SchemaConflict(f"{path}: no member has the columns {sorted(absent)}")
    kinds = {f.name.lower(): f.dataType for f in found.schema}
    frames = []
    for schema, paths in found.groups():
        here = {n.lower(): n for n in schema.names}
        present = [c for c in columns if c.lower() in here]
        df = read_checked(spark, paths, fmt, columns=present, load_size=load_size, **options)
        told = [c for c in df.columns if c not in present]
        chosen = [(F.col(f"`{c}`") if c in present else F.lit(None)).cast(kinds[c.lower()]).alias(c) for c in columns]
        frames.append(df.select(*chosen, *told))
    records = reduce(DataFrame.unionByName, frames)
    file_month, file_year = _month_parts(F.col(FILE))
    misplaced = other_month(to_int(year), to_int(month), file_year, file_month)
    reason = F.coalesce(REASON, F.when(misplaced, F.lit("other month")))
    records = records.withColumn(REASON, reason)
    return (records if load_size is None else records.limit(load_size)), found
