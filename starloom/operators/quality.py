"""Checks on loaded tables. Every check is a report row: table, check, value, passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import orphans
from starloom.operators.profile import duplicate_count
from starloom.schemas import TableContract

REPORT_SCHEMA = "table_name string, check_name string, value bigint, passed boolean"


class QualityError(Exception):
    """Raised by :func:`enforce`; the message lists the failed checks."""


def _row(table: str, check: str, value: Column, passed: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        value.cast("bigint").alias("value"),
        passed.alias("passed"),
    ]


def reported(found: DataFrame, table: str, check: str) -> DataFrame:
    """A frame of one number ``n`` as a report row; it must be 0."""
    return found.select(*_row(table, check, F.col("n"), F.col("n") == 0))


def union_reports(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def row_counts(tables: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """Each table must have at least ``min_rows`` rows."""
    n = F.count(F.lit(1))
    return union_reports(
        *[df.agg(n.alias("n")).select(
            *_row(name, "row_count", F.col("n"), F.col("n") >= min_rows)
        ) for name, df in tables.items()]
    )


def readable(name: str, open_table: Callable[[], DataFrame]) -> DataFrame:
    """The table opened by ``open_table``; a :class:`QualityError` names it if it cannot be opened."""
    try:
        return open_table()
    except AnalysisException as error:
        raise QualityError(f"{name}: returned no result ({error.getCondition()})") from error


def unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """``key`` must not repeat; value = rows beyond one per key."""
    extra = duplicate_count(df, key)
    name = "unique(" + ",".join(key) + ")"
    return extra.select(*_row(table, name, F.col("n_duplicates"), F.col("n_duplicates") == 0))


def _violations(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """One pass over the table; one report row per condition, which must hold for no row."""
    wide = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    long = wide.unpivot([], [f"`{name}`" for name in rules], "check_name", "value")
    return long.select(
        F.lit(table).alias("table_name"),
        "check_name",
        "value",
        (F.col("value") == 0).alias("passed"),
    )


def _null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"not_null({c})": F.col(f"`{c}`").isNull() for c in columns}


def _length_rules(lengths: Mapping[str, int]) -> dict[str, Column]:
    return {f"max_length({c})": F.length(f"`{c}`") > n for c, n in lengths.items()}


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` must hold no null; value = nulls found."""
    return _violations(df, table, _null_rules(columns))


def max_length(df: DataFrame, table: str, lengths: Mapping[str, int]) -> DataFrame:
    """Text columns must not exceed their declared length; value = rows that do."""
    return _violations(df, table, _length_rules(lengths))


def referential(
    fact: DataFrame, table: str, foreign_key: str, dimension: DataFrame, key: str
) -> DataFrame:
    """Every fact code must stand in the dimension; value = fact rows without a match."""
    missing = orphans(fact, foreign_key, dimension, key)
    total = missing.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    return total.select(
        *_row(table, f"referential({foreign_key})", F.col("n"), F.col("n") == 0)
    )


def completeness(source: DataFrame | int, target: DataFrame, table: str) -> DataFrame:
    """Source and target must have the same number of rows; value = source minus target.

    ``source`` may be a number that is known already, such as the rows counted while loading.
    """
    if isinstance(source, int):
        difference = target.agg((F.lit(source) - F.count(F.lit(1))).alias("n"))
    else:
        signs = source.select(F.lit(1).alias("s")).unionAll(target.select(F.lit(-1).alias("s")))
        difference = signs.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("n"))
    return difference.select(*_row(table, "completeness", F.col("n"), F.col("n") == 0))


def contract_checks(df: DataFrame, contract: TableContract) -> DataFrame:
    """Non-empty, unique key, no null where the contract forbids it, declared text lengths.

    Two passes: one counts rows, nulls and lengths, the other groups by the key.
    """
    rules = _null_rules(list(dict.fromkeys(contract.key + contract.not_null)))
    rules |= _length_rules(contract.max_length)
    # Counted as rows, reported as passed if there are any.
    counted = _violations(df, contract.name, {"row_count": F.lit(True), **rules})
    has_rows = F.when(F.col("check_name") == "row_count", F.col("value") > 0)
    return union_reports(
        counted.withColumn("passed", has_rows.otherwise(F.col("passed"))),
        unique(df, contract.name, contract.key),
    )


def value_counts(df: DataFrame, columns: Sequence[str], present: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Rows by column and value (as text) in one grouping, for each value of ``by``: ``column_name``, ``value``, ``n``.

    Of the columns in ``present``, which may have many values, only null and not null are told apart. Counts of
    different ``by`` can be added up, so those of a reloaded month replace that month's alone.
    """
    told = {c: F.col(f"`{c}`").cast("string") for c in columns}
    told |= {c: F.when(F.col(f"`{c}`").isNotNull(), F.lit("")) for c in present}
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), v.alias("value")) for c, v in told.items()])
    one = df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.*")
    return one.groupBy(*by, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def counted_rows(counts: DataFrame, table: str, column: str, min_rows: int = 1) -> DataFrame:
    """:func:`row_counts` from value counts, of any column that was counted."""
    total = counts.where(F.col("column_name") == column).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return total.select(*_row(table, "row_count", F.col("n"), F.col("n") >= min_rows))


def counted_nulls(counts: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """:func:`not_null` from value counts."""
    nulls = [
        F.coalesce(F.sum(F.when((F.col("column_name") == c) & F.col("value").isNull(), F.col("n"))), F.lit(0)).alias(f"not_null({c})")
        for c in columns
    ]
    long = counts.agg(*nulls).unpivot([], [f"`not_null({c})`" for c in columns], "check_name", "value")
    return long.select(F.lit(table).alias("table_name"), "check_name", "value", (F.col("value") == 0).alias("passed"))


def counted_referential(counts: DataFrame, table: str, foreign_key: str, dimension: DataFrame, key: str) -> DataFrame:
    """:func:`referential` from value counts: joins the codes, not the rows."""
    codes = counts.where((F.col("column_name") == foreign_key) & F.col("value").isNotNull()).select(F.col("value").alias("_code"), "n")
    known = dimension.select(F.col(f"`{key}`").cast("string").alias("_code")).where(F.col("_code").isNotNull()).distinct()
    total = codes.join(known, "_code", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return total.select(*_row(table, f"referential({foreign_key})", F.col("n"), F.col("n") == 0))


def enforce(report: DataFrame) -> DataFrame:
    """Run the checks; return the report if all passed, else raise with every failed one.

    Collects the report, which has one row per check.
    """
    rows = report.collect()
    failed = [f"{r.table_name}: {r.check_name} = {r.value}" for r in rows if not r.passed]
    if failed:
        raise QualityError("; ".join(failed))
    return report.sparkSession.createDataFrame(rows, REPORT_SCHEMA)
