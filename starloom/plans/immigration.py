"""Arrivals fact and its date dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import date_parts, sas_date, stay_days
from starloom.functions.values import to_int
from starloom.operators.clean import distinct_values
from starloom.operators.rejects import FILE, LINE, REASON, first_reason, lost_in_cast

# The columns kept, in the order of the fact.
SOURCE_COLUMNS = (
    "cicid", "i94res", "i94cit", "arrdate", "i94addr", "i94yr", "i94mon", "i94port", "i94mode",
    "i94visa", "visatype", "depdate", "dtaddto", "entdepa", "entdepd", "i94bir", "biryear",
    "gender", "airline",
)

_INTEGER_COLUMNS = {
    "cicid", "i94res", "i94cit", "i94yr", "i94mon", "i94mode", "i94visa", "i94bir", "biryear",
}
_DATE_COLUMNS = {"arrdate", "depdate"}


def build_immigration(raw: DataFrame, columns: Sequence[str] = SOURCE_COLUMNS) -> DataFrame:
    """Arrival records to the fact: whole-number codes, dates from day numbers, length of stay."""

    def converted(name: str):
        if name in _INTEGER_COLUMNS:
            return to_int(name).alias(name)
        if name in _DATE_COLUMNS:
            return sas_date(name).alias(name)
        return F.col(name)

    fact = raw.select(*[converted(c) for c in columns])
    if _DATE_COLUMNS <= set(columns):
        fact = fact.withColumn("stay", stay_days("arrdate", "depdate"))
    return fact


def checked_immigration(records: DataFrame) -> DataFrame:
    """:func:`build_immigration` of records that name their file and text; one with a number or day that is none is rejected."""
    lost = {c: lost_in_cast(c, to_int(c)) for c in SOURCE_COLUMNS if c in _INTEGER_COLUMNS}
    lost |= {c: lost_in_cast(c, sas_date(c)) for c in SOURCE_COLUMNS if c in _DATE_COLUMNS}
    reasoned = records.withColumn(REASON, F.coalesce(REASON, first_reason(lost)))
    told = reasoned.select(*SOURCE_COLUMNS, F.struct(FILE, LINE, REASON).alias("_told"))
    fact = build_immigration(told, [*SOURCE_COLUMNS, "_told"])
    return fact.select(*[c for c in fact.columns if c != "_told"], "_told.*")


def date_union_all(fact: DataFrame, first: str = "arrdate", second: str = "depdate") -> DataFrame:
    """Distinct values of each column, one after the other: a date in both comes twice, null stays."""
    return (
        fact.select(F.col(first).alias("date"))
        .distinct()
        .union(fact.select(F.col(second).alias("date")).distinct())
    )


def build_dates(
    fact: DataFrame, first: str = "arrdate", second: str = "depdate", form: str = "unique"
) -> DataFrame:
    """Date dimension. ``form="unique"`` gives one row per date and no null, as its key demands;
    ``form="union_all"`` keeps the repeated dates and the null.
    """
    if form == "unique":
        dates = distinct_values(fact, [first, second], "date")
    elif form == "union_all":
        dates = date_union_all(fact, first, second)
    else:
        raise ValueError(f"unknown form {form!r}")
    return _with_parts(dates)


def dates_of(counts: DataFrame, columns: Sequence[str] = ("arrdate", "depdate")) -> DataFrame:
    """The date dimension (one row per date) from counts of the fact's values by column."""
    dates = counts.where(F.col("column_name").isin(*columns) & F.col("value").isNotNull())
    return _with_parts(dates.select(F.col("value").alias("date")).distinct())


def _with_parts(dates: DataFrame) -> DataFrame:
    dates = dates.select(F.to_date("date").alias("date"))
    return dates.select("date", *[e.alias(n) for n, e in date_parts("date").items()])
