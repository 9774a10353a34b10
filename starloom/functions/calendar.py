"""Day numbers, epochs and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day 0 of the day numbers used by the arrival records.
SAS_EPOCH = "1960-01-01"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sas_date(days: Column | str) -> Column:
    """Days since 1960-01-01 (any numeric or numeric text) to a date; null stays null."""
    number = _col(days).try_cast("double").try_cast("int")
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), number)


def sas_day_number(date: Column | str) -> Column:
    """Inverse of :func:`sas_date`."""
    return F.datediff(_col(date), F.lit(SAS_EPOCH).cast("date"))


def iso_text(date: Column | str) -> Column:
    return F.date_format(_col(date), "yyyy-MM-dd")


def stay_days(arrival: Column | str, departure: Column | str) -> Column:
    """Whole days from arrival to departure; null when either is null, negative when reversed."""
    return F.datediff(_col(departure), _col(arrival))


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_millis_ts(millis: Column | str) -> Column:
    """Epoch milliseconds to a timestamp without zone, independent of the session zone."""
    return F.timestamp_add("MILLISECOND", _col(millis), _epoch())


def epoch_seconds_ts(millis: Column | str) -> Column:
    """Epoch milliseconds to a timestamp without zone, cut to whole seconds."""
    seconds = F.call_function("div", _col(millis), F.lit(1000))
    return F.timestamp_add("SECOND", seconds, _epoch())


def epoch_millis(ts: Column | str) -> Column:
    """Inverse of :func:`epoch_millis_ts`; finer digits are cut."""
    t = _col(ts)
    days = F.datediff(t, F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1000 + (F.date_part(F.lit("SECOND"), t) * 1000).cast("bigint")


def truncate_to_second(ts: Column | str) -> Column:
    """Cut a timestamp without zone to whole seconds, independent of the session zone."""
    t = _col(ts)
    return F.make_timestamp_ntz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t)
    )


def date_parts(date: Column | str) -> dict[str, Column]:
    """Calendar columns of a date dimension; ISO week, dayofweek 1 = Sunday."""
    d = _col(date)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "weekofyear": F.weekofyear(d),
        "dayofweek": F.dayofweek(d),
    }


def time_parts(ts: Column | str) -> dict[str, Column]:
    """Columns of a time dimension; ISO week, weekday 0 = Sunday."""
    t = _col(ts)
    return {
        "hour": F.hour(t),
        "day": F.dayofmonth(t),
        "week": F.weekofyear(t),
        "month": F.month(t),
        "year": F.year(t),
        "weekday": F.dayofweek(t) - F.lit(1),
    }
