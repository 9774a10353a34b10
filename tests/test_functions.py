import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions import calendar, keys, values

D = dt.date


def one(spark, column, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [("5748517.0", 5748517), ("12.9", 12), ("-3.7", -3), ("abc", None), ("", None), (None, None),
     ("1e20", None), ("NaN", None)],
)
def test_to_int(spark, text, expected):
    assert one(spark, values.to_int("x"), value=text) == expected


def test_to_int_of_nan(spark):
    assert one(spark, values.to_int("x"), "x double", float("nan")) is None


@pytest.mark.parametrize(
    "days, expected",
    [("0", D(1960, 1, 1)), ("20545.0", D(2016, 4, 1)), ("-1", D(1959, 12, 31)), (None, None),
     ("abc", None)],
)
def test_sas_date(spark, days, expected):
    assert one(spark, calendar.sas_date("x"), value=days) == expected


@settings(max_examples=20, deadline=None)
@given(st.lists(st.dates(D(1900, 1, 1), D(2200, 1, 1)), min_size=1, max_size=30))
def test_sas_date_inverts_day_number(spark, dates):
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    back = df.select("d", calendar.sas_date(calendar.sas_day_number("d")).alias("b")).collect()
    assert all(r.d == r.b for r in back)


def test_stay_days(spark):
    df = spark.createDataFrame(
        [(D(2016, 4, 1), D(2016, 4, 30)), (D(2016, 4, 1), None), (None, D(2016, 4, 1)),
         (D(2016, 4, 2), D(2016, 4, 1)), (D(2016, 2, 28), D(2016, 3, 1))],
        "a date, d date",
    )
    assert [r[0] for r in df.select(calendar.stay_days("a", "d")).collect()] == [29, None, None, -1, 2]


def test_epochs_do_not_depend_on_the_session_zone(spark):
    millis = 1542837407796
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        exact = one(spark, calendar.epoch_millis_ts("x"), "x bigint", millis)
        cut = one(spark, calendar.epoch_seconds_ts("x"), "x bigint", millis)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert exact == dt.datetime(2018, 11, 21, 21, 56, 47, 796000)
    assert cut == dt.datetime(2018, 11, 21, 21, 56, 47)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_in_a_gap_of_the_session_zone(spark, zone):
    times = [dt.datetime(2018, 3, 11, 2, 30, 1, 999999), dt.datetime(1969, 12, 31, 23, 59, 59, 1500), None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = df.select(
            calendar.truncate_to_second("t"), calendar.epoch_millis("t"),
            calendar.epoch_millis_ts(calendar.epoch_millis("t")),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r[0] for r in found] == [times[0].replace(microsecond=0), times[1].replace(microsecond=0), None]
    assert [r[1] for r in found] == [1520735401999, -999, None]
    assert [r[2] for r in found] == [
        times[0].replace(microsecond=999000), times[1].replace(microsecond=1000), None
    ]


def test_weekday_conventions(spark):
    days = spark.createDataFrame([(D(2016, 1, 1) + dt.timedelta(days=i),) for i in range(10)], "d date")
    found = days.select(
        "d", calendar.date_parts("d")["dayofweek"].alias("one_based"),
        calendar.time_parts("d")["weekday"].alias("zero_based"),
        calendar.date_parts("d")["weekofyear"].alias("week"),
    ).collect()
    for row in found:
        assert row.one_based == row.d.isoweekday() % 7 + 1
        assert row.zero_based == row.d.isoweekday() % 7
        assert row.week == row.d.isocalendar().week
    assert found[0].week == 53


def test_recode_keeps_unlisted_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert [r[0] for r in df.select(values.recode("x", {"a": "A"})).collect()] == ["A", "b", None]
    assert [r[0] for r in df.select(values.recode("x", {})).collect()] == ["a", "b", None]


def test_code_label(spark):
    df = spark.createDataFrame([(1,), (7,), (None,)], "x int")
    labels = {1: "air", 2: "sea"}
    assert [r[0] for r in df.select(values.code_label("x", labels)).collect()] == ["air", None, None]
    assert [r[0] for r in df.select(values.code_label("x", labels, "?")).collect()] == ["air", "?", "?"]


@pytest.mark.parametrize(
    "name, expected",
    [("GUINEA-BISSAU", "Guinea-bissau"), ("ivory coast", "Ivory Coast"), ("CÔTE D'IVOIRE", "Côte D'ivoire")],
)
def test_title_case_splits_on_spaces_only(spark, name, expected):
    assert one(spark, values.title_case("x"), value=name) == expected


def test_md5_key(spark):
    df = spark.createDataFrame([(7, dt.datetime(2018, 11, 1, 2, 3, 4)), (None, None)], "s int, t timestamp_ntz")
    found = [r[0] for r in df.select(keys.md5_key("s", "t")).collect()]
    assert found == [hashlib.md5(b"72018-11-01 02:03:04").hexdigest(), None]


@settings(max_examples=20, deadline=None)
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 90)), st.one_of(st.none(), st.integers(0, 1000))),
        min_size=1, max_size=20,
    )
)
def test_weighted_mean_matches_plain_arithmetic(spark, pairs):
    df = spark.createDataFrame(pairs, "v int, w int")
    zero, skip = df.agg(
        values.weighted_mean("v", "w"), values.weighted_mean("v", "w", "skip")
    ).first()

    def mean(kept):
        weight = sum(w for _, w in kept)
        return sum(v * w for v, w in kept) / weight if weight else None

    assert zero == mean([(v or 0, w or 0) for v, w in pairs])
    whole = [(v, w) for v, w in pairs if v is not None and w is not None]
    assert skip == mean(whole)


def test_weighted_mean_refuses_unknown_rule():
    with pytest.raises(ValueError):
        values.weighted_mean("v", "w", "drop")


def test_identity_key_is_unique(spark):
    ids = spark.range(1000, numPartitions=7).select(keys.identity_key(5).alias("i"))
    assert ids.agg(F.count_distinct("i"), F.min("i")).first()[:] == (1000, 5)


def test_whole_numbers_stay_exact(spark):
    row = spark.sql("SELECT '9007199254740993' AS a, '12.0' AS b, 'x' AS c").select(
        *[values.to_bigint(c).alias(c) for c in "abc"]
    )
    assert tuple(row.first()) == (9007199254740993, 12, None)
