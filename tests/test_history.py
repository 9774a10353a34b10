"""Intervals and point-in-time values against brute force: ties, nulls, empty tables, one hot key, plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.history import validity_intervals, value_then

SCHEMA = "user_id bigint, level string, city string, ts timestamp_ntz, item int"


def moment(minutes):
    return dt.datetime(2018, 1, 1) + dt.timedelta(minutes=minutes)


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if rng.random() < 0.5 else rng.choice([2, 3, None])
        ts = moment(rng.randrange(200) * 1440) if rng.random() < 0.95 else None
        rows.append((user, rng.choice(["free", "paid", None]), rng.choice("xy"), ts, i))
    return rows


def intervals(rows):
    users = {}
    for user, level, city, ts, _ in rows:
        if ts is not None:
            users.setdefault(user, {}).setdefault(ts, []).append((level, city))
    out = []
    for user, moments in users.items():
        runs = []
        for ts in sorted(moments):
            value = max(moments[ts], key=lambda v: (v[0] is not None, v[0] or "", v[1]))
            if not runs or runs[-1][0] != value:
                runs.append((value, ts))
        for (value, start), after in zip(runs, [*(r[1] for r in runs[1:]), None], strict=True):
            out.append((user, *value, start, after))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("bucket", ["month", "day", "year"])
def test_intervals_match_brute_force(spark, bucket):
    rows = made(400, 1)
    found = validity_intervals(spark.createDataFrame(rows, SCHEMA), ["user_id"], ["level", "city"], "ts", bucket=bucket)
    assert found.columns == ["user_id", "level", "city", "valid_from", "valid_to"]
    assert in_order(found.collect()) == in_order(intervals(rows))


@pytest.mark.parametrize("bucket", ["month", "day"])
def test_value_then_matches_brute_force(spark, bucket):
    history = [(u, v, f) for u, v, _, f, _ in intervals(made(100, 2))] + [(4, "late", moment(10**6)), (5, "x", None)]
    events = made(300, 3) + [(4, "a", "b", moment(5), 300), (9, "a", "b", moment(5), 301)] * 2
    sides = spark.createDataFrame(events, SCHEMA), spark.createDataFrame(history, "user_id bigint, level string, valid_from timestamp_ntz")
    found = value_then(*sides, ["user_id"], "level", "ts", name="level_then", bucket=bucket)
    expected = []
    for e in events:
        before = [(f, v) for u, v, f in history if u is not None and e[3] is not None and u == e[0] and f is not None and f <= e[3]]
        expected.append((*e, max(before)[1] if before else None))
    assert found.columns == [*SCHEMA.replace(" bigint", "").replace(" string", "").replace(" timestamp_ntz", "").replace(" int", "").split(", "), "level_then"]
    assert in_order(found.collect()) == in_order(expected)


def test_empty_sides(spark):
    nothing, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(made(5, 4), SCHEMA)
    assert validity_intervals(nothing, ["user_id"], ["level"], "ts").collect() == []
    history = validity_intervals(nothing, ["user_id"], ["level"], "ts")
    assert {r.then for r in value_then(some, history, ["user_id"], "level", "ts", name="then").collect()} == {None}
    assert value_then(nothing, history, ["user_id"], "level", "ts", name="then").collect() == []


def test_a_hot_user_is_cut_by_time_and_nothing_is_joined_by_range(spark):
    rows = [(1, "free" if i % 1000 else "paid", "x", moment(i * 60), i) for i in range(8000)]
    events = spark.createDataFrame(rows, SCHEMA)
    history = validity_intervals(events, ["user_id"], ["level"], "ts")
    assert history.count() == 16
    found = value_then(events, history, ["user_id"], "level", "ts", name="then")
    assert found.where(~F.col("then").eqNullSafe(F.col("level"))).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in plan
    # the window over all events takes key and bucket: no more than a month of a user comes together
    most = events.groupBy("user_id", F.date_trunc("month", "ts")).count().agg(F.max("count")).first()[0]
    assert most <= 31 * 24 and "hashpartitioning(user_id" in plan and "_bucket" in plan
