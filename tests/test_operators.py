import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.operators import aggregates, clean, identity, joins, profile, quality
from starloom.operators.identity import number_stored_rows, with_dense_id
from starloom.schemas import CONTRACTS

NAN = float("nan")


# --- joins ------------------------------------------------------------------------------------

LEFT = [(1, "a", 1), (2, "a", 1), (3, None, 1), (4, "b", None), (5, "c", 3), (6, None, None)]
RIGHT = [("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 1, "n")]


def brute_left_join(left, right):
    out = []
    for row in left:
        hits = [r for r in right if None not in (row[1], row[2]) and row[1:] == r[:2]]
        out += [(row[0], r[2]) for r in hits] or [(row[0], None)]
    return sorted(out, key=str)


@pytest.mark.parametrize("spread, salts", [((), 1), (("id",), 1), (("id",), 5)])
def test_left_join_keeps_rows_and_fans_out(spark, spread, salts):
    left = spark.createDataFrame(LEFT, "id int, k1 string, k2 int")
    right = spark.createDataFrame(RIGHT, "r1 string, r2 int, v string")
    out = joins.left_join(left, right, {"k1": "r1", "k2": "r2"}, spread_by=spread, salts=salts)
    assert out.columns == ["id", "k1", "k2", "r1", "r2", "v"]
    found = sorted(((r.id, r.v) for r in out.collect()), key=str)
    assert found == brute_left_join(LEFT, RIGHT)


def test_left_join_random_against_brute_force(spark):
    rng = random.Random(3)
    keys = [None, "hot", "hot", "hot", "a", "b", "c"]
    left = [(i, rng.choice(keys), rng.choice([1, 2, None])) for i in range(300)]
    right = [(rng.choice(keys), rng.choice([1, 2, None]), f"v{i}") for i in range(40)]
    a = spark.createDataFrame(left, "id int, k1 string, k2 int")
    b = spark.createDataFrame(right, "r1 string, r2 int, v string")
    counts = Counter(row[1:] for row in left if None not in row)
    hot = joins.find_hot_keys(a, ["k1", "k2"], 25)
    assert {tuple(r) for r in hot.collect()} == {k for k, n in counts.items() if n >= 25} != set()
    none = joins.find_hot_keys(a, ["k1", "k2"], 1000)
    for salts, keys in ((1, None), (4, None), (4, hot), (1, hot), (4, none)):
        out = joins.left_join(a, b, {"k1": "r1", "k2": "r2"}, spread_by=["id"], salts=salts, hot=keys)
        assert out.columns == ["id", "k1", "k2", "r1", "r2", "v"]
        found = sorted(((r.id, r.v) for r in out.select("id", "v").collect()), key=str)
        assert found == brute_left_join(left, right)


@pytest.mark.parametrize("keys", [False, True])
def test_repeated_right_rows_are_never_broadcast(spark, keys):
    """The estimate knows nothing of the repeats: a right side just below the limit would be several times as large."""
    left = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    right = spark.range(3).select(F.col("id").alias("r"))
    hot = left.select("k").distinct() if keys else None
    out = joins.left_join(left, right, {"k": "r"}, spread_by=["id"], salts=4, hot=hot)
    assert out.count() == 100
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[[^\n]*_part", plan)


def test_salts_need_columns(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        joins.left_join(df, df.withColumnRenamed("id", "r"), {"id": "r"}, salts=3)


def shuffled(spark, **conf):
    """Session settings under which small test joins shuffle, restored afterwards."""
    class Scope:
        def __enter__(self):
            settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", **conf}
            self.old = {k: spark.conf.get(k, None) for k in settings}
            for k, v in settings.items():
                spark.conf.set(k, v)

        def __exit__(self, *_):
            for k, v in self.old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return Scope()


def test_null_keys_do_not_meet_in_one_task(spark):
    left = spark.range(4000).select("id", F.lit(None).cast("string").alias("k"))
    right = spark.createDataFrame([("a", 1)], "r string, v int")
    with shuffled(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = joins.left_join(left, right, {"k": "r"}, spread_by=["id"])
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 4000
    assert max(r["count"] for r in sizes) < 2000


def test_hot_key_is_salted_over_tasks(spark):
    left = spark.range(4000).select("id", F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "r string, v int")
    with shuffled(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = joins.left_join(left, right, {"k": "r"}, spread_by=["id"], salts=16)
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 4000
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 3500


def test_only_hot_keys_are_split(spark):
    """One key holds a third of the rows: its rows spread, the right side hardly grows."""
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    right = spark.range(3000).select(F.col("id").alias("r"), F.lit("v").alias("v"))
    with shuffled(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        hot = joins.find_hot_keys(left, ["k"], 500)
        out = joins.left_join(left, right, {"k": "r"}, spread_by=["id"], salts=16, hot=hot)
        sizes = out.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
        assert hot.count() == 1 and out.where("v = 'v'").count() == 3000
    assert sum(r["count"] for r in sizes) == 1000
    assert max(r["count"] for r in sizes) < 700


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A key with a third of all rows: the join of that partition runs as several tasks."""
    big = spark.range(300_000, numPartitions=16)
    left = big.select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).alias("k"))
    right = spark.range(500).select(F.col("id").alias("r"), (F.col("id") * 2).alias("v"))
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    with shuffled(spark, **conf):
        out = joins.left_join(left, right, {"k": "r"}, spread_by=["id"])
        result = out.agg(F.count(F.lit(1)), F.sum("v"))
        assert result.collect()[0][0] == 300_000
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_within_limit(spark):
    small = spark.range(10)
    assert joins.estimated_bytes(small) == 80
    assert "broadcast" in joins.broadcast_if_small(small)._jdf.queryExecution().logical().toString()
    assert joins.broadcast_if_small(small, 79) is small


def test_star_join_with_and_without_broadcast(spark, rows, monkeypatch):
    fact = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, fk int")
    dim = spark.createDataFrame([(5, "five"), (6, "six")], "k int, name string")
    expected = [(1, "five"), (2, None), (3, None)]
    assert rows(joins.star_join(fact, (dim, "fk", "k"), spread_by=["id"]).select("id", "name")) == expected
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df: df)
    assert rows(joins.star_join(fact, (dim, "fk", "k"), spread_by=["id"]).select("id", "name")) == expected


def test_orphans_ignore_null_codes(spark, rows):
    fact = spark.createDataFrame([("ZZ",), ("ZZ",), ("CA",), (None,), ("99",)], "s string")
    states = spark.createDataFrame([("CA",), ("99",)], "Code string")
    assert rows(joins.orphans(fact, "s", states, "Code")) == [("ZZ", 2)]


# --- clean ------------------------------------------------------------------------------------


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [(1, 10, "free"), (1, 20, "paid"), (1, 20, "aaa"), (2, None, "x"), (2, 5, "y"), (3, None, "z")],
        "u int, ts int, level string",
    )
    assert rows(clean.latest_per_key(df, ["u"], ["ts"])) == [(1, 20, "paid"), (2, 5, "y"), (3, None, "z")]


def test_latest_per_key_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a")], "u int, ts int, level string")
    plan = clean.latest_per_key(df, ["u"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_one_per_key_is_deterministic(spark, rows):
    data = [("a", 2, "y"), ("a", 1, "z"), ("a", 1, "b"), ("c", None, None)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, n int, t string").repartition(3)
        assert rows(clean.one_per_key(df, ["k"])) == [("a", 1, "b"), ("c", None, None)]


def test_drop_rows_missing_all(spark, rows):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None), (None, None), (NAN, "b")], "x double, y string")
    kept = clean.drop_rows_missing_all(df, ["x", "y"])
    assert [r[1] for r in rows(kept)] == ["a", "b"]


def test_distinct_values(spark, rows):
    df = spark.createDataFrame([(1, 2), (2, None), (None, 1), (None, None), (3, 3)], "a int, b int")
    assert rows(clean.distinct_values(df, ["a", "b"], "v")) == [(1,), (2,), (3,)]


def test_cast_columns(spark):
    df = spark.createDataFrame([("12.0", "abc", 7)], "a string, `b c` string, d int")
    out = clean.cast_columns(df, ints=["a", "b c"], doubles=[], texts=["d"])
    assert out.first()[:] == (12, None, "7")


def test_fill_zero_only_fills_the_subset(spark):
    df = spark.createDataFrame([(None, None)], "a int, b double")
    assert clean.fill_zero(df, ["a"]).first()[:] == (0, None)


# --- aggregates -------------------------------------------------------------------------------


def test_pivot_has_every_listed_column(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "other", 5)], "k string, r string, n int")
    out = aggregates.pivot_sum(df, ["k"], "r", {"x": "ex", "y": "why"}, "n")
    assert out.columns == ["k", "ex", "why"]
    assert rows(out) == [("a", 3, None), ("b", None, None)]
    same = df.groupBy("k").agg(*aggregates.sum_where("n", "r", {"x": "ex", "y": "why"}))
    assert rows(same) == rows(out)


# --- identity ---------------------------------------------------------------------------------


@pytest.mark.parametrize("n, parts, start", [(0, 3, 0), (1, 4, 0), (1000, 7, 0), (50, 60, 10)])
def test_dense_ids(spark, n, parts, start):
    out = with_dense_id(spark.range(n, numPartitions=parts), "key", start)
    assert sorted(r.key for r in out.collect()) == list(range(start, start + n))
    assert out.select("id").distinct().count() == n


def test_stored_rows_are_numbered_where_they_lie(spark, path):
    spark.range(100, numPartitions=3).write.parquet(f"{path}/stored")
    stored = spark.read.parquet(f"{path}/stored")
    out = number_stored_rows(stored, "key")
    assert sorted(r.key for r in out.collect()) == list(range(100))
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_numbers_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(identity, "BROADCAST_FILES", 0)
    out = with_dense_id(spark.range(100, numPartitions=3), "key")
    assert sorted(r.key for r in out.collect()) == list(range(100))


def test_dense_ids_stay_the_same_when_read_twice(spark):
    shuffled_rows = spark.range(500).repartition(5)
    out = with_dense_id(shuffled_rows, "key")
    assert sorted(out.collect()) == sorted(out.collect())


# --- profile and quality ----------------------------------------------------------------------

PROFILED = [(1, "a", 1.0), (1, None, NAN), (2, "b", None), (None, "c", 2.0), (None, None, NAN)]


@pytest.fixture
def profiled(spark):
    return spark.createDataFrame(PROFILED, "k int, `the text` string, x double")


def test_missing_counts(profiled):
    assert profile.missing_counts(profiled).first().asDict() == {"k": 2, "the text": 2, "x": 3}


def test_missing_profile(profiled, rows):
    assert rows(profile.missing_profile(profiled)) == [
        ("k", 2, 5, 40.0), ("the text", 2, 5, 40.0), ("x", 3, 5, 60.0)
    ]


def test_missing_profile_of_nothing(profiled, rows):
    empty = profiled.where("false")
    assert [r[1:] for r in rows(profile.missing_profile(empty))] == [(0, 0, None)] * 3


def test_sparse_columns_use_a_strict_threshold(profiled):
    assert profile.sparse_columns(profiled, 60.0) == []
    assert profile.drop_sparse_columns(profiled, 50.0).columns == ["k", "the text"]


def test_duplicates_and_missing_keys(profiled):
    assert profile.duplicate_count(profiled, ["k"]).first()[:] == (5, 3, 2)
    assert profile.duplicate_count(profiled.where("false"), ["k"]).first()[:] == (0, 0, 0)
    assert profile.missing_key_count(profiled, ["k"]).first()[:] == (5, 2)
    assert profile.missing_key_count(profiled, ["k", "x"]).first()[:] == (5, 1)
    assert profile.table_profile(profiled, ["k"], ["x"]).first()[:] == (5, 2, 3)


def test_duplicate_count_agrees_with_drop_duplicates(profiled):
    for key in (["k"], ["k", "the text"], ["x"]):
        expected = profiled.count() - profiled.dropDuplicates(key).count()
        assert profile.duplicate_count(profiled, key).first().n_duplicates == expected


def test_checks_report_and_enforce(spark, profiled, rows):
    report = quality.union_reports(
        quality.row_counts({"t": profiled, "none": profiled.where("false")}),
        quality.unique(profiled, "t", ["k"]),
        quality.not_null(profiled, "t", ["k", "the text"]),
        quality.max_length(profiled, "t", {"the text": 1}),
        quality.completeness(profiled, profiled.limit(3), "t"),
        quality.completeness(5, profiled, "known"),
    )
    assert rows(report) == [
        ("known", "completeness", 0, True),
        ("none", "row_count", 0, False),
        ("t", "completeness", 2, False),
        ("t", "max_length(the text)", 0, True),
        ("t", "not_null(k)", 2, False),
        ("t", "not_null(the text)", 2, False),
        ("t", "row_count", 5, True),
        ("t", "unique(k)", 2, False),
    ]
    with pytest.raises(quality.QualityError) as failure:
        quality.enforce(report)
    assert "none: row_count = 0" in str(failure.value) and "known" not in str(failure.value)
    passing = quality.row_counts({"t": profiled})
    assert rows(quality.enforce(passing)) == rows(passing)


def test_unreadable_table_is_named(spark):
    with pytest.raises(quality.QualityError, match="absent"):
        quality.readable("absent", lambda: spark.table("absent_table"))


def test_referential(spark):
    fact = spark.createDataFrame([("ZZ",), ("CA",), (None,)], "s string")
    states = spark.createDataFrame([("CA",)], "Code string")
    assert quality.referential(fact, "f", "s", states, "Code").first()[:] == ("f", "referential(s)", 1, False)


def test_contract_checks(spark, rows):
    songs = spark.createDataFrame(
        [("s" * 31, "a", 1), ("s1", None, 1), ("s1", "b", 2)], "song_id string, artist_id string, id int"
    ).withColumn("staging_song_id", F.col("id"))
    found = {r[1]: r[2:] for r in rows(quality.contract_checks(songs, CONTRACTS["staging_songs"]))}
    assert found == {
        "row_count": (3, True),
        "not_null(staging_song_id)": (0, True),
        "max_length(song_id)": (1, False),
        "max_length(artist_id)": (0, True),
        "unique(staging_song_id)": (1, False),
    }


def test_distinct_rows_shuffles_whole_rows_only_where_they_repeat(spark, rows):
    schema = "a string, b string, c decimal(18,5)"
    some = [("x", None, None), (None, "x", None), ("x", None, None), ("y", "z", None), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(some, schema)
    assert rows(clean.distinct_rows(df)) == rows(df.distinct())
    assert clean.distinct_rows(df.limit(0)).count() == 0
    many = spark.range(1000).select("id", F.lit("a text").alias("text"))
    plan = clean.distinct_rows(many)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1  # over the repeated rows, which are picked first
    whole = plan[plan.index("Aggregate"):]
    assert "LeftSemi" in whole
