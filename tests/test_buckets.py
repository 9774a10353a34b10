"""Tables stored by a key, and joins over them that move no row."""

import pytest
from pyspark.sql import functions as F

from starloom.operators import joins
from starloom.sinks import buckets
from starloom.sinks.buckets import APART, bucket_spec, bucketed_left_join, load_bucketed


@pytest.fixture
def database(spark, path):
    spark.sql(f"CREATE DATABASE buckets LOCATION '{path}/db'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield "buckets"
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP DATABASE buckets CASCADE")


def frames(spark):
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).cast("long")
    left = spark.range(2000).select("id", key.alias("k"))
    right = spark.range(40).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("v"))
    return left, right.union(spark.sql("SELECT 1L, -1L UNION ALL SELECT NULL, 5L"))


def loaded(spark, path, hot_rows=None, n_left=4, n_right=4):
    left, right = frames(spark)
    assert load_bucketed(left, "buckets.l", ["k"], n_left, location=f"{path}/l", hot_rows=hot_rows) == 2000
    assert load_bucketed(right, "buckets.r", ["rk"], n_right, location=f"{path}/r") == 42
    return left, right


@pytest.mark.parametrize("hot_rows", [None, 300])
@pytest.mark.parametrize("small", [True, False])
def test_join_equals_the_plain_one(spark, path, database, rows, monkeypatch, hot_rows, small):
    if not small:
        for module in (joins, buckets):
            monkeypatch.setattr(module, "broadcast_if_small", lambda df, limit=0: df)
    left, right = loaded(spark, path, hot_rows)
    found = bucketed_left_join(spark, "buckets.l", "buckets.r", {"k": "rk"}, spread_by=["id"])
    assert rows(found) == rows(left.join(right, left["k"] == right["rk"], "left"))
    assert found.columns == ["id", "k", "rk", "v"]


def test_no_exchange_and_hot_rows_in_ordinary_splits(spark, path, database):
    loaded(spark, path, hot_rows=300)
    apart = spark.table("buckets.l").where(APART).groupBy("k").count().collect()
    assert {r.k for r in apart} == {1, None}
    found = bucketed_left_join(spark, "buckets.l", "buckets.r", {"k": "rk"}, spread_by=["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in plan and "Bucketed: false" in plan
    folder = spark.table("buckets.l").where(f"NOT {APART}").inputFiles()
    assert len(folder) <= 4  # one file a bucket


def test_a_load_replaces_the_rows_of_the_last(spark, path, database, rows):
    left, right = loaded(spark, path, hot_rows=300)
    old = spark.table("buckets.l").inputFiles()
    assert load_bucketed(left.where("k = 2"), "buckets.l", ["k"], 4, location=f"{path}/l") == left.where("k = 2").count()
    assert rows(spark.table("buckets.l").drop(APART)) == rows(left.where("k = 2"))
    assert not set(old) & set(spark.table("buckets.l").inputFiles())
    assert load_bucketed(left.limit(0), "buckets.l", ["k"], 4, location=f"{path}/l") == 0
    assert spark.table("buckets.l").count() == 0
    assert bucketed_left_join(spark, "buckets.l", "buckets.r", {"k": "rk"}, spread_by=["id"]).count() == 0
    assert {r.tableName for r in spark.sql("SHOW TABLES IN buckets").collect()} == {"l", "r"}


def test_a_load_that_fails_changes_nothing(spark, path, database):
    left, _ = loaded(spark, path)
    broken = left.withColumn("id", F.when(F.col("id") < 1990, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        load_bucketed(broken, "buckets.l", ["k"], 4, location=f"{path}/l")
    assert spark.table("buckets.l").count() == 2000
    assert {r.tableName for r in spark.sql("SHOW TABLES IN buckets").collect()} == {"l", "r"}


def test_tables_that_do_not_fit(spark, path, database):
    left, right = loaded(spark, path, n_right=8)
    assert bucket_spec(spark, "buckets.l") == (("k",), 4)
    with pytest.raises(ValueError, match="not alike"):
        bucketed_left_join(spark, "buckets.l", "buckets.r", {"k": "rk"}, spread_by=["id"])
    with pytest.raises(ValueError, match="is stored by"):
        load_bucketed(left, "buckets.l", ["k"], 8, location=f"{path}/l")
    with pytest.raises(ValueError, match="other columns"):
        load_bucketed(left.withColumn("id", F.col("id").cast("int")), "buckets.l", ["k"], 4, location=f"{path}/l")
    with pytest.raises(ValueError, match="added by the load"):
        load_bucketed(left.withColumn(APART, F.lit(True)), "buckets.x", ["k"], 4, location=f"{path}/x")
    narrow = right.select(F.col("rk").cast("int"), "v")
    load_bucketed(narrow, "buckets.n", ["rk"], 4, location=f"{path}/n")
    with pytest.raises(ValueError, match="other types"):
        bucketed_left_join(spark, "buckets.l", "buckets.n", {"k": "rk"}, spread_by=["id"])


def test_buckets_follow_the_size(spark, path, database, monkeypatch):
    left, _ = frames(spark)
    monkeypatch.setattr(buckets, "BUCKET_BYTES", 2000)
    assert buckets.bucket_count(left) == 16 and buckets.bucket_count(left, least=20) == 20
    named = left.select("id", F.when(F.col("id") < 1000, "four").alias("name"))
    assert buckets.bucket_count(named) == 18 and buckets.bucket_count(left.limit(0)) == 1
    wide = left.select("id", F.col("id").alias("k"))
    load_bucketed(wide, "buckets.w", ["k"], 16, location=f"{path}/w")
    written = spark.table("buckets.w").groupBy(F.input_file_name()).count().collect()
    assert len(written) == 16 and max(r["count"] for r in written) < 200  # a task each, none has two buckets


def test_a_key_too_large_for_a_task_is_stored_apart_in_any_case(spark, path, database, rows, monkeypatch):
    monkeypatch.setattr(buckets, "APART_ROWS", 300)
    left, right = loaded(spark, path)
    assert {r.k for r in spark.table("buckets.l").where(APART).select("k").distinct().collect()} == {1, None}
    found = bucketed_left_join(spark, "buckets.l", "buckets.r", {"k": "rk"}, spread_by=["id"])
    assert rows(found) == rows(left.join(right, left["k"] == right["rk"], "left"))
