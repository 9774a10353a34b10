"""Merged monthly sketches against exact counts: nulls, NaN, empty tables, a reloaded month, plan."""

import math

from pyspark.sql import functions as F

from starloom.operators.sketches import DISTINCT_ERROR, RANK_ERROR, column_sketches, merged_profile
from starloom.sinks.parquet import write_parquet

SCHEMA = "month int, code int, name string, price double, day date, empty string"


def made(spark, n=20000):
    df = spark.range(n)
    return df.select(
        (F.col("id") % 3).cast("int").alias("month"), (F.col("id") % 5000).cast("int").alias("code"),
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("n"), F.col("id") % 70)).alias("name"),
        F.when(F.col("id") % 4 == 0, float("nan")).when(F.col("id") % 4 > 1, F.col("id") / 2).alias("price"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("day"), F.lit(None).cast("string").alias("empty"),
    )


def profile(sketches):
    return {r.column_name: r for r in merged_profile(sketches, (0.1, 0.5)).collect()}


def test_merged_months_are_close_to_exact_counts(spark):
    df = made(spark)
    found = profile(column_sketches(df, ["month"]))
    exact = {"code": 5000, "name": 63, "price": 10000, "day": 365, "empty": 0}
    assert {c: r.n_rows for c, r in found.items()} == dict.fromkeys(exact, 20000)
    assert {c: r.n_missing for c, r in found.items()} == {"code": 0, "name": 2000, "price": 10000, "day": 0, "empty": 20000}
    for c, n in exact.items():
        assert abs(found[c].n_distinct - n) <= DISTINCT_ERROR * n
    assert found["name"]["q0.5"] is None and found["empty"]["q0.1"] is None
    prices = sorted(r.price for r in df.where("price is not null and not isnan(price)").collect())
    for q in (0.1, 0.5):
        place = sum(p <= found["price"][f"q{q}"] for p in prices) / len(prices)
        assert abs(place - q) <= RANK_ERROR
    assert not any(isinstance(r["q0.5"], float) and math.isnan(r["q0.5"]) for r in found.values())


def test_a_month_is_replaced_alone(spark, path):
    out, df = f"{path}/sketches", made(spark)
    wrong = df.withColumn("code", F.when(F.col("month") == 1, -F.col("code")).otherwise(F.col("code")))
    write_parquet(column_sketches(wrong, ["month"]), out, ["month"])
    write_parquet(column_sketches(df.where("month = 1"), ["month"]), out, ["month"], replace="partitions")
    again = profile(spark.read.parquet(out))
    once = profile(column_sketches(df, ["month"]))
    assert again["code"].n_distinct == once["code"].n_distinct and again["price"]["q0.5"] is not None


def test_nothing_and_one_column(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert column_sketches(nothing, ["month"]).count() == 0 and profile(column_sketches(nothing, ["month"])) == {}
    one = column_sketches(spark.createDataFrame([(1, 2, "a", None, None, None)], SCHEMA), ["month"], ["code", "price"])
    found = profile(one)
    assert (found["code"].n_distinct, found["code"]["q0.5"], found["price"].n_missing, found["price"]["q0.5"]) == (1, 2.0, 1, None)


def test_values_are_not_shuffled(spark):
    plan = column_sketches(made(spark), ["month"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(month" in plan
