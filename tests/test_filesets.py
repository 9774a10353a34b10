"""File sets whose members have other columns and types, and the arrivals job over them."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.rejects import RejectedError
from starloom.plans.jobs import arrivals_job
from starloom.sources.filesets import SchemaConflict, members, month_report, read_set, scan_set, set_report, wider


@pytest.mark.parametrize(
    "a, b, both",
    [
        (T.ByteType(), T.LongType(), T.LongType()),
        (T.IntegerType(), T.DoubleType(), T.DoubleType()),
        (T.LongType(), T.DoubleType(), None),
        (T.IntegerType(), T.FloatType(), T.DoubleType()),
        (T.FloatType(), T.DoubleType(), T.DoubleType()),
        (T.LongType(), T.DecimalType(18, 5), T.DecimalType(24, 5)),
        (T.DecimalType(38, 0), T.DecimalType(10, 5), None),
        (T.DecimalType(10, 2), T.DoubleType(), None),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.NullType(), T.DateType(), T.DateType()),
        (T.StringType(), T.IntegerType(), None),
    ],
)
def test_common_types_lose_nothing(a, b, both):
    assert wider(a, b) == both == wider(b, a)


def months(spark, path):
    spark.sql("SELECT 1 AS id, 1.5D AS x, 16 AS y, 4 AS m").write.parquet(f"{path}/i94_apr16_sub")
    spark.sql("SELECT 16 AS y, 5 AS m, 3000000000L AS ID, 'n' AS note").write.parquet(f"{path}/i94_may16_sub")
    spark.sql("SELECT 16 AS y, 5 AS m, 3000000001L AS ID, 'o' AS note").write.parquet(f"{path}/i94_jun16_sub")
    spark.range(1).write.parquet(f"{path}/other")


def test_columns_are_found_by_name_and_widened(spark, path, rows):
    months(spark, path)
    assert [m.rsplit("/", 1)[-1] for m in members(spark, path)] == ["i94_apr16_sub", "i94_jun16_sub", "i94_may16_sub"]
    found = scan_set(spark, path, required=["id"])
    assert len(found.groups()) == 2
    df = read_set(spark, found)
    assert rows(df.select("id", "x", "note", "source_month", "source_year")) == sorted(
        [(1, 1.5, None, 4, 16), (3000000000, None, "n", 5, 16), (3000000001, None, "o", 6, 16)]
    )
    report = {r.column_name: (r.n_members, r.n_missing, r.held_types, r.read_type) for r in set_report(spark, found).collect()}
    assert report["id"] == (3, 0, ["bigint", "int"], "bigint")
    assert report["x"] == (1, 2, ["double"], "double")
    assert rows(month_report(df, F.col("y"), F.col("m"))) == [(16, 4, 1, 0, 0), (16, 5, 1, 0, 0), (16, 6, 1, 1, 0)]


def test_one_scan_per_layout_reads_the_columns_wanted(spark, path):
    months(spark, path)
    plan = read_set(spark, scan_set(spark, path), ["note"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted("note:string" in r for r in read) == [False, True]
    assert not any(re.search(r"\b(id|x|y|m):", r, re.IGNORECASE) for r in read)


def test_a_set_that_does_not_fit(spark, path, rows):
    spark.sql("SELECT 1L AS a").write.parquet(f"{path}/x_jan20")
    spark.sql("SELECT 2.5D AS a, 1 AS b").write.parquet(f"{path}/x_feb20")
    with pytest.raises(SchemaConflict, match="no exact common type"):
        scan_set(spark, path)
    with pytest.raises(SchemaConflict, match=r"x_jan20: missing columns \['b'\]"):
        scan_set(spark, path, required=["b"], on_conflict="text")
    text = scan_set(spark, path, on_conflict="text")
    assert text.conflicts == ("a",)
    assert rows(read_set(spark, text).select("a", "b")) == [("1", None), ("2.5", 1)]
    with pytest.raises(FileNotFoundError):
        scan_set(spark, f"{path}/nothing*")


def test_empty_members_and_a_single_file(spark, path, rows):
    spark.range(0).write.parquet(f"{path}/x_jan20")
    df = read_set(spark, scan_set(spark, f"{path}/x_jan20"))
    assert df.columns == ["id", "source_file", "source_month", "source_year"] and rows(df) == []


def test_arrivals_by_month(spark, path, rows):
    from test_storage import arrivals_input, put, record

    april, may = [record(1, 20545, 4), record(2, 20580, 5)], [record(3, 20580, 5)]
    inputs = arrivals_input(path, [])
    put(f"{path}/set", "i94_apr16_sub.csv", open(arrivals_input(f"{path}/a", april)["arrivals"], encoding="utf-8").read())
    text = open(arrivals_input(f"{path}/b", may)["arrivals"], encoding="utf-8").read()
    lines = [",".join(["extra" if i == 0 else "7", *reversed(line.split(",")[:-1])]) for i, line in enumerate(text.splitlines())]
    put(f"{path}/set", "i94_may16_sub.csv", "\n".join(lines) + "\n")  # another order, one column more, no airline
    spark.sql(f"CREATE DATABASE sets LOCATION '{path}/db'")
    try:
        given = {**inputs, "arrivals": f"{path}/set", "database": "sets", "monthly": True}
        with pytest.raises(Exception, match="1 of 3 records rejected") as raised:
            arrivals_job(spark, **given)
        assert RejectedError.__name__ in str(raised.value) or "other month" in str(raised.value)
        result = arrivals_job(spark, allowed_rejects=1, **given)
        assert rows(spark.table("sets.immigration").select("cicid", "i94mon")) == [(1, 4), (3, 5)]
        assert rows(result.rejected["immigration"].select("reason")) == [("other month",)]
        lacking = result.source_schemas.where("n_missing > 0")
        assert rows(lacking.select("column_name", "n_members")) == [("airline", 1), ("extra", 1)]
    finally:
        spark.sql("DROP DATABASE sets CASCADE")
