"""The cube answers as the fact does: null codes, several months, a reloaded month, and never the fact itself."""

import pytest
from pyspark.sql import functions as F

from starloom.plans import analytics
from starloom.plans.cube import Cube, build_cube
from starloom.plans.jobs import arrivals_job

FACT = "i94res int, i94addr string, i94visa int, i94mode int, gender string, i94bir int, i94yr int, i94mon int"


@pytest.fixture
def fact(spark):
    rows = [
        (i % 4 or None, "OH" if i % 3 else None, i % 3 + 1, (1, 2, 9, None)[i % 4], ("F", "M", None)[i % 3], None if i % 7 == 0 else i % 50, 2016, 4 + i % 3)
        for i in range(200)
    ]
    return spark.createDataFrame(rows, FACT)


@pytest.fixture
def dimensions(spark):
    country = spark.createDataFrame([(1, "Albania", 12.0), (2, "Japan", None)], "Code int, CountryName string, Temperature double")
    state = spark.createDataFrame([("OH", 40.0, 5, 100)], "StateCode string, MedianAge double, ForeignBorn bigint, TotalPopulation bigint")
    return country, state


def test_every_question_has_the_same_answer(fact, dimensions, rows):
    country, state = dimensions
    cube = Cube(build_cube(fact))
    for ask in (
        lambda f: analytics.arrivals_by_country(f, country),
        lambda f: analytics.arrivals_by_country(f, country, (2016, 2016)),
        analytics.arrivals_by_visa,
        analytics.arrivals_by_mode,
        lambda f: analytics.arrivals_by_climate(f, country),
        analytics.visitor_stats,
        lambda f: analytics.origin_by_state(f, country, state),
    ):
        assert rows(ask(cube)) == rows(ask(fact)) != []
    with pytest.raises(ValueError, match="no set"):
        cube.counts("i94visa", "i94mode")
    assert rows(analytics.arrivals_by_visa(Cube(build_cube(fact.limit(0))))) == []


def test_one_pass_over_the_fact(fact):
    plan = build_cube(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Scan") == 1


def test_a_reloaded_month_replaces_its_own_rows_and_the_fact_is_not_read(spark, path, rows):
    from test_storage import arrivals_input, record

    spark.sql(f"CREATE DATABASE cubes LOCATION '{path}/db'")
    both = [record(1, 20545, 4, gender="F", i94visa="1.0"), record(2, 20580, 5, gender="M", i94visa="2.0")]
    arrivals_job(spark, database="cubes", cube=True, **arrivals_input(path, both))
    may = [record(3, 20581, 5, gender="M", i94visa="3.0"), record(4, 20582, 5, i94visa="3.0")]
    arrivals_job(spark, database="cubes", cube=True, reload="partitions", **arrivals_input(path, may))
    cube = Cube(spark.table("cubes.arrivals_cube"))
    answer = analytics.arrivals_by_visa(cube)
    assert rows(answer) == rows(analytics.arrivals_by_visa(spark.table("cubes.immigration")))
    assert rows(answer.select("i94visa", "arrivals")) == [(1, 1), (3, 2)]
    read = {r.f.split("/")[-5] for r in cube.rows.select(F.col("_metadata.file_path").alias("f")).collect()}
    assert read == {"arrivals_cube.versions"}
    assert "immigration.versions" not in answer._jdf.queryExecution().toString()
    spark.sql("DROP DATABASE cubes CASCADE")
