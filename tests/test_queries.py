"""Every registered query against its SQL twin on the small tables."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as driver
from starloom.workload.registry import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, oracle, name):
    df = driver.queries()[name](spark, SF_DIR)
    expected = oracle.sql(ORACLE_SQL[name]).to_arrow_table()
    assert compare(df.toArrow(), expected) is None
    plan = df._jdf.queryExecution().toString()
    for unwanted in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["n_name", "order_year", "n_orders"]
    assert result.count() > 0


def test_compare_sees_differences(oracle):
    one = oracle.sql("SELECT 1 AS a, 'x' AS b").to_arrow_table()
    assert compare(one, oracle.sql("SELECT 'x' AS b, 1 AS a").to_arrow_table()) is None
    for other in ("SELECT 2 AS a, 'x' AS b", "SELECT 1::BIGINT AS a, 'x' AS b", "SELECT 1 AS a",
                  "SELECT 1 AS a, 'x' AS b UNION ALL SELECT 1, 'x'"):
        assert compare(one, oracle.sql(other).to_arrow_table()) is not None
