"""The plans of the main queries: what is read, what is pushed down, how often rows are shuffled."""

import re

import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def plan_of(spark, monkeypatch):
    """Physical plan of a registered query with every join shuffled, as it is on large tables."""
    from starloom.operators import joins

    monkeypatch.setattr(joins, "broadcast_if_small", lambda df, limit=0: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: driver.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffles(plan):
    return len(re.findall(r"Exchange (?:hash|range|Round)", plan))


def scans(plan):
    return plan.count("FileScan")


def test_filter_and_columns_reach_the_scan(plan_of):
    plan = plan_of("fact_filter_left_join")
    orders = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "EqualTo(o_orderstatus,F)" in orders
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in orders


def test_unused_columns_are_not_read(plan_of):
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_returnflag:string" in plan_of("generic_scan")
    songs = [line for line in plan_of("songplays_fact").splitlines() if "part.parquet" in line]
    assert songs and not any("p_size" in line for line in songs)


@pytest.mark.parametrize(
    "name, n_scans, n_shuffles",
    [
        ("pivot_sum", 1, 1),
        ("weighted_mean", 1, 1),
        ("users_latest_event", 1, 1),
        ("drop_duplicates", 1, 1),
        ("missing_profile", 1, 0),
        ("duplicate_count", 1, 1),
        ("table_profile", 1, 1),
        ("inner_join_using", 2, 2),
        ("left_join_multi_key", 2, 2),
        ("date_dim", 2, 1),
        # Two of the shuffles join orders to customers; the rest is the query's own.
        ("date_dim_from_fact", 2, 3),
        ("city_rollup", 2, 3),
        ("city_state_rollup", 2, 4),
        ("visitor_stats", 2, 3),
    ],
)
def test_scans_and_shuffles(plan_of, name, n_scans, n_shuffles):
    plan = plan_of(name)
    assert (scans(plan), shuffles(plan)) == (n_scans, n_shuffles)


@pytest.mark.parametrize("name", ["arrivals_by_country", "arrivals_by_climate", "dq_referential"])
def test_fact_is_counted_before_it_is_joined(plan_of, name):
    plan = plan_of(name)
    join = re.search(r"SortMergeJoin \[(i94res|code)[^\n]*", plan)
    assert join and "partial_count(1)" in plan[join.end():]


@pytest.mark.parametrize("name", ["users_form_c", "drop_duplicates", "artists_dim", "identity_key"])
def test_no_ranking_window_over_the_rows(plan_of, name):
    assert "row_number" not in plan_of(name)


def test_null_keys_are_part_of_the_shuffle_key(plan_of):
    assert re.search(r"Exchange hashpartitioning\(_part#\w+, song#", plan_of("songplays_fact"))
