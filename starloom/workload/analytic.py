"""Queries over the analytic questions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starloom.plans import analytics
from starloom.plans import songplays as music
from starloom.plans.country import build_country
from starloom.plans.cube import Cube, load_cube
from starloom.plans.immigration import build_immigration
from starloom.session import scratch_path
from starloom.workload import frames
from starloom.workload.registry import ORACLE_SQL, query, table


def _fact(spark, sf):
    return build_immigration(frames.arrivals_raw(spark, sf))


def _country(spark, sf):
    return build_country(
        frames.temperature_readings(spark, sf),
        frames.country_codes(spark, sf),
        temperature_names=frames.READING_NAMES,
        code_names=frames.CODE_NAMES,
    )


_STAR = f"WITH {frames.ARRIVALS_SQL}, {frames.COUNTRY_SQL}"


@query(
    "fact_filter_left_join",
    """SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_orders
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderstatus = 'F' GROUP BY 1, 2""",
)
def fact_filter_left_join(spark, sf):
    """Filtered fact joined to its dimensions, counted per name and year.

    A customer has few orders in a year, so counting them before the join would shuffle about as
    many rows once more; the count is combined per task after the join instead.
    """
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        analytics.star_join(
            orders.select("o_custkey", "o_orderdate"),
            (customer, "o_custkey", "c_custkey"),
            (nation, "c_nationkey", "n_nationkey"),
            spread_by=["o_orderdate"],
        )
        .groupBy("n_name", F.year("o_orderdate").alias("order_year"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


@query(
    "arrivals_by_country",
    f"""{_STAR} SELECT CountryName, i94yr, i94mon, count(*) AS arrivals
    FROM fact LEFT JOIN country ON i94res = Code GROUP BY ALL""",
)
def arrivals_by_country(spark, sf):
    return analytics.arrivals_by_country(_fact(spark, sf), _country(spark, sf))


@query(
    "arrivals_by_country_period",
    f"""{_STAR} SELECT CountryName, i94yr, i94mon, count(*) AS arrivals
    FROM fact LEFT JOIN country ON i94res = Code WHERE i94yr BETWEEN 1996 AND 1998 GROUP BY ALL""",
)
def arrivals_by_country_period(spark, sf):
    return analytics.arrivals_by_country(_fact(spark, sf), _country(spark, sf), (1996, 1998))


@query(
    "arrivals_by_visa",
    f"""WITH {frames.ARRIVALS_SQL} SELECT i94visa,
      CASE i94visa WHEN 1 THEN 'business' WHEN 2 THEN 'pleasure' ELSE 'student' END AS visa,
      count(*) AS arrivals FROM fact GROUP BY ALL""",
)
def arrivals_by_visa(spark, sf):
    return analytics.arrivals_by_visa(_fact(spark, sf))


@query(
    "arrivals_by_mode",
    f"""WITH {frames.ARRIVALS_SQL} SELECT i94mode,
      CASE i94mode WHEN 1 THEN 'air' WHEN 2 THEN 'sea' WHEN 3 THEN 'land' ELSE 'not reported' END
        AS "mode", count(*) AS arrivals FROM fact GROUP BY ALL""",
)
def arrivals_by_mode(spark, sf):
    return analytics.arrivals_by_mode(_fact(spark, sf))


@query(
    "arrivals_by_climate",
    f"""{_STAR} SELECT CASE WHEN Temperature IS NULL THEN 'unknown'
      WHEN Temperature < 440000 THEN 'cold' WHEN Temperature < 450000 THEN 'cool'
      WHEN Temperature < 460000 THEN 'mild' ELSE 'warm' END AS climate, count(*) AS arrivals
    FROM fact LEFT JOIN country ON i94res = Code GROUP BY ALL""",
)
def arrivals_by_climate(spark, sf):
    bounds = ((440000.0, "cold"), (450000.0, "cool"), (460000.0, "mild"))
    return analytics.arrivals_by_climate(_fact(spark, sf), _country(spark, sf), bounds)


@query(
    "visitor_stats",
    f"""WITH {frames.ARRIVALS_SQL} SELECT gender, count(*) AS visitors, avg(i94bir) AS avg_age,
      min(i94bir) AS min_age, max(i94bir) AS max_age FROM fact GROUP BY gender""",
)
def visitor_stats(spark, sf):
    return analytics.visitor_stats(_fact(spark, sf))


@query(
    "origin_by_state",
    f"""{_STAR}, state AS (
      SELECT 'R' || n_regionkey AS StateCode, count(*) AS TotalPopulation,
        CAST(sum(c_custkey % 2) AS BIGINT) AS ForeignBorn,
        max(round(c_acctbal * 100)) AS MedianAge
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
    pair AS (SELECT i94res, i94addr, count(*) AS n FROM fact GROUP BY ALL)
    SELECT CountryName, CAST(sum(n) AS BIGINT) AS arrivals,
      count(StateCode) AS state_pairs,
      sum(MedianAge * n) / CAST(sum(n) FILTER (MedianAge IS NOT NULL) AS DOUBLE)
        AS mean_median_age,
      CAST(sum(ForeignBorn * n) AS DOUBLE)
        / CAST(sum(n) FILTER (ForeignBorn IS NOT NULL) AS DOUBLE) AS mean_foreign_born,
      CAST(sum(TotalPopulation * n) AS DOUBLE)
        / CAST(sum(n) FILTER (TotalPopulation IS NOT NULL) AS DOUBLE) AS mean_population
    FROM pair LEFT JOIN country ON i94res = Code LEFT JOIN state ON i94addr = StateCode
    GROUP BY CountryName""",
)
def origin_by_state(spark, sf):
    return _origin_by_state(spark, sf, _fact(spark, sf))


def _origin_by_state(spark, sf, fact):
    state = (
        table(spark, sf, "customer")
        .groupBy("c_nationkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("c_custkey") % 2).alias("odd"),
            F.max(F.round(F.col("c_acctbal") * 100)).alias("top"),
        )
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("StateCode"))
        .agg(
            F.sum("n").alias("TotalPopulation"),
            F.sum("odd").alias("ForeignBorn"),
            F.max("top").alias("MedianAge"),
        )
    )
    return analytics.origin_by_state(fact, _country(spark, sf), state)


@query(
    "song_plays",
    f"""{frames.PLAYS_SQL} SELECT p.song_id, s.title, s.artist_name AS artist, count(*) AS plays
    FROM play p LEFT JOIN song s ON p.song_id = s.song_id GROUP BY ALL""",
)
def song_plays(spark, sf):
    log, songs = frames.log_events(spark, sf), frames.song_metadata(spark, sf)
    return analytics.song_plays(
        music.build_songplays(log, songs, key=None),
        music.build_songs(songs),
        music.build_artists(songs),
    )


# --- the same questions, answered from the cube ---------------------------------------------------


def _cube(spark, sf) -> Cube:
    """A cube that was loaded from wrong months, which were then loaded again: all of 1996 came twice."""
    path, database = scratch_path(spark, "cube"), f"starloom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}/database'")
    fact, again = _fact(spark, sf), F.col("i94yr") == 1996
    load_cube(spark, fact.union(fact.where(again)), f"{path}/cube", database)
    load_cube(spark, fact.where(again), f"{path}/cube", database, months_only=True)
    return Cube(spark.table(f"{database}.arrivals_cube"))


@query("cube_arrivals_by_country", ORACLE_SQL["arrivals_by_country"])
def cube_arrivals_by_country(spark, sf):
    return analytics.arrivals_by_country(_cube(spark, sf), _country(spark, sf))


@query("cube_arrivals_by_country_period", ORACLE_SQL["arrivals_by_country_period"])
def cube_arrivals_by_country_period(spark, sf):
    return analytics.arrivals_by_country(_cube(spark, sf), _country(spark, sf), (1996, 1998))


@query("cube_arrivals_by_visa", ORACLE_SQL["arrivals_by_visa"])
def cube_arrivals_by_visa(spark, sf):
    return analytics.arrivals_by_visa(_cube(spark, sf))


@query("cube_arrivals_by_mode", ORACLE_SQL["arrivals_by_mode"])
def cube_arrivals_by_mode(spark, sf):
    return analytics.arrivals_by_mode(_cube(spark, sf))


@query("cube_arrivals_by_climate", ORACLE_SQL["arrivals_by_climate"])
def cube_arrivals_by_climate(spark, sf):
    bounds = ((440000.0, "cold"), (450000.0, "cool"), (460000.0, "mild"))
    return analytics.arrivals_by_climate(_cube(spark, sf), _country(spark, sf), bounds)


@query("cube_visitor_stats", ORACLE_SQL["visitor_stats"])
def cube_visitor_stats(spark, sf):
    return analytics.visitor_stats(_cube(spark, sf))


@query("cube_origin_by_state", ORACLE_SQL["origin_by_state"])
def cube_origin_by_state(spark, sf):
    return _origin_by_state(spark, sf, _cube(spark, sf))
