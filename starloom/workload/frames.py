"""The sample tables seen as the library's inputs: activity log, songs, arrivals, demographics.

Each frame has a SQL twin (a common table expression) for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.lookups import RACES
from starloom.workload.registry import table

# --- activity log: one row per line item ------------------------------------------------------


def log_events(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as staged log rows; returnflag N plays a song, line number 7 carries no song.
    A song of a PROMO part is played under another title, so that some plays match nothing.

    Customers are joined to the orders, which are fewer: line items are shuffled by order and by part, not by customer too.
    """
    taken = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    sold = (
        table(spark, sf, "lineitem")
        .join(taken, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    has_song = F.col("l_linenumber") < 7
    live = F.when(F.col("p_type") == "PROMO", " (live)").otherwise("")
    millis = (F.col("l_partkey") % 2000) * 43000 + F.col("l_linenumber") * 137
    return sold.select(
        F.when(has_song, F.col("p_brand")).alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.col("c_name").alias("first_name"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("l_linenumber").alias("item_in_session"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(has_song, F.col("p_retailprice").cast("decimal(18,5)")).alias("length"),
        F.when(F.col("l_linestatus") == "O", "paid").otherwise("free").alias("level"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("location"),
        F.lit("PUT").alias("method"),
        F.when(F.col("l_returnflag") == "N", "NextSong")
        .when(F.col("l_returnflag") == "A", "Home")
        .otherwise("Logout")
        .alias("page"),
        (F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")).cast("bigint") * 86400000).alias(
            "registration"
        ),
        F.col("l_orderkey").cast("int").alias("session_id"),
        F.when(has_song, F.concat("p_name", live)).alias("song"),
        F.lit(200).alias("status"),
        F.timestamp_add("MILLISECOND", millis, F.col("l_shipdate")).alias("ts"),
        F.concat("l_returnflag", "l_linestatus").alias("user_agent"),
        F.col("o_custkey").cast("int").alias("user_id"),
    )


LOG_SQL = """log AS (
  SELECT CASE WHEN l_linenumber < 7 THEN p_brand END AS artist,
    'Logged In' AS auth, c_name AS first_name,
    CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    l_linenumber AS item_in_session, c_mktsegment AS last_name,
    CASE WHEN l_linenumber < 7 THEN CAST(p_retailprice AS DECIMAL(18,5)) END AS length,
    CASE WHEN l_linestatus = 'O' THEN 'paid' ELSE 'free' END AS level,
    'N' || c_nationkey AS location, 'PUT' AS method,
    CASE l_returnflag WHEN 'N' THEN 'NextSong' WHEN 'A' THEN 'Home' ELSE 'Logout' END AS page,
    CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400000 AS BIGINT)
      AS registration,
    CAST(l_orderkey AS INTEGER) AS session_id,
    CASE WHEN l_linenumber < 7 THEN p_name || CASE WHEN p_type = 'PROMO' THEN ' (live)' ELSE '' END END AS song, 200 AS status,
    CAST(l_shipdate + to_milliseconds((l_partkey % 2000) * 43000 + l_linenumber * 137)
      AS TIMESTAMP) AS ts,
    l_returnflag || l_linestatus AS user_agent, CAST(o_custkey AS INTEGER) AS user_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""


def song_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """All parts as song metadata."""
    half = (F.col("p_size") / 2).cast("decimal(18,5)")
    return (
        table(spark, sf, "part")
        .select(
            F.lit(1).alias("num_songs"),
            F.concat(F.lit("A"), "p_brand").alias("artist_id"),
            F.when(F.col("p_size") % 5 > 0, half).alias("artist_latitude"),
            F.when(F.col("p_size") % 5 > 0, -half).cast("decimal(18,5)").alias("artist_longitude"),
            F.col("p_type").alias("artist_location"),
            F.col("p_brand").alias("artist_name"),
            F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("song_id"),
            F.col("p_name").alias("title"),
            F.col("p_retailprice").cast("decimal(18,5)").alias("duration"),
            (F.col("p_size") + 1960).alias("year"),
        )
    )


SONG_SQL = """song AS (
  SELECT 1 AS num_songs, 'A' || p_brand AS artist_id,
    CASE WHEN p_size % 5 > 0 THEN CAST(p_size / 2.0 AS DECIMAL(18,5)) END AS artist_latitude,
    CASE WHEN p_size % 5 > 0 THEN CAST(-p_size / 2.0 AS DECIMAL(18,5)) END AS artist_longitude,
    p_type AS artist_location, p_brand AS artist_name, 'S' || p_partkey AS song_id,
    p_name AS title, CAST(p_retailprice AS DECIMAL(18,5)) AS duration, p_size + 1960 AS year
  FROM part)"""

PLAYS_SQL = f"""WITH {LOG_SQL}, {SONG_SQL}, play AS (
  SELECT l.ts, l.user_id, l.level, s.song_id, s.artist_id, l.session_id, l.location, l.user_agent
  FROM log l LEFT JOIN song s
    ON l.song = s.title AND l.length = s.duration AND l.artist = s.artist_name
  WHERE l.page = 'NextSong')"""


# --- arrivals: one row per order --------------------------------------------------------------


def arrivals_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as arrival records the way they are delivered: every number a double, dates as days
    since 1960-01-01. Open orders (status O) have not departed.
    """
    taken = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    day = F.datediff("o_orderdate", F.lit("1960-01-01").cast("date"))
    status = F.col("o_orderstatus")
    priority = F.substring("o_orderpriority", 1, 1).cast("int")

    def number(c):
        return c.cast("double")

    return taken.select(
        number(F.col("o_orderkey")).alias("cicid"),
        number(F.year("o_orderdate")).alias("i94yr"),
        number(F.month("o_orderdate")).alias("i94mon"),
        number(F.col("c_nationkey")).alias("i94cit"),
        number(F.col("c_nationkey")).alias("i94res"),
        F.col("o_orderpriority").alias("i94port"),
        number(day).alias("arrdate"),
        number(F.when(priority < 4, priority).otherwise(9)).alias("i94mode"),
        F.concat(F.lit("R"), (F.col("o_custkey") % 6).cast("string")).alias("i94addr"),
        F.when(status != "O", number(day + (F.col("o_orderkey") % 90).cast("int"))).alias("depdate"),
        number(F.col("o_custkey") % 97).alias("i94bir"),
        number(F.when(status == "F", 1).when(status == "O", 2).otherwise(3)).alias("i94visa"),
        number(2000 - F.col("o_custkey") % 97).alias("biryear"),
        F.lit("D/S").alias("dtaddto"),
        status.alias("entdepa"),
        status.alias("entdepd"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("c_mktsegment").alias("airline"),
        F.concat(F.lit("B"), F.substring("o_orderpriority", 1, 1)).alias("visatype"),
    )


ARRIVALS_SQL = """fact AS (
  SELECT CAST(o_orderkey AS INTEGER) AS cicid, c_nationkey AS i94res, c_nationkey AS i94cit,
    CAST(o_orderdate AS DATE) AS arrdate, 'R' || (o_custkey % 6) AS i94addr,
    CAST(year(o_orderdate) AS INTEGER) AS i94yr, CAST(month(o_orderdate) AS INTEGER) AS i94mon,
    o_orderpriority AS i94port,
    CASE WHEN CAST(o_orderpriority[1] AS INTEGER) < 4 THEN CAST(o_orderpriority[1] AS INTEGER)
      ELSE 9 END AS i94mode,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS i94visa,
    'B' || o_orderpriority[1] AS visatype,
    CASE WHEN o_orderstatus <> 'O'
      THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) END AS depdate,
    'D/S' AS dtaddto, o_orderstatus AS entdepa, o_orderstatus AS entdepd,
    CAST(o_custkey % 97 AS INTEGER) AS i94bir, CAST(2000 - o_custkey % 97 AS INTEGER) AS biryear,
    CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS airline,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderkey % 90 AS INTEGER) END AS stay
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


# --- country code list and temperature readings -----------------------------------------------

# Two nations are delivered under another name on either side, two have no readings.
CODE_NAMES = {"INVALID: NATION_3": "NATION_3", "NATION_4 (ALL)": "NATION_4"}
READING_NAMES = {"Fourth Nation": "nation_4", "Fifth Nation": "nation_5"}


def country_codes(spark: SparkSession, sf: str) -> DataFrame:
    name = F.upper("n_name")
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("Code"),
        F.when(F.col("n_nationkey") == 3, F.concat(F.lit("INVALID: "), name))
        .when(F.col("n_nationkey") == 4, F.concat(name, F.lit(" (ALL)")))
        .otherwise(name)
        .alias("Country"),
    )


def temperature_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Customer balances in whole cents as readings, so that sums of doubles are exact."""
    key = F.col("c_nationkey")
    return table(spark, sf, "customer").select(
        F.when(key == 4, "Fourth Nation")
        .when((key == 5) & (F.col("c_custkey") % 2 == 0), "Fifth Nation")
        .otherwise(F.concat(F.lit("Nation_"), F.when(key < 23, key).otherwise(99).cast("string")))
        .alias("Country"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.round(F.col("c_acctbal") * 100)).alias(
            "AverageTemperature"
        ),
    )


COUNTRY_SQL = """country AS (
  SELECT n_nationkey AS Code, upper(n_name[1]) || lower(n_name[2:]) AS CountryName,
    avg(CASE WHEN c_mktsegment <> 'MACHINERY' THEN round(c_acctbal * 100) END) AS Temperature
  FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey AND n_nationkey < 23
  GROUP BY n_nationkey, n_name)"""


# --- city demographics: one row per order, city = customer, state = nation, group = priority --

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
GROUPS = dict(zip(PRIORITIES, RACES.values(), strict=True))


def demographics(spark: SparkSession, sf: str) -> DataFrame:
    taken = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    cents = F.round(F.col("o_totalprice") * 100)
    people = (F.col("c_custkey") % 1000).cast("int")
    return taken.select(
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_name")).alias("City"),
        F.concat(F.lit("State "), F.col("c_nationkey").cast("string")).alias("State"),
        F.col("c_nationkey").cast("string").alias("State Code"),
        F.col("o_orderpriority").alias("Race"),
        F.when(F.col("c_custkey") % 7 != 0, F.floor(cents / 1000000).cast("double")).alias(
            "Median Age"
        ),
        (people + 1).alias("Male Population"),
        (people + 2).alias("Female Population"),
        people.alias("Total Population"),
        F.when(F.col("c_custkey") % 3 != 0, F.lit(5)).alias("Number of Veterans"),
        F.col("c_nationkey").alias("Foreign-born"),
        (F.col("c_custkey") % 9).cast("double").alias("Average Household Size"),
        (F.col("o_orderkey") % 11).cast("int").alias("Count"),
    )


DEMOGRAPHICS_SQL = """demo AS (
  SELECT CASE WHEN c_custkey % 50 <> 0 THEN c_name END AS City, 'State ' || c_nationkey AS State,
    CAST(c_nationkey AS VARCHAR) AS StateCode, o_orderpriority AS Race,
    CASE WHEN c_custkey % 7 <> 0 THEN floor(round(o_totalprice * 100) / 1000000) END AS age,
    c_custkey % 1000 AS people, CASE WHEN c_custkey % 3 <> 0 THEN 5 END AS veterans,
    c_nationkey AS born, CAST(c_custkey % 9 AS DOUBLE) AS household, o_orderkey % 11 AS n
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

CITY_SQL = f"""WITH {DEMOGRAPHICS_SQL}, city AS (
  SELECT City, State, StateCode, min(age) AS age, min(household) AS household,
    min(people + 1) AS male, min(people + 2) AS female, min(people) AS people,
    min(veterans) AS veterans, min(born) AS born,
    sum(n) FILTER (Race = '1-URGENT') AS g1, sum(n) FILTER (Race = '2-HIGH') AS g2,
    sum(n) FILTER (Race = '3-MEDIUM') AS g3, sum(n) FILTER (Race = '4-NOT SPECIFIED') AS g4,
    sum(n) FILTER (Race = '5-LOW') AS g5
  FROM demo WHERE City IS NOT NULL GROUP BY City, State, StateCode)"""
