"""Queries over the fact and dimension builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.clean import latest_per_key
from starloom.operators.history import validity_intervals, value_then
from starloom.operators.identity import with_dense_id
from starloom.plans import songplays as music
from starloom.plans.country import build_country
from starloom.plans.immigration import build_dates, build_immigration, date_union_all
from starloom.plans.state import build_state, city_measures
from starloom.workload import frames
from starloom.workload.registry import query, table


@query("immigration_fact", f"WITH {frames.ARRIVALS_SQL} SELECT * FROM fact")
def immigration_fact(spark, sf):
    return build_immigration(frames.arrivals_raw(spark, sf))


_DATE_PARTS = """CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(weekofyear(d) AS INTEGER) AS weekofyear,
  CAST(dayofweek(d) + 1 AS INTEGER) AS dayofweek"""


@query(
    "date_dim",
    f"""WITH dates AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
      UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)
    SELECT d AS "date", {_DATE_PARTS} FROM dates WHERE d IS NOT NULL""",
)
def date_dim(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("arrdate"), F.lit(None).cast("date").alias("depdate")
    )
    lines = table(spark, sf, "lineitem").select(
        F.lit(None).cast("date").alias("arrdate"), F.to_date("l_shipdate").alias("depdate")
    )
    return build_dates(orders.unionAll(lines))


@query(
    "date_dim_from_fact",
    f"""WITH {frames.ARRIVALS_SQL}, dates AS (
      SELECT arrdate AS d FROM fact UNION SELECT depdate FROM fact)
    SELECT d AS "date", {_DATE_PARTS} FROM dates WHERE d IS NOT NULL""",
)
def date_dim_from_fact(spark, sf):
    return build_dates(build_immigration(frames.arrivals_raw(spark, sf)))


@query(
    "date_dim_union_all",
    f"""WITH {frames.ARRIVALS_SQL}, dates AS (
      SELECT DISTINCT arrdate AS d FROM fact UNION ALL SELECT DISTINCT depdate FROM fact)
    SELECT d AS "date", {_DATE_PARTS} FROM dates""",
)
def date_dim_union_all(spark, sf):
    return build_dates(build_immigration(frames.arrivals_raw(spark, sf)), form="union_all")


@query(
    "date_union_all",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS "date" FROM orders
    UNION ALL SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem""",
)
def date_union_all_query(spark, sf):
    shipped = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    ordered = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return ordered.union(shipped)


@query("country_dim", f"WITH {frames.COUNTRY_SQL} SELECT * FROM country")
def country_dim(spark, sf):
    return build_country(
        frames.temperature_readings(spark, sf),
        frames.country_codes(spark, sf),
        temperature_names=frames.READING_NAMES,
        code_names=frames.CODE_NAMES,
    )


@query(
    "country_dim_mean_first",
    """WITH reading AS (
      SELECT CASE WHEN c_nationkey = 5 AND c_custkey % 2 = 0 THEN -5 ELSE c_nationkey END AS k,
        avg(CASE WHEN c_mktsegment <> 'MACHINERY' THEN round(c_acctbal * 100) END) AS t
      FROM customer WHERE c_nationkey < 23 GROUP BY 1)
    SELECT n_nationkey AS Code, upper(n_name[1]) || lower(n_name[2:]) AS CountryName,
      t AS Temperature
    FROM nation LEFT JOIN reading ON n_nationkey = abs(k)""",
)
def country_dim_mean_first(spark, sf):
    return build_country(
        frames.temperature_readings(spark, sf),
        frames.country_codes(spark, sf),
        temperature_names=frames.READING_NAMES,
        code_names=frames.CODE_NAMES,
        recode_first=False,
    )


@query(
    "city_rollup",
    f"""{frames.CITY_SQL} SELECT City, State, StateCode, CAST(people AS INTEGER) AS TotalPopulation,
      CAST(male AS INTEGER) AS MalePopulation, CAST(female AS INTEGER) AS FemalePopulation,
      born AS ForeignBorn, veterans AS NumberOfVeterans, age AS MedianAge,
      household AS AverageHouseholdSize, CAST(g1 AS BIGINT) AS AmericanIndianAndAlaskaNative,
      CAST(g2 AS BIGINT) AS Asian, CAST(g3 AS BIGINT) AS BlackOrAfricanAmerican,
      CAST(g4 AS BIGINT) AS HispanicOrLatino, CAST(g5 AS BIGINT) AS White FROM city""",
)
def city_rollup(spark, sf):
    return city_measures(frames.demographics(spark, sf), frames.GROUPS)


_STATE_SQL = """SELECT State, StateCode, CAST(sum(people) AS BIGINT) AS TotalPopulation,
  CAST(sum(male) AS BIGINT) AS MalePopulation, CAST(sum(female) AS BIGINT) AS FemalePopulation,
  CAST(sum(born) AS BIGINT) AS ForeignBorn,
  CAST(sum(coalesce(veterans, 0)) AS BIGINT) AS NumberOfVeterans,
  CAST(sum(coalesce(g1, 0)) AS BIGINT) AS AmericanIndianAndAlaskaNative,
  CAST(sum(coalesce(g2, 0)) AS BIGINT) AS Asian,
  CAST(sum(coalesce(g3, 0)) AS BIGINT) AS BlackOrAfricanAmerican,
  CAST(sum(coalesce(g4, 0)) AS BIGINT) AS HispanicOrLatino,
  CAST(sum(coalesce(g5, 0)) AS BIGINT) AS White, {mean} AS MedianAge,
  sum(household * people) / nullif(CAST(sum(people) AS DOUBLE), 0) AS AverageHouseholdSize
  FROM city GROUP BY State, StateCode"""


@query(
    "city_state_rollup",
    frames.CITY_SQL
    + _STATE_SQL.format(
        mean="sum(coalesce(age, 0) * people) / nullif(CAST(sum(people) AS DOUBLE), 0)"
    ),
)
def city_state_rollup(spark, sf):
    return build_state(frames.demographics(spark, sf), frames.GROUPS)


@query(
    "city_state_rollup_skip_missing",
    frames.CITY_SQL
    + _STATE_SQL.format(
        mean="sum(age * people) / nullif(CAST(sum(people) FILTER (age IS NOT NULL) AS DOUBLE), 0)"
    ),
)
def city_state_rollup_skip_missing(spark, sf):
    return build_state(frames.demographics(spark, sf), frames.GROUPS, missing="skip")


# --- music ------------------------------------------------------------------------------------


def _log_and_songs(spark, sf):
    return frames.log_events(spark, sf), frames.song_metadata(spark, sf)


_PLAY = "user_id, level, song_id, artist_id, session_id, location, user_agent"


@query("songplays_fact", f"{frames.PLAYS_SQL} SELECT ts AS start_time, {_PLAY} FROM play")
def songplays_fact(spark, sf):
    return music.build_songplays(*_log_and_songs(spark, sf), key=None)


@query("songplays_fact_salted", f"{frames.PLAYS_SQL} SELECT ts AS start_time, {_PLAY} FROM play")
def songplays_fact_salted(spark, sf):
    return music.build_songplays(*_log_and_songs(spark, sf), key=None, salts=8)


@query(
    "songplays_fact_hot_split", f"{frames.PLAYS_SQL} SELECT ts AS start_time, {_PLAY} FROM play"
)
def songplays_fact_hot_split(spark, sf):
    """Only songs played 12 times or more are split; about a third of them here."""
    return music.build_songplays(*_log_and_songs(spark, sf), key=None, salts=8, hot_rows=12)


@query(
    "hash_fact",
    f"""{frames.PLAYS_SQL}, cut AS (SELECT *, date_trunc('second', ts) AS start_time FROM play)
    SELECT md5(session_id || CAST(start_time AS VARCHAR)) AS songplay_id,
      CAST(start_time AS TIMESTAMP) AS start_time, {_PLAY} FROM cut""",
)
def hash_fact(spark, sf):
    return music.build_songplays_hashed(*_log_and_songs(spark, sf))


@query(
    "songplays_identity",
    f"""{frames.PLAYS_SQL} SELECT count(*) AS n_rows, count(*) AS n_keys, count(*) AS n_not_null
    FROM play""",
)
def songplays_identity(spark, sf):
    keys = music.build_songplays(*_log_and_songs(spark, sf)).groupBy("songplay_id").count()
    return keys.agg(
        F.sum("count").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count("songplay_id").alias("n_not_null"),
    )


@query(
    "identity_key",
    """SELECT count(*) AS n_rows, count(*) AS n_keys, CAST(0 AS BIGINT) AS first_key,
      count(*) - 1 AS last_key, count(DISTINCT event_id) AS n_events FROM events""",
)
def identity_key(spark, sf):
    numbered = with_dense_id(table(spark, sf, "events").select("event_id"), "id")
    keys = numbered.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    events = numbered.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.min("id").alias("first_key"),
        F.max("id").alias("last_key"),
    ).select("*", events.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_events"))


_USER = "user_id, first_name, last_name, gender, level"


@query(
    "users_form_a", f"WITH {frames.LOG_SQL} SELECT {_USER} FROM log WHERE page = 'NextSong'"
)
def users_form_a(spark, sf):
    return music.build_users(frames.log_events(spark, sf), "rows")


@query(
    "users_form_b",
    f"WITH {frames.LOG_SQL} SELECT DISTINCT {_USER} FROM log WHERE page = 'NextSong'",
)
def users_form_b(spark, sf):
    return music.build_users(frames.log_events(spark, sf), "distinct")


@query(
    "users_form_c",
    f"""WITH {frames.LOG_SQL} SELECT {_USER} FROM log WHERE page = 'NextSong'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, session_id DESC,
      item_in_session DESC, first_name DESC, last_name DESC, gender DESC, level DESC) = 1""",
)
def users_form_c(spark, sf):
    return music.build_users(
        frames.log_events(spark, sf), "latest", ("ts", "session_id", "item_in_session")
    )


_HISTORY = f"""WITH {frames.LOG_SQL}, level_at AS (
      SELECT user_id, ts, max(level) AS level FROM log WHERE page = 'NextSong' GROUP BY user_id, ts
    ), change AS (
      SELECT *, lag(level) OVER (PARTITION BY user_id ORDER BY ts) AS was FROM level_at
    ), history AS (
      SELECT user_id, level, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
      FROM change WHERE was IS NULL OR was <> level
    )"""


def _history(spark, sf):
    plays = music.plays(frames.log_events(spark, sf))
    return validity_intervals(plays, ["user_id"], ["level"], "ts")


@query("users_history", f"{_HISTORY} SELECT * FROM history")
def users_history(spark, sf):
    """From when to when a user had a level, as their plays tell."""
    return _history(spark, sf)


@query(
    "events_with_level_then",
    f"""{_HISTORY}, side AS (
      SELECT user_id, ts, 1 AS kind, NULL AS level, session_id, item_in_session, page FROM log
      UNION ALL SELECT user_id, valid_from, 0, level, NULL, NULL, NULL FROM history
    ), told AS (
      SELECT *, last_value(level IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level_then FROM side
    ) SELECT user_id, ts, session_id, item_in_session, page, level_then FROM told WHERE kind = 1""",
)
def events_with_level_then(spark, sf):
    """Every event with the level that the user's plays had set by then."""
    events = frames.log_events(spark, sf).select("user_id", "ts", "session_id", "item_in_session", "page")
    return value_then(events, _history(spark, sf), ["user_id"], "level", "ts", name="level_then")


@query(
    "users_latest_event",
    """SELECT event_id, ts, user_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def users_latest_event(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"])


_SONG = "song_id, title, artist_id, year, CAST(duration AS DOUBLE) AS duration"
_ARTIST = """artist_id, artist_name AS name, artist_location AS location,
  CAST(artist_latitude AS DOUBLE) AS latitude, CAST(artist_longitude AS DOUBLE) AS longitude"""


@query("songs_rows", f"WITH {frames.SONG_SQL} SELECT {_SONG} FROM song")
def songs_rows(spark, sf):
    return music.build_songs(frames.song_metadata(spark, sf), "rows")


@query("songs_distinct", f"WITH {frames.SONG_SQL} SELECT DISTINCT {_SONG} FROM song")
def songs_distinct(spark, sf):
    return music.build_songs(frames.song_metadata(spark, sf), "distinct")


@query("songs_dim", f"WITH {frames.SONG_SQL} SELECT {_SONG} FROM song")
def songs_dim(spark, sf):
    return music.build_songs(frames.song_metadata(spark, sf))


@query("artists_rows", f"WITH {frames.SONG_SQL} SELECT {_ARTIST} FROM song")
def artists_rows(spark, sf):
    return music.build_artists(frames.song_metadata(spark, sf), "rows")


@query("artists_distinct", f"WITH {frames.SONG_SQL} SELECT DISTINCT {_ARTIST} FROM song")
def artists_distinct(spark, sf):
    return music.build_artists(frames.song_metadata(spark, sf), "distinct")


@query(
    "artists_dim",
    f"""WITH {frames.SONG_SQL}, artist AS (SELECT DISTINCT {_ARTIST} FROM song)
    SELECT * FROM artist QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY name, location,
      latitude NULLS FIRST, longitude NULLS FIRST) = 1""",
)
def artists_dim(spark, sf):
    return music.build_artists(frames.song_metadata(spark, sf))


_TIME_PARTS = """CAST(hour({0}) AS INTEGER) AS hour, CAST(day({0}) AS INTEGER) AS day,
  CAST(weekofyear({0}) AS INTEGER) AS week, CAST(month({0}) AS INTEGER) AS month,
  CAST(year({0}) AS INTEGER) AS year, CAST(dayofweek({0}) AS INTEGER) AS weekday"""


@query(
    "time_dim",
    f"SELECT DISTINCT ts AS start_time, {_TIME_PARTS.format('ts')} FROM events",
)
def time_dim(spark, sf):
    return music.build_time(table(spark, sf, "events"), "ts")


@query(
    "time_rows",
    f"""WITH {frames.LOG_SQL} SELECT ts AS start_time, {_TIME_PARTS.format('ts')} FROM log
    WHERE page = 'NextSong'""",
)
def time_rows(spark, sf):
    return music.build_time(music.plays(frames.log_events(spark, sf)), "ts", "rows")


@query(
    "time_dim_from_fact",
    f"{frames.PLAYS_SQL} SELECT DISTINCT ts AS start_time, {_TIME_PARTS.format('ts')} FROM play",
)
def time_dim_from_fact(spark, sf):
    return music.build_time(music.build_songplays(*_log_and_songs(spark, sf), key=None))
