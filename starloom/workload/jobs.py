"""The end-to-end jobs run on files that Spark writes from the sample tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.values import recode
from starloom.lookups import RACES
from starloom.plans.deliveries import load_delivery
from starloom.plans.etl import etl_countries, etl_immigration, etl_states
from starloom.plans.immigration import SOURCE_COLUMNS
from starloom.plans.jobs import JobResult, arrivals_job, music_job
from starloom.schemas import TEMPERATURE
from starloom.session import scratch_path
from starloom.sinks.manifest import append_batch, read_batches
from starloom.workload import facts_dims, frames  # noqa: F401  (registers the SQL used again below)
from starloom.workload.registry import ORACLE_SQL, query, table
from starloom.workload.storage import json_log, write_log


def _database(spark, root: str) -> str:
    name = f"starloom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/database'")
    return name


def _report(result: JobResult):
    """Rows written per step, and what every check found."""
    steps = result.load_report.select(
        F.concat(F.lit("load "), "step").alias("item"), F.col("n_rows").alias("value")
    )
    checks = result.quality_report.select(
        F.concat("table_name", F.lit(" "), "check_name").alias("item"), "value"
    )
    return steps.unionByName(checks)


def _items(*pairs: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{item}' AS item, CAST(({value}) AS BIGINT) AS value" for item, value in pairs
    )


def _table_items(name: str, relation: str, key: str, *not_null: str) -> list[tuple[str, str]]:
    nulls = [
        (f"{name} not_null({c})", f"SELECT count(*) - count({c}) FROM {relation}")
        for c in dict.fromkeys((key, *not_null))
    ]
    return [
        (f"{name} row_count", f"SELECT count(*) FROM {relation}"),
        (
            f"{name} unique({key})",
            f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {relation})) "
            f"FROM {relation}",
        ),
        *nulls,
    ]


@query(
    "arrivals_job",
    f"""WITH {frames.ARRIVALS_SQL}, {frames.DEMOGRAPHICS_SQL},
    day AS (SELECT arrdate AS "date" FROM fact UNION SELECT depdate FROM fact WHERE depdate IS NOT NULL),
    state AS (SELECT DISTINCT State, StateCode FROM demo WHERE City IS NOT NULL)
    """
    + _items(
        ("load immigration", "SELECT count(*) FROM fact"),
        ("load date", "SELECT count(*) FROM day"),
        ("load country", "SELECT count(*) FROM nation"),
        ("load state", "SELECT count(*) FROM state"),
        *_table_items("immigration", "fact", "cicid"),
        *_table_items("date", "day", "date"),
        *_table_items("country", "(SELECT n_nationkey AS Code FROM nation)", "Code"),
        *_table_items("state", "state", "StateCode"),
        *[(f"{t} completeness", "SELECT 0") for t in ("immigration", "date", "country", "state")],
        ("immigration rejected", "SELECT count(*) FROM nation"),
        ("immigration reconciled", "SELECT 0"),
        *[
            (f"immigration referential({c})", f"SELECT count(*) FROM fact WHERE {c} NOT IN (FROM day)")
            for c in ("arrdate", "depdate")
        ],
        *[
            (
                f"immigration referential({c})",
                f"SELECT count(*) FROM fact WHERE {c} NOT IN (SELECT {key} FROM {dimension})",
            )
            for c, key, dimension in (
                ("i94res", "n_nationkey", "nation"),
                ("i94cit", "n_nationkey", "nation"),
                ("i94addr", "StateCode", "state"),
            )
        ],
        (
            "immigration listed(i94addr)",
            "SELECT count(*) FROM fact WHERE i94addr NOT IN (SELECT 'R' || r_regionkey FROM region)",
        ),
    ),
)
def arrivals_job_query(spark, sf):
    """The state code list holds the codes R0 to R4 of the six that the arrivals name. For each nation one
    record has a text as its number."""
    root = scratch_path(spark, "arrivals-job")
    records = frames.arrivals_raw(spark, sf).select(*SOURCE_COLUMNS)
    records.write.csv(f"{root}/arrivals", header=True)
    bad = table(spark, sf, "nation").select(F.concat(F.lit("no "), "n_name").alias("cicid"), F.col("n_nationkey").alias("i94res"))
    bad.select(*[F.col(c) if c in bad.columns else F.lit(None).cast("string").alias(c) for c in SOURCE_COLUMNS]).write.mode("append").csv(
        f"{root}/arrivals", header=True
    )
    _write_readings(frames.temperature_readings(spark, sf), f"{root}/temperature")
    frames.country_codes(spark, sf).write.csv(f"{root}/codes", header=True, sep=";")
    frames.demographics(spark, sf).write.csv(f"{root}/demographics", header=True, sep=";")
    region = table(spark, sf, "region")
    region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("Code"), F.col("r_name").alias("State")).write.csv(
        f"{root}/states", header=True, sep=";"
    )
    return _report(
        arrivals_job(
            spark,
            arrivals=f"{root}/arrivals",
            temperature=f"{root}/temperature",
            country_codes=f"{root}/codes",
            demographics=f"{root}/demographics",
            output=f"{root}/out",
            database=_database(spark, root),
            state_codes=f"{root}/states",
            allowed_rejects=1000,
        )
    )


def _write_readings(readings, path: str) -> None:
    """Readings as a temperature file with all its columns."""
    readings.select(
        *[
            F.col(f.name) if f.name in readings.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in TEMPERATURE
        ]
    ).write.csv(path, header=True)


# --- one call per source, on files -------------------------------------------------------------


def _etl_immigration(spark, sf):
    root = scratch_path(spark, "etl-immigration")
    frames.arrivals_raw(spark, sf).select(*SOURCE_COLUMNS).write.csv(f"{root}/arrivals", header=True)
    return etl_immigration(spark, f"{root}/arrivals", f"{root}/fact", f"{root}/date"), root


@query("etl_immigration", ORACLE_SQL["immigration_fact"])
def etl_immigration_query(spark, sf):
    """The fact as it was written, from records as text."""
    fact, root = _etl_immigration(spark, sf)
    return spark.read.schema(fact.schema).parquet(f"{root}/fact")


@query("etl_immigration_dates", ORACLE_SQL["date_dim_from_fact"])
def etl_immigration_dates(spark, sf):
    _, root = _etl_immigration(spark, sf)
    return spark.read.parquet(f"{root}/date")


@query("etl_states", ORACLE_SQL["city_state_rollup"])
def etl_states_query(spark, sf):
    """Demographics under the group names of the census; nothing is written without a path."""
    root = scratch_path(spark, "etl-states")
    groups = dict(zip(frames.PRIORITIES, RACES, strict=True))
    cities = frames.demographics(spark, sf).withColumn("Race", recode("Race", groups))
    cities.write.csv(f"{root}/demographics", header=True, sep=";")
    return etl_states(spark, f"{root}/demographics")


@query("etl_countries", ORACLE_SQL["country_dim"])
def etl_countries_query(spark, sf):
    """Names as both lists have them after their corrections."""
    root = scratch_path(spark, "etl-countries")
    readings = frames.temperature_readings(spark, sf)
    _write_readings(readings.withColumn("Country", recode("Country", frames.READING_NAMES)), f"{root}/temperature")
    codes = frames.country_codes(spark, sf).withColumn("Country", recode("Country", frames.CODE_NAMES))
    codes.write.csv(f"{root}/codes", header=True, sep=";")
    etl_countries(spark, f"{root}/temperature", f"{root}/codes", f"{root}/country")
    return spark.read.parquet(f"{root}/country")


_STAGED_SQL = """, staged AS (SELECT * REPLACE (nullif(user_id, 0) AS user_id) FROM play),
    seen AS (SELECT DISTINCT user_id FROM staged WHERE user_id IS NOT NULL),
    artist AS (SELECT DISTINCT artist_id FROM song),
    moment AS (SELECT DISTINCT ts AS start_time FROM staged),
    keyed AS (SELECT DISTINCT l.session_id, l.item_in_session, l.ts, s.song_id FROM log l LEFT JOIN song s
      ON l.song = s.title AND l.length = s.duration AND l.artist = s.artist_name WHERE l.page = 'NextSong')
    """


@query(
    "music_job",
    frames.PLAYS_SQL
    + _STAGED_SQL
    + _items(
        ("load staging_events", "SELECT count(*) FROM log"),
        ("load staging_songs", "SELECT count(*) FROM song"),
        ("load songplays", "SELECT count(*) FROM staged"),
        ("load users", "SELECT count(*) FROM seen"),
        ("load songs", "SELECT count(*) FROM song"),
        ("load artists", "SELECT count(*) FROM artist"),
        ("load time", "SELECT count(*) FROM moment"),
        ("songplays row_count", "SELECT count(*) FROM staged"),
        ("songplays unique(songplay_id)", "SELECT (SELECT count(*) FROM staged) - (SELECT count(*) FROM keyed)"),
        ("songplays not_null(songplay_id)", "SELECT 0"),
        ("songplays not_null(start_time)", "SELECT count(*) - count(ts) FROM staged"),
        ("songplays not_null(user_id)", "SELECT count(*) - count(user_id) FROM staged"),
        ("songplays not_null(session_id)", "SELECT count(*) - count(session_id) FROM staged"),
        *_table_items("users", "seen", "user_id"),
        *_table_items("songs", "song", "song_id"),
        *_table_items("artists", "artist", "artist_id"),
        *_table_items("time", "moment", "start_time"),
        *[
            (f"songplays referential({c})", f"SELECT count(*) FROM staged WHERE {fk} NOT IN (SELECT {key} FROM {dimension})")
            for c, fk, dimension, key in (
                ("user_id", "user_id", "seen", "user_id"), ("song_id", "song_id", "song", "song_id"),
                ("artist_id", "artist_id", "artist", "artist_id"), ("start_time", "ts", "moment", "start_time"),
            )
        ],
        ("staging_events rejected", "SELECT (SELECT count(*) FROM nation) + (SELECT count(*) FROM region)"),
        ("staging_events reconciled", "SELECT 0"),
        ("staging_songs rejected", "SELECT 0"),
        ("staging_songs reconciled", "SELECT 0"),
    ),
)
def music_job_query(spark, sf):
    """Some plays have a blank user, which the check reports; hence the job is told not to raise."""
    root = scratch_path(spark, "music-job")
    return _report(_music_job(spark, sf, root))


def _music_job(spark, sf, root) -> JobResult:
    """The job over a log in which a line for each nation is cut off and one for each region has no number as user."""
    write_log(spark, sf, f"{root}/logs")
    frames.song_metadata(spark, sf).write.json(f"{root}/songs")
    cut = table(spark, sf, "nation").select(F.concat(F.lit('{"page": "NextSong", "song": "'), "n_name").alias("value"))
    odd = table(spark, sf, "region").select(F.to_json(F.struct(F.lit("NextSong").alias("page"), F.col("r_name").alias("userId"))).alias("value"))
    cut.union(odd).write.mode("append").text(f"{root}/logs/bad")
    return music_job(
        spark,
        logs=f"{root}/logs",
        songs=f"{root}/songs",
        output=f"{root}/out",
        database=_database(spark, root),
        enforce=False,
        allowed_rejects=1000,
    )


@query(
    "rejected_lines",
    """SELECT 'unreadable' AS reason, '{"page": "NextSong", "song": "' || n_name AS line FROM nation
    UNION ALL SELECT 'userId', '{"page":"NextSong","userId":"' || r_name || '"}' FROM region""",
)
def rejected_lines(spark, sf):
    """What the music job has set aside: the text of every bad line, and why."""
    result = _music_job(spark, sf, scratch_path(spark, "rejected-lines"))
    return result.rejected["staging_events"].select("reason", "line")


# --- delivery by delivery ------------------------------------------------------------------------

_DELIVERED = (
    f"""WITH {frames.LOG_SQL}, {frames.SONG_SQL}, played AS (SELECT DISTINCT * FROM log WHERE page = 'NextSong'),
    known AS (SELECT DISTINCT * FROM song)"""
)


def _delivered(spark, sf, label: str) -> str:
    """The log in three deliveries by place in the session, of which the second one comes twice; songs of odd size come
    with the last one only. Returns the database."""
    root = scratch_path(spark, label)
    database = _database(spark, root)
    item = F.col("itemInSession")
    place = F.when(item <= 2, 0).when(item.isin(3, 4), 1).when(item > 4, 2)
    log = json_log(spark, sf).withColumn("delivery", place).where("delivery is not null")
    log.write.partitionBy("delivery").json(f"{root}/logs", compression="gzip")
    songs = frames.song_metadata(spark, sf)
    for i in (0, 2):
        songs.where(F.col("year") % 2 == (1 if i else 0)).write.json(f"{root}/songs/{i}")
    for i in (0, 1, 1, 2):
        given = {"logs": f"{root}/logs/delivery={i}"} | ({"songs": f"{root}/songs/{i}"} if i != 1 else {})
        load_delivery(spark, batch=f"delivery {i}", output=f"{root}/out", database=database, **given)
    return database


@query(
    "star_by_deliveries",
    _DELIVERED
    + """ SELECT md5(concat_ws(chr(31), '=' || l.session_id, '=' || l.item_in_session, '=' || l.ts, coalesce('=' || s.song_id, ''))) AS songplay_id,
      l.ts AS start_time, CAST(nullif(l.user_id, 0) AS BIGINT) AS user_id, l.level, s.song_id, s.artist_id,
      CAST(l.session_id AS BIGINT) AS session_id, l.location, l.user_agent, CAST(year(l.ts) AS INTEGER) AS "year", CAST(month(l.ts) AS INTEGER) AS "month"
    FROM played l LEFT JOIN known s ON l.song = s.title AND l.length = s.duration AND l.artist = s.artist_name""",
)
def star_by_deliveries(spark, sf):
    """The fact after four deliveries, one of them repeated: that of one load, ids included."""
    return spark.table(f"{_delivered(spark, sf, 'deliveries')}.songplays")


@query(
    "dimensions_by_deliveries",
    _DELIVERED
    + """ SELECT 'users' AS dimension, count(DISTINCT nullif(user_id, 0)) AS n_rows, CAST(sum(DISTINCT nullif(user_id, 0)) AS BIGINT) AS checked FROM played
    UNION ALL SELECT 'songs', count(DISTINCT song_id), CAST(sum("year") AS BIGINT) FROM known
    UNION ALL SELECT 'artists', count(DISTINCT artist_id), count(DISTINCT artist_name) FROM known
    UNION ALL SELECT 'time', count(DISTINCT ts), count(DISTINCT ts) FROM played""",
)
def dimensions_by_deliveries(spark, sf):
    database = _delivered(spark, sf, "delivered-dimensions")
    checked = {"users": F.sum("user_id"), "songs": F.sum("year"), "artists": F.count_distinct("name"), "time": F.count_distinct("start_time")}
    n = F.count(F.lit(1)).alias("n_rows")
    return reduce(
        DataFrame.union,
        [spark.table(f"{database}.{d}").agg(n, c.cast("bigint").alias("checked")).select(F.lit(d).alias("dimension"), "*") for d, c in checked.items()],
    )


@query(
    "ids_across_loads",
    """SELECT l_linenumber % 3 AS batch, count(*) AS n_rows,
      CAST(coalesce(sum(count(*)) OVER (ORDER BY l_linenumber % 3 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_id,
      CAST(sum(count(*)) OVER (ORDER BY l_linenumber % 3) - 1 AS BIGINT) AS last_id, count(*) AS n_ids
    FROM lineitem GROUP BY l_linenumber % 3""",
)
def ids_across_loads(spark, sf):
    """Three appends, the second and the first one repeated: ids go on without gap, and repeated batches keep theirs."""
    folder = scratch_path(spark, "numbered-batches")
    lines = table(spark, sf, "lineitem").select((F.col("l_linenumber") % 3).cast("int").alias("batch"), "l_orderkey")
    for i in (0, 1, 1, 2, 0):
        append_batch(lines.where(F.col("batch") == i), folder, f"batch {i}", id_column="line_id")
    stored = read_batches(spark, folder, "line_id bigint, batch int, l_orderkey bigint")
    return stored.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("line_id").alias("first_id"), F.max("line_id").alias("last_id"),
        F.count_distinct("line_id").alias("n_ids"),
    )
