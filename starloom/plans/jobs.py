"""End-to-end load jobs: stage, build, load, check."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.keys import identity_key
from starloom.operators import quality
from starloom.operators.rejects import Split, reject_checks, split_rejects
from starloom.plans import songplays as music
from starloom.plans.country import build_country
from starloom.plans.cube import load_cube
from starloom.plans.immigration import SOURCE_COLUMNS, checked_immigration, dates_of
from starloom.plans.state import build_state
from starloom.schemas import CONTRACTS, TEMPERATURE
from starloom.sinks.load import run_load
from starloom.sinks.tables import drop_table, load_table, qualified
from starloom.sources.files import (
    read_checked,
    read_delimited,
    read_demographics,
    read_lookup,
    read_state_lookup,
)
from starloom.sources.filesets import read_checked_set, set_report
from starloom.sources.logs import read_checked_log, read_checked_songs
from starloom.streaming.incremental import stage_new_logs, staged_log


@dataclass(frozen=True)
class JobResult:
    load_report: DataFrame
    quality_report: DataFrame
    rejected: Mapping[str, DataFrame] = field(default_factory=dict)  # file, reason and line, by source
    source_schemas: DataFrame | None = None  # the columns of a set of files, compared


# Columns of the arrivals fact whose values are counted once: its foreign keys.
FACT_CODES = ("i94res", "i94cit", "i94addr", "arrdate", "depdate")


def _aside(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/_records/{name}-{uuid.uuid4().hex[:12]}"


def _check_all(tables: Mapping[str, DataFrame], references: list[DataFrame]) -> DataFrame:
    reports = [quality.contract_checks(df, CONTRACTS[name]) for name, df in tables.items()]
    return quality.union_reports(*reports, *references)


def arrivals_job(
    spark: SparkSession,
    *,
    arrivals: str,
    temperature: str,
    country_codes: str,
    demographics: str,
    output: str,
    arrivals_format: str = "csv",
    database: str | None = None,
    load_size: int | None = None,
    reload: str = "all",
    enforce: bool = True,
    strict_codes: bool = False,
    state_codes: str | None = None,
    allowed_rejects: int = 0,
    cube: bool = False,
    monthly: bool = False,
    **options,
) -> JobResult:
    """Build the arrivals star as Parquet tables below ``output`` and check them.

    Records that cannot be read, or lose a number or a date in its cast, are set aside with their file
    and text; the job fails, before any table changes, if there are more than ``allowed_rejects``.

    The fact comes first. Its codes and dates are counted once, by month, into ``immigration_counts``; the date
    dimension and all checks but that of the key come from these counts. ``reload="partitions"`` replaces only the
    months that occur in the input, and counts these months only. ``cube`` also loads ``arrivals_cube``, from
    which the questions about arrivals are answered without the fact.

    With ``monthly`` the arrivals are a set of files or folders named like ``..._apr16...``. Their columns may differ:
    types are widened, and a column that some months lack is null there (``source_schemas`` of the result tells).
    A record of another month than its file's is rejected.

    Arrival records name countries and states that no list knows. The report counts them, but only
    with ``strict_codes`` does that fail the job. ``state_codes`` names a state code list, which may
    hold states without demographics; the arrivals' states are then checked against it as well.
    """
    if reload not in ("all", "partitions"):
        raise ValueError(f"reload must be all or partitions, not {reload!r}")

    def load(name: str, df: DataFrame, mode: str = "overwrite") -> int:
        location = f"{output.rstrip('/')}/{name}.parquet"
        return load_table(
            df, CONTRACTS[name], qualified(database, name), mode=mode, location=location
        )

    replace = "overwrite" if reload == "all" else "overwrite_partitions"
    splits: dict[str, Split] = {}
    months: list[tuple] = []
    schemas: list[DataFrame] = []

    def table(name: str) -> DataFrame:
        return spark.table(qualified(database, name))

    def loaded_months(df: DataFrame) -> DataFrame:
        """The rows of the months that this job has loaded; other months are not read."""
        chosen = F.lit(False)
        for year, month in months:
            chosen |= F.col("i94yr").eqNullSafe(F.lit(year)) & F.col("i94mon").eqNullSafe(F.lit(month))
        return df.where(chosen)

    def load_fact() -> int:
        how = {"columns": SOURCE_COLUMNS, "load_size": load_size, **options}
        if monthly:
            keys = {"required": ("cicid",), "year": "i94yr", "month": "i94mon"}
            records, found = read_checked_set(spark, arrivals, arrivals_format, **keys, **how)
            schemas.append(set_report(spark, found))
        else:
            records = read_checked(spark, arrivals, arrivals_format, **how)
        split = split_rejects(checked_immigration(records), _aside(output, "arrivals"))
        splits["immigration"] = split
        split.check("arrivals", allowed_rejects)
        n = load("immigration", split.loaded, replace)
        months.extend(tuple(r) for r in split.loaded.select("i94yr", "i94mon").distinct().collect())
        split.drop_loaded()
        fact = loaded_months(table("immigration")) if reload == "partitions" else table("immigration")
        load_counts(fact)
        if cube:
            load_cube(spark, fact, f"{output.rstrip('/')}/arrivals_cube", database, months_only=reload == "partitions")
        return n

    def load_counts(fact: DataFrame) -> None:
        counts = quality.value_counts(fact, FACT_CODES, ("cicid",), ("i94yr", "i94mon"))
        load("immigration_counts", counts, replace)

    def load_dates() -> int:
        return load("date", dates_of(table("immigration_counts")))

    def load_countries() -> int:
        readings = read_delimited(spark, temperature, TEMPERATURE)
        return load("country", build_country(readings, read_lookup(spark, country_codes)))

    def load_states() -> int:
        return load("state", build_state(read_demographics(spark, demographics)))

    report = run_load(
        spark,
        [
            {"immigration": load_fact},
            {"date": load_dates, "country": load_countries, "state": load_states},
        ],
    )
    names = ("immigration", "date", "country", "state")
    tables = {name: quality.readable(name, lambda n=name: table(n)) for name in names}
    written = {row["step"]: row["n_rows"] for row in report.collect()}
    fact, counts = tables.pop("immigration"), table("immigration_counts")

    def reference(column: str, dimension: DataFrame, key: str) -> DataFrame:
        return quality.counted_referential(counts, "immigration", column, dimension, key)

    codes = [
        reference(column, tables[dimension], key)
        for column, dimension, key in (
            ("i94res", "country", "Code"), ("i94cit", "country", "Code"), ("i94addr", "state", "StateCode")
        )
    ]
    if state_codes is not None:
        found = reference("i94addr", read_state_lookup(spark, state_codes), "Code")
        codes.append(found.withColumn("check_name", F.lit("listed(i94addr)")))
    in_fact = (loaded_months(counts) if reload == "partitions" else counts).where("column_name = 'cicid'")
    loaded = in_fact.agg((F.lit(written["immigration"]) - F.coalesce(F.sum("n"), F.lit(0))).alias("n"))
    checks = _check_all(
        tables,
        [
            quality.counted_rows(counts, "immigration", "cicid"),
            quality.counted_nulls(counts, "immigration", ["cicid"]),
            quality.unique(fact, "immigration", ["cicid"]),
            quality.reported(loaded, "immigration", "completeness"),
            reject_checks(spark, splits, written, allowed_rejects),
        ]
        + [quality.completeness(written[name], df, name) for name, df in tables.items()]
        + [reference(column, tables["date"], "date") for column in ("arrdate", "depdate")]
        + (codes if strict_codes else []),
    )
    if enforce:
        checks = quality.enforce(checks)
    findings = [] if strict_codes else codes
    rejected = {name: s.rejected for name, s in splits.items()}
    return JobResult(report, quality.union_reports(checks, *findings), rejected, *schemas)


def music_job(
    spark: SparkSession,
    *,
    logs: str,
    songs: str,
    output: str,
    database: str | None = None,
    rebuild: bool = False,
    enforce: bool = True,
    salts: int = 1,
    hot_rows: int | None = None,
    progress: str | None = None,
    allowed_rejects: int = 0,
) -> JobResult:
    """Stage logs and song metadata, then load the song play fact and its four dimensions.

    Every load overwrites, so running the job again does not repeat rows, and a play has the same
    id in every run. A log line that was delivered twice gives the same id twice, which the check
    of the key reports. ``rebuild`` drops the
    tables first. With ``progress``, a folder that is kept between runs, only log files that are
    new since the last run are read and added to what is staged.

    Lines that are no record, or hold a number that is none, are set aside with their file; the job fails before
    the star changes if there are more than ``allowed_rejects`` in the log or among the songs.
    """
    base = output.rstrip("/")
    splits: dict[str, Split] = {}

    def load(df: DataFrame, name: str) -> int:
        table = qualified(database, name)
        if rebuild:
            drop_table(spark, table)
        return load_table(df, CONTRACTS[name], table, location=f"{base}/{name}")

    def table(name: str) -> DataFrame:
        return spark.table(qualified(database, name))

    def stage(records: DataFrame, name: str, key: str) -> int:
        splits[name] = split_rejects(records, _aside(base, name))
        splits[name].check(name, allowed_rejects)
        n = load(splits[name].loaded.select(identity_key().alias(key), "*"), name)
        splits[name].drop_loaded()
        return n

    def stage_events() -> int:
        if progress is None:
            return stage(read_checked_log(spark, logs), "staging_events", "staging_event_id")
        n = stage_new_logs(spark, logs, f"{base}/staged_logs", progress)
        splits["staging_events"] = staged_log(spark, f"{base}/staged_logs")
        splits["staging_events"].check("staging_events", allowed_rejects)
        return n

    def events() -> DataFrame:
        return splits["staging_events"].loaded if progress is not None else table("staging_events")

    def load_songplays() -> int:
        fact = music.build_songplays(
            events(), table("staging_songs"), key="hash", salts=salts, hot_rows=hot_rows
        )
        parts = {part: F.expr(f"cast({part}(start_time) as int)") for part in ("year", "month")}
        return load(fact.withColumns(parts), "songplays")

    report = run_load(
        spark,
        [
            {
                "staging_events": stage_events,
                "staging_songs": lambda: stage(
                    read_checked_songs(spark, songs), "staging_songs", "staging_song_id"
                ),
            },
            {"songplays": load_songplays},
            {
                "users": lambda: load(music.build_users(events()), "users"),
                "songs": lambda: load(music.build_songs(table("staging_songs")), "songs"),
                "artists": lambda: load(
                    music.build_artists(table("staging_songs")), "artists"
                ),
                "time": lambda: load(music.build_time(table("songplays")), "time"),
            },
        ],
    )
    names = ("songplays", "users", "songs", "artists", "time")
    tables = {n: quality.readable(n, lambda n=n: table(n)) for n in names}
    fact = tables["songplays"]
    written = {row["step"]: row["n_rows"] for row in report.collect()}
    if progress is not None:
        written["staging_events"] = splits["staging_events"].n_loaded
    checks = _check_all(
        tables,
        [reject_checks(spark, splits, written, allowed_rejects)]
        + [
            quality.referential(fact, "songplays", fk, tables[dim], key)
            for fk, dim, key in (
                ("user_id", "users", "user_id"),
                ("song_id", "songs", "song_id"),
                ("artist_id", "artists", "artist_id"),
                ("start_time", "time", "start_time"),
            )
        ],
    )
    rejected = {name: s.rejected for name, s in splits.items()}
    return JobResult(report, quality.enforce(checks) if enforce else checks, rejected)
