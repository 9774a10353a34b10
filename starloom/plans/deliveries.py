"""The song play star, loaded delivery by delivery.

A delivery is a batch with a name. Its plays are added to the plays kept so far, by month; the months that it
touches are built anew from these, and no other month is read or written. The dimensions are merged. The
batch is committed last: one that broke off is loaded again, one that is delivered twice changes nothing, and after
any sequence of deliveries the star is the one that a single load of all of them gives, ids included.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.clean import distinct_rows, latest_per_key
from starloom.operators.rejects import split_rejects
from starloom.plans import songplays as music
from starloom.schemas import CONTRACTS, SONG_JSON, TableContract
from starloom.sinks.manifest import Commit, Manifest
from starloom.sinks.tables import create_table, load_table, qualified
from starloom.sources.logs import read_checked_log, read_checked_songs

MONTHS = ("year", "month")
_EVENTS = [f for f in CONTRACTS["staging_events"].schema if f.name != "staging_event_id"]
_USERS = CONTRACTS["users"].schema

# What the deliveries have brought so far; the star's tables are worked out from these.
PLAYS_SO_FAR = TableContract(
    "plays_so_far",
    T.StructType([*_EVENTS, *(T.StructField(m, T.IntegerType()) for m in MONTHS)]),
    ("session_id", "item_in_session", "ts"),
    partition_by=MONTHS,
)
SONGS_SO_FAR = TableContract("songs_so_far", SONG_JSON, ("song_id",))
USERS_SO_FAR = TableContract("users_so_far", T.StructType([*_USERS, T.StructField("ts", T.TimestampNTZType())]), ("user_id",))


def month_of(ts: str) -> dict:
    return {part: F.expr(f"cast({part}({ts}) as int)") for part in MONTHS}


def in_months(df: DataFrame, months: list[tuple]) -> DataFrame:
    """The rows of some months: a condition on partition columns, so that other months are not even listed."""
    chosen = F.lit(False)
    for month in months:
        same = F.lit(True)
        for column, value in zip(MONTHS, month, strict=True):
            same &= F.col(column).eqNullSafe(F.lit(value).cast("int"))
        chosen |= same
    return df.where(chosen)


def load_delivery(
    spark: SparkSession,
    *,
    batch: str,
    output: str,
    logs: str | None = None,
    songs: str | None = None,
    database: str | None = None,
    allowed_rejects: int = 0,
    salts: int = 1,
    hot_rows: int | None = None,
) -> Commit:
    """Add one delivery of log files, song files or both; returns its commit, an earlier one if it was there already.

    A play that is delivered again, in this batch or another one, stays one play. Songs that come after their plays
    are matched too: the months of these plays are built anew.
    """
    base = output.rstrip("/")
    manifest = Manifest(spark, f"{base}/_commits")
    commits = manifest.commits()
    done = next((c for c in commits if c.batch == batch), None)
    if done is not None:
        return done

    def name(contract: TableContract) -> str:
        return qualified(database, contract.name)

    def table(contract: TableContract) -> DataFrame:
        create_table(spark, contract, name(contract), f"{base}/{contract.name}")
        return spark.table(name(contract))

    def load(df: DataFrame, contract: TableContract, mode: str = "overwrite") -> int:
        return load_table(df, contract, name(contract), mode=mode, location=f"{base}/{contract.name}")

    facts: dict = {"read": 0, "rejected": 0}

    def records(checked: DataFrame, label: str) -> DataFrame:
        split = split_rejects(checked, f"{base}/_records/{len(commits):012d}-{label}-{uuid.uuid4().hex[:8]}")
        split.check(f"{batch}: {label}", allowed_rejects)
        facts["read"] += split.n_read
        facts["rejected"] += split.n_rejected
        opened.append(split)
        return split.loaded

    opened: list = []
    touched: set[tuple] = set()
    known = table(SONGS_SO_FAR)
    if songs is not None:
        new = records(read_checked_songs(spark, songs), "songs").subtract(known)
        late = table(PLAYS_SO_FAR).join(new.select(*[F.col(t).alias(p) for p, t in music.SONG_MATCH.items()]), list(music.SONG_MATCH), "left_semi")
        touched |= {tuple(r) for r in late.select(*MONTHS).distinct().collect()}
        load(known.union(new.select(*known.columns)), SONGS_SO_FAR)
        known = table(SONGS_SO_FAR)
    if logs is not None:
        plays = music.plays(records(read_checked_log(spark, logs), "log")).withColumns(month_of("ts"))
        touched |= {tuple(r) for r in plays.select(*MONTHS).distinct().collect()}
        kept = table(PLAYS_SO_FAR)
        merged = distinct_rows(in_months(kept, list(touched)).union(plays.select(*kept.columns)))
        load(merged, PLAYS_SO_FAR, "overwrite_partitions")
        seen = plays.where(F.col("user_id").isNotNull()).select(*_USERS.fieldNames(), "ts")
        users = table(USERS_SO_FAR)
        load(latest_per_key(users.union(seen.select(*users.columns)), ["user_id"], ["ts"]), USERS_SO_FAR)

    months = sorted(touched, key=str)
    again = in_months(table(PLAYS_SO_FAR), months).drop(*MONTHS)
    fact = music.build_songplays(again, known, key="hash", salts=salts, hot_rows=hot_rows)
    facts["songplays"] = load(fact.withColumns(month_of("start_time")), CONTRACTS["songplays"], "overwrite_partitions") if months else 0
    if logs is not None:
        load(table(USERS_SO_FAR), CONTRACTS["users"])
        # the moments alone are shuffled, once; their parts follow from them
        moments = table(CONTRACTS["time"]).select("start_time").union(in_months(table(CONTRACTS["songplays"]), months).select("start_time"))
        load(music.build_time(moments), CONTRACTS["time"])
    if songs is not None:
        load(music.build_songs(known), CONTRACTS["songs"])
        load(music.build_artists(known), CONTRACTS["artists"])
    for split in opened:
        split.drop_loaded()
    return manifest.commit(batch, len(commits), months=[list(m) for m in months], **facts)
