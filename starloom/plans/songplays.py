"""Song play fact and the user, song, artist and time dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.calendar import epoch_seconds_ts, time_parts, truncate_to_second
from starloom.functions.keys import identity_key, md5_key, separated_md5_key
from starloom.operators.clean import latest_per_key, one_per_key
from starloom.operators.identity import with_dense_id
from starloom.operators.joins import find_hot_keys, left_join

PLAY_PAGE = "NextSong"
SONG_MATCH = {"song": "title", "length": "duration", "artist": "artist_name"}

_PLAY_COLUMNS = (
    "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location",
    "user_agent",
)
_NATURAL_KEY = ("session_id", "item_in_session", "start_time", "song_id")


def plays(events: DataFrame) -> DataFrame:
    return events.where(F.col("page") == PLAY_PAGE)


def _match_songs(
    events: DataFrame, songs: DataFrame, salts: int, hot_rows: int | None
) -> DataFrame:
    wanted = songs.select(*SONG_MATCH.values(), "song_id", "artist_id")
    hot = find_hot_keys(events, list(SONG_MATCH), hot_rows) if salts > 1 and hot_rows else None
    return left_join(
        events,
        wanted,
        SONG_MATCH,
        spread_by=("session_id", "user_id", "start_time"),
        salts=salts,
        hot=hot,
    )


def build_songplays(
    events: DataFrame,
    songs: DataFrame,
    *,
    key: str | None = "identity",
    salts: int = 1,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per play and matching song, exact event time; plays without a match are kept.

    ``key`` is ``"identity"`` (unique, with gaps), ``"dense"`` (0, 1, 2, ...; writes the rows once),
    ``"hash"`` (the same in every run: session, item in session, time and song) or None. ``salts``
    splits the plays of a song over several tasks; with ``hot_rows`` only of the songs played at
    least that often, which are counted first.
    """
    timed = plays(events).withColumn("start_time", F.col("ts"))
    matched = _match_songs(timed, songs, salts, hot_rows)
    if key == "hash":
        return matched.select(separated_md5_key(*_NATURAL_KEY).alias("songplay_id"), *_PLAY_COLUMNS)
    fact = matched.select(*_PLAY_COLUMNS)
    if key is None:
        return fact
    if key == "identity":
        return fact.select(identity_key().alias("songplay_id"), "*")
    if key == "dense":
        return with_dense_id(fact, "songplay_id")
    raise ValueError(f"unknown key {key!r}")


def _seconds(events: DataFrame, ts: str) -> Column:
    millis = isinstance(events.schema[ts].dataType, T.LongType)
    return epoch_seconds_ts(ts) if millis else truncate_to_second(ts)


def build_songplays_hashed(
    events: DataFrame, songs: DataFrame, *, salts: int = 1, hot_rows: int | None = None
) -> DataFrame:
    """As :func:`build_songplays`, with whole-second times and a repeatable key: the MD5 of session
    and time. Two plays of one session within a second share it. ``ts`` may be epoch milliseconds.
    """
    timed = plays(events).withColumn("start_time", _seconds(events, "ts"))
    return _match_songs(timed, songs, salts, hot_rows).select(
        md5_key("session_id", "start_time").alias("songplay_id"), *_PLAY_COLUMNS
    )


_USER_COLUMNS = ("user_id", "first_name", "last_name", "gender", "level")


def build_users(events: DataFrame, form: str = "latest", order_by: tuple[str, ...] = ("ts",)):
    """Users seen playing. ``form="rows"`` gives one row per play, ``"distinct"`` one per distinct
    row (a changed level gives two), ``"latest"`` one per user with the newest values.
    """
    seen = plays(events)
    if form == "rows":
        return seen.select(*_USER_COLUMNS)
    if form == "distinct":
        return seen.select(*_USER_COLUMNS).distinct()
    if form == "latest":
        known = seen.where(F.col("user_id").isNotNull())
        return latest_per_key(
            known.select(*_USER_COLUMNS, *order_by), ["user_id"], list(order_by)
        ).select(*_USER_COLUMNS)
    raise ValueError(f"unknown form {form!r}")


def _dimension(rows: DataFrame, key: str, form: str) -> DataFrame:
    if form == "rows":
        return rows
    if form == "distinct":
        return rows.distinct()
    if form == "unique":
        return one_per_key(rows, [key])
    raise ValueError(f"unknown form {form!r}")


def build_songs(songs: DataFrame, form: str = "unique") -> DataFrame:
    rows = songs.select(
        "song_id", "title", "artist_id", "year", F.col("duration").cast("double").alias("duration")
    )
    return _dimension(rows, "song_id", form)


def build_artists(songs: DataFrame, form: str = "unique") -> DataFrame:
    rows = songs.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").cast("double").alias("latitude"),
        F.col("artist_longitude").cast("double").alias("longitude"),
    )
    return _dimension(rows, "artist_id", form)


def build_time(times: DataFrame, column: str = "start_time", form: str = "unique") -> DataFrame:
    """Time dimension of a timestamp column. From raw events, pass ``plays(events)`` and ``"ts"``."""
    rows = times.select(F.col(column).alias("start_time"))
    if form == "unique":
        rows = rows.where(F.col("start_time").isNotNull()).distinct()
    elif form != "rows":
        raise ValueError(f"unknown form {form!r}")
    return rows.select("start_time", *[e.alias(n) for n, e in time_parts("start_time").items()])
