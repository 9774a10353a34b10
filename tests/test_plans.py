import datetime as dt
import hashlib
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.lookups import RACES
from starloom.plans import analytics
from starloom.plans import songplays as music
from starloom.plans.country import build_country
from starloom.plans.immigration import SOURCE_COLUMNS, build_dates, build_immigration
from starloom.plans.state import build_state, city_measures
from starloom.schemas import CONTRACTS, IMMIGRATION_SOURCE, TEMPERATURE

D = dt.date
TS = dt.datetime


# --- arrivals ---------------------------------------------------------------------------------


def arrival(**known):
    base = dict.fromkeys(IMMIGRATION_SOURCE.fieldNames())
    return tuple({**base, **known}.values())


@pytest.fixture
def arrivals(spark):
    return spark.createDataFrame(
        [
            arrival(cicid=1.0, arrdate=20545.0, depdate=20550.0, i94res=101.0, i94addr="CA", i94yr=2016.0,
                    i94mon=4.0, i94visa=2.0, i94mode=1.0, i94bir=30.0, gender="F"),
            arrival(cicid=2.0, arrdate=20550.0, i94res=101.0, i94addr="ZZ", i94yr=2016.0, i94mon=4.0,
                    i94visa=3.0, i94mode=9.0, i94bir=50.0, gender="M"),
            arrival(cicid=3.0, depdate=20545.0, i94res=999.0, i94yr=2017.0, i94mon=1.0, i94visa=7.0,
                    gender="F"),
            arrival(cicid=4.0, arrdate=20546.0, depdate=20545.0, i94res=209.0, i94addr="CA",
                    i94yr=2016.0, i94mon=5.0, i94visa=1.0, i94mode=2.0, i94bir=20.0),
        ],
        IMMIGRATION_SOURCE,
    )


def test_immigration(arrivals, rows):
    fact = build_immigration(arrivals)
    assert fact.columns == [*SOURCE_COLUMNS, "stay"]
    declared = {f.name: f.dataType for f in CONTRACTS["immigration"].schema}
    assert {f.name: f.dataType for f in fact.schema} == declared
    found = rows(fact.select("cicid", "arrdate", "depdate", "stay"))
    assert found == [
        (1, D(2016, 4, 1), D(2016, 4, 6), 5),
        (2, D(2016, 4, 6), None, None),
        (3, None, D(2016, 4, 1), None),
        (4, D(2016, 4, 2), D(2016, 4, 1), -1),
    ]


def test_immigration_from_text(spark):
    raw = spark.createDataFrame([("5748517.0", "abc", "20545.0")], "cicid string, i94res string, arrdate string")
    fact = build_immigration(raw, ["cicid", "i94res", "arrdate"])
    assert fact.first()[:] == (5748517, None, D(2016, 4, 1))


def test_dates(arrivals, rows):
    fact = build_immigration(arrivals)
    unique = rows(build_dates(fact))
    assert [r[0] for r in unique] == [D(2016, 4, 1), D(2016, 4, 2), D(2016, 4, 6)]
    assert unique[0] == (D(2016, 4, 1), 2016, 4, 1, 13, 6)
    repeated = [r[0] for r in rows(build_dates(fact, form="union_all"))]
    arrived, left = {D(2016, 4, 1), D(2016, 4, 6), None, D(2016, 4, 2)}, {D(2016, 4, 6), None, D(2016, 4, 1)}
    assert sorted(repeated, key=str) == sorted([*arrived, *left], key=str)
    with pytest.raises(ValueError):
        build_dates(fact, form="other")


# --- country ----------------------------------------------------------------------------------


@pytest.fixture
def readings(spark):
    data = [
        ("Congo", 20.0), ("Congo (Democratic Republic Of The", 30.0), ("Congo (Democratic Republic Of The", 40.0),
        ("Côte D'Ivoire", 26.0), ("France", 10.0), ("France", None), ("France", 14.0), ("Nowhere", None),
        ("Canada", -5.0),
    ]
    return spark.createDataFrame(
        [(None, t, None, None, c, None, None) for c, t in data], TEMPERATURE
    )


@pytest.fixture
def codes(spark):
    return spark.createDataFrame(
        [("1", "CONGO"), ("2", "IVORY COAST"), ("3", "FRANCE"), ("4", "NOWHERE"), ("5", "INVALID: CANADA"),
         ("6", "GUINEA-BISSAU"), ("x", "ATLANTIS")],
        "Code string, Country string",
    )


def test_country(readings, codes, rows):
    found = rows(build_country(readings, codes))
    assert found == sorted(
        [
            (1, "Congo", 30.0),
            (2, "Ivory Coast", 26.0),
            (3, "France", 12.0),
            (4, "Nowhere", None),
            (5, "Canada", -5.0),
            (6, "Guinea Bissau", None),
            (None, "Atlantis", None),
        ],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def test_country_in_the_original_order_repeats_merged_names(readings, codes):
    found = build_country(readings, codes, recode_first=False)
    congo = sorted(r.Temperature for r in found.where("Code = 1").collect())
    assert congo == [20.0, 35.0]
    assert found.count() == codes.count() + 1


# --- state ------------------------------------------------------------------------------------

CITY_COLUMNS = (
    "City string, State string, `Median Age` double, `Male Population` int, `Female Population` int, "
    "`Total Population` int, `Number of Veterans` int, `Foreign-born` int, "
    "`Average Household Size` double, `State Code` string, Race string, `Count` int"
)


def city(name, state, race, count, age=40.0, size=2.5, total=100, code=None, veterans=7):
    return (name, state, age, 40, 60, total, veterans, 9, size, code or (state and state[:2]), race, count)


def brute_state(data, missing="zero"):
    cities = {}
    for r in data:
        key = (r[0], r[1], r[9])
        if None in key:
            continue
        measures = cities.setdefault(key, {"m": [[] for _ in range(7)], "race": {}})
        for slot, value in zip(measures["m"], (r[5], r[3], r[4], r[7], r[6], r[2], r[8]), strict=True):
            if value is not None:
                slot.append(value)
        if r[10] in RACES and r[11] is not None:
            measures["race"][r[10]] = measures["race"].get(r[10], 0) + r[11]
    states = {}
    for (_, state, code), c in cities.items():
        least = [min(s) if s else None for s in c["m"]]
        out = states.setdefault((state, code), {"counts": [0] * 10, "means": [[0, 0], [0, 0]]})
        counts = [v or 0 for v in least[:5]] + [c["race"].get(r, 0) for r in RACES]
        out["counts"] = [a + b for a, b in zip(out["counts"], counts, strict=True)]
        for mean, value in zip(out["means"], least[5:], strict=True):
            if value is not None or missing == "zero":
                mean[0] += (value or 0) * counts[0]
                mean[1] += counts[0]
    return {
        k: (*v["counts"], *(m[0] / m[1] if m[1] else None for m in v["means"])) for k, v in states.items()
    }


def random_cities(seed, n=200):
    rng = random.Random(seed)
    races = [*RACES, "Martian", None]
    return [
        city(rng.choice(["A", "B", "C", None]), rng.choice(["Ohio", "Utah", None]), rng.choice(races),
             rng.choice([None, 1, 5]), rng.choice([None, 30.0, 44.0]), rng.choice([None, 2.0]),
             rng.choice([None, 0, 10]), rng.choice([None, "X"]), rng.choice([None, 3]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("missing", ["zero", "skip"])
@pytest.mark.parametrize("seed", [1, 2])
def test_state_against_brute_force(spark, seed, missing):
    data = random_cities(seed)
    found = build_state(spark.createDataFrame(data, CITY_COLUMNS), missing=missing).collect()
    assert {(r[0], r[1]): tuple(r[2:]) for r in found} == brute_state(data, missing)


def test_state_columns_and_totals(spark):
    data = [city("A", "Ohio", "Asian", 5), city("A", "Ohio", "White", 50), city("B", "Ohio", "Asian", 1, total=300, age=20.0)]
    df = spark.createDataFrame(data, CITY_COLUMNS)
    out = build_state(df)
    assert out.columns == CONTRACTS["state"].columns
    row = out.first()
    assert (row.TotalPopulation, row.Asian, row.White, row.HispanicOrLatino) == (400, 6, 50, 0)
    assert row.MedianAge == (40.0 * 100 + 20.0 * 300) / 400
    assert city_measures(df).count() == 2


def test_one_grouping_equals_the_join_of_two(spark, rows):
    df = spark.createDataFrame(random_cities(5), CITY_COLUMNS)
    key = ["City", "State", "State Code"]
    least = df.groupBy(*key).agg(F.min("Total Population").alias("TotalPopulation"))
    pivoted = df.groupBy(*key).pivot("Race", list(RACES)).sum("Count").withColumnsRenamed(RACES)
    joined = least.join(pivoted, key, "inner").withColumnRenamed("State Code", "StateCode")
    columns = ["City", "State", "StateCode", "TotalPopulation", *RACES.values()]
    assert rows(city_measures(df).select(*columns)) == rows(joined.select(*columns))


# --- music ------------------------------------------------------------------------------------

EVENT_COLUMNS = (
    "artist string, song string, length decimal(18,5), page string, ts timestamp_ntz, user_id int, "
    "first_name string, last_name string, gender string, level string, session_id int, "
    "location string, user_agent string"
)
SONG_COLUMNS = (
    "song_id string, title string, artist_id string, artist_name string, duration decimal(18,5), year int, "
    "artist_location string, artist_latitude decimal(18,5), artist_longitude decimal(18,5)"
)


def event(song, artist, length, ts, user=1, level="free", page="NextSong", session=9):
    length = None if length is None else Decimal(length)
    return (artist, song, length, page, ts, user, "Ann", "Lee", "F", level, session, "NY", "UA")


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [
            event("T", "A", "100.12345", TS(2018, 11, 1, 0, 0, 0, 100000)),
            event("T", "A", "100.12345", TS(2018, 11, 1, 0, 0, 0, 900000), level="paid"),
            event("T", "A", "100.12346", TS(2018, 11, 2), user=2),
            event(None, None, None, TS(2018, 11, 3), user=2),
            event("T", "A", "100.12345", TS(2018, 11, 4), user=3, page="Home"),
            event("U", "B", "50", TS(2018, 11, 5), user=None),
        ],
        EVENT_COLUMNS,
    )


@pytest.fixture
def songs(spark):
    def song(song_id, title, artist_id, name, duration, place="X"):
        return (song_id, title, artist_id, name, Decimal(duration), 2000, place, None, Decimal("1.5"))

    return spark.createDataFrame(
        [song("S1", "T", "A1", "A", "100.12345"), song("S2", "T", "A2", "A", "100.12345"),
         song("S3", "T", "A1", "A", "200", "Y"), song("S3", "T", "A1", "A", "200", "Y")],
        SONG_COLUMNS,
    )


@pytest.mark.parametrize("salts", [1, 3])
def test_songplays(events, songs, rows, salts):
    fact = music.build_songplays(events, songs, key=None, salts=salts)
    found = rows(fact.select("start_time", "song_id", "artist_id"))
    first, second = TS(2018, 11, 1, 0, 0, 0, 100000), TS(2018, 11, 1, 0, 0, 0, 900000)
    assert found == [
        (first, "S1", "A1"), (first, "S2", "A2"), (second, "S1", "A1"), (second, "S2", "A2"),
        (TS(2018, 11, 2), None, None), (TS(2018, 11, 3), None, None), (TS(2018, 11, 5), None, None),
    ]


@pytest.mark.parametrize("key, expected", [("dense", list(range(7))), ("identity", None)])
def test_songplay_keys(events, songs, key, expected):
    ids = sorted(r[0] for r in music.build_songplays(events, songs, key=key).collect())
    assert ids == expected if expected else len(set(ids)) == 7


def test_hashed_songplays_share_a_key_within_a_second(events, songs):
    fact = music.build_songplays_hashed(events, songs)
    keys = {r.songplay_id for r in fact.where("song_id IS NOT NULL").collect()}
    assert keys == {hashlib.md5(b"92018-11-01 00:00:00").hexdigest()}
    contract = CONTRACTS["songplays"]  # the table's partitions, year and month, come from start_time
    assert fact.columns == [c for c in contract.columns if c not in contract.partition_by]


def test_hashed_songplays_accept_raw_milliseconds(spark, events, songs, rows):
    raw = events.withColumn("ts", F.unix_millis(F.col("ts").cast("timestamp")))
    assert rows(music.build_songplays_hashed(raw, songs)) == rows(music.build_songplays_hashed(events, songs))


def test_users(events, rows):
    assert music.build_users(events, "rows").count() == 5
    assert rows(music.build_users(events, "distinct").select("user_id", "level")) == [
        (1, "free"), (1, "paid"), (2, "free"), (None, "free")
    ]
    assert rows(music.build_users(events).select("user_id", "level")) == [(1, "paid"), (2, "free")]


def test_songs_and_artists(songs, rows):
    assert music.build_songs(songs, "rows").count() == 4
    assert music.build_songs(songs, "distinct").count() == 3
    assert [r[0] for r in rows(music.build_songs(songs))] == ["S1", "S2", "S3"]
    assert music.build_artists(songs, "distinct").count() == 3
    assert rows(music.build_artists(songs).select("artist_id", "location", "latitude", "longitude")) == [
        ("A1", "X", None, 1.5), ("A2", "X", None, 1.5)
    ]


def test_time(events, songs, rows):
    times = music.build_time(music.build_songplays(events, songs, key=None))
    assert times.columns == CONTRACTS["time"].columns
    assert times.count() == 5
    assert rows(times)[0][1:] == (0, 1, 44, 11, 2018, 4)
    assert music.build_time(music.plays(events), "ts", "rows").count() == 5


# --- analytics --------------------------------------------------------------------------------


@pytest.fixture
def star(spark, arrivals):
    country = spark.createDataFrame(
        [(101, "Albania", 12.5), (209, "Japan", None)], "Code int, CountryName string, Temperature double"
    )
    state = spark.createDataFrame(
        [("CA", 36.0, 1000, 200)], "StateCode string, MedianAge double, TotalPopulation int, ForeignBorn int"
    )
    return build_immigration(arrivals), country, state


def test_arrivals_by_country(star, rows):
    fact, country, _ = star
    assert rows(analytics.arrivals_by_country(fact, country)) == [
        ("Albania", 2016, 4, 2), ("Japan", 2016, 5, 1), (None, 2017, 1, 1)
    ]
    assert analytics.arrivals_by_country(fact, country, (2017, 2018)).count() == 1


def test_arrivals_by_code(star, rows):
    fact = star[0]
    assert rows(analytics.arrivals_by_visa(fact)) == [
        (1, "business", 1), (2, "pleasure", 1), (3, "student", 1), (7, "unknown", 1)
    ]
    assert rows(analytics.arrivals_by_mode(fact)) == [
        (1, "air", 1), (2, "sea", 1), (9, "not reported", 1), (None, "unknown", 1)
    ]


def test_arrivals_by_climate(star, rows):
    fact, country, _ = star
    assert rows(analytics.arrivals_by_climate(fact, country)) == [("mild", 2), ("unknown", 2)]


def test_climate_bounds(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (9.9,), (10.0,), (20.0,), (None,)], "t double")
    found = [r[0] for r in df.select(analytics.climate(F.col("t"))).collect()]
    assert found == ["cold", "cool", "cool", "mild", "warm", "unknown"]


def test_visitor_stats(star, rows):
    assert rows(analytics.visitor_stats(star[0])) == [
        ("F", 2, 30.0, 30, 30), ("M", 1, 50.0, 50, 50), (None, 1, 20.0, 20, 20)
    ]


def test_origin_by_state(star, rows):
    assert rows(analytics.origin_by_state(*star)) == [
        ("Albania", 2, 1, 36.0, 200.0, 1000.0),
        ("Japan", 1, 1, 36.0, 200.0, 1000.0),
        (None, 1, 0, None, None, None),
    ]


def test_song_plays(events, songs, rows):
    found = analytics.song_plays(
        music.build_songplays(events, songs, key=None), music.build_songs(songs), music.build_artists(songs)
    )
    assert rows(found) == [("S1", "T", "A", 2), ("S2", "T", "A", 2), (None, None, None, 3)]
