"""Deliveries of the song play star: the same star whatever the order and however often a delivery comes."""

import datetime as dt
import json
from pathlib import Path

import pytest

from starloom.operators.rejects import RejectedError
from starloom.plans import deliveries
from starloom.plans.deliveries import in_months, load_delivery
from starloom.plans.jobs import arrivals_job, music_job
from starloom.sinks.manifest import Manifest

STAR = ("songplays", "users", "songs", "artists", "time")


def line(session, item, month, song=None, user="7", **more):
    ts = dt.datetime(2018, month, 3, 12, 0, item, tzinfo=dt.UTC)
    return {
        "artist": song and f"artist of {song}", "song": song, "length": song and 100.5, "page": "NextSong", "level": "free",
        "sessionId": session, "itemInSession": item, "ts": int(ts.timestamp() * 1000), "userId": user, "firstName": f"u{user}",
        "location": "here", "userAgent": "x", **more,
    }


def song(name):
    return {"num_songs": 1, "artist_id": f"A{name}", "artist_name": f"artist of {name}", "song_id": f"S{name}", "title": name,
            "duration": 100.5, "year": 2000}


def deliver(folder, name, records):
    Path(folder).mkdir(parents=True, exist_ok=True)
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records)
    Path(folder, name).write_text(text + "\n", encoding="utf-8")
    return str(Path(folder))


@pytest.fixture
def databases(spark, path):
    for name in ("one", "many"):
        spark.sql(f"CREATE DATABASE {name} LOCATION '{path}/db-{name}'")
    yield "one", "many"
    for name in ("one", "many"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


DELIVERIES = [
    ([line(1, 0, 11, "a"), line(1, 1, 11, "b"), line(2, 0, 11), line(3, 0, 11, page="Home")], ["a"]),
    ([line(1, 2, 12, "a", level="paid"), line(5, 0, 11, "b"), line(1, 1, 11, "b")], None),
    ([line(9, 0, 1, "c", user="8"), line(9, 1, 12, "b", user="3000000000")], ["b", "c", "a"]),
]


def star(spark, database, rows):
    return {t: rows(spark.table(f"{database}.{t}")) for t in STAR}


def test_three_deliveries_one_repeated_equal_one_load(spark, path, rows, databases):
    everything = {"logs": f"{path}/all/logs", "songs": f"{path}/all/songs"}
    for i, (log, songs) in enumerate(DELIVERIES):
        deliver(everything["logs"], f"{i}.json", log)
        deliver(everything["songs"], f"{i}.json", [song(s) for s in songs or []])
    load_delivery(spark, batch="all", output=f"{path}/one", database="one", **everything)

    commits = []
    for i in (0, 1, 1, 2, 0):
        log, songs = DELIVERIES[i]
        given = {"logs": deliver(f"{path}/{i}/logs", "x.json", log)}
        if songs:
            given["songs"] = deliver(f"{path}/{i}/songs", "x.json", [song(s) for s in songs])
        commits.append(load_delivery(spark, batch=f"d{i}", output=f"{path}/many", database="many", **given))
    assert star(spark, "many", rows) == star(spark, "one", rows)
    assert commits[1] == commits[2] and commits[0] == commits[4]
    assert [c.batch for c in Manifest(spark, f"{path}/many/_commits").commits()] == ["d0", "d1", "d2"]
    assert commits[0].facts["months"] == [[2018, 11]]
    # the songs b and c came last: the months of their plays were built anew
    assert commits[3].facts["months"] == [[2018, 1], [2018, 11], [2018, 12]]
    plays = spark.table("many.songplays")
    assert plays.count() == 7 and plays.where("song_id = 'Sb'").count() == 3
    assert plays.where("user_id = 3000000000").count() == 1

    # the same star as the job that loads everything at once, for a log without repeated lines
    deliver(everything["logs"], "1.json", DELIVERIES[1][0][:2])
    deliver(everything["songs"], "2.json", [song(s) for s in "bc"])
    music_job(spark, output=f"{path}/job", database="one", rebuild=True, **everything)
    assert star(spark, "many", rows) == star(spark, "one", rows)


def test_a_delivery_that_breaks_off_is_loaded_again(spark, path, rows, databases, monkeypatch):
    logs = deliver(f"{path}/logs", "x.json", DELIVERIES[0][0])
    songs = deliver(f"{path}/songs", "x.json", [song("a")])
    given = {"logs": logs, "songs": songs, "output": f"{path}/many", "database": "many"}
    broken = deliveries.music.build_artists
    monkeypatch.setattr(deliveries.music, "build_artists", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load_delivery(spark, batch="x", **given)
    assert Manifest(spark, f"{path}/many/_commits").commits() == []
    monkeypatch.setattr(deliveries.music, "build_artists", broken)
    assert load_delivery(spark, batch="x", **given).facts["songplays"] == 3
    load_delivery(spark, batch="x", **{**given, "output": f"{path}/one", "database": "one"})
    assert star(spark, "many", rows) == star(spark, "one", rows)


def test_other_months_are_not_read(spark, path, databases):
    given = {"output": f"{path}/many", "database": "many"}
    load_delivery(spark, batch="x", logs=deliver(f"{path}/a", "x.json", [line(1, m, m) for m in range(1, 13)]), **given)
    read = in_months(spark.table("many.plays_so_far"), [(2018, 3), (None, None)])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters")[1]
    files = {r.f for r in read.selectExpr("_metadata.file_path AS f").collect()}
    assert files and all("month=3/" in f for f in files)
    before = {p.name for p in Path(f"{path}/many/songplays.versions").iterdir()}
    load_delivery(spark, batch="y", logs=deliver(f"{path}/b", "x.json", [line(2, 1, 3)]), **given)
    new = {p.name for p in Path(f"{path}/many/songplays.versions").iterdir()} - before
    (version,) = new
    assert [p.name for p in Path(f"{path}/many/songplays.versions/{version}").rglob("month=*")] == ["month=3"]
    assert spark.table("many.songplays").count() == 13


BAD = ["{", '{"sessionId": "many"}', json.dumps({"page": "NextSong", "userId": "x1"}), "", "  "]


def test_bad_lines_are_counted_kept_and_fail_the_load(spark, path, rows, databases):
    logs = deliver(f"{path}/logs", "x.json", [*DELIVERIES[0][0], *BAD])
    songs = deliver(f"{path}/songs", "x.json", [song("a"), "no song"])
    given = {"logs": logs, "songs": songs, "database": "one"}
    for allowed in (0, 2):
        with pytest.raises(Exception, match="records rejected"):
            music_job(spark, output=f"{path}/one", allowed_rejects=allowed, **given)
    result = music_job(spark, output=f"{path}/one", allowed_rejects=3, **given)
    report = {(r.table_name, r.check_name): r.value for r in result.quality_report.collect()}
    assert report["staging_events", "rejected"] == 3 and report["staging_songs", "rejected"] == 1
    assert report["staging_events", "reconciled"] == report["staging_songs", "reconciled"] == 0
    told = rows(result.rejected["staging_events"].select("reason", "line"))
    assert told == sorted([("unreadable", BAD[0]), ("unreadable", BAD[1]), ("userId", BAD[2])])
    assert {r.file.rsplit("/", 1)[1] for r in result.rejected["staging_events"].collect()} == {"x.json"}
    staged = music_job(spark, output=f"{path}/two", progress=f"{path}/progress", allowed_rejects=3, database="many", logs=logs, songs=songs)
    assert {(r.table_name, r.check_name): r.value for r in staged.quality_report.collect()}["staging_events", "rejected"] == 3
    assert rows(staged.rejected["staging_events"].select("reason", "line")) == told
    with pytest.raises(RejectedError):
        load_delivery(spark, batch="x", output=f"{path}/three", allowed_rejects=2, **given)


def test_a_staged_log_that_has_no_file_yet(spark, path, databases):
    Path(f"{path}/logs").mkdir()
    songs = deliver(f"{path}/songs", "x.json", [song("a")])
    result = music_job(
        spark, logs=f"{path}/logs", songs=songs, output=f"{path}/out", progress=f"{path}/progress", database="many", enforce=False
    )
    assert {r.step: r.n_rows for r in result.load_report.collect()}["songplays"] == 0


def test_bad_arrivals_leave_the_table_as_it_was(spark, path, rows, databases):
    from test_storage import arrivals_input, record

    good = [record(1, 20545, 4, depdate="20550.0"), record(2, 20580, 5)]
    arrivals_job(spark, database="many", **arrivals_input(path, good))
    bad = arrivals_input(path, [*good, {**record(3, 20545, 4), "i94res": "abc"}, {**record(4, 20545, 4), "arrdate": "soon"}])
    with open(bad["arrivals"], "a", encoding="utf-8") as file:
        file.write("5.0,too,few\n")
    with pytest.raises(Exception, match="3 of 5 records rejected"):
        arrivals_job(spark, database="many", **bad)
    assert rows(spark.table("many.immigration").select("cicid")) == [(1,), (2,)]
    result = arrivals_job(spark, database="many", allowed_rejects=3, **bad)
    assert rows(result.rejected["immigration"].select("reason")) == [("arrdate",), ("i94res",), ("unreadable",)]
    assert any("5.0,too,few" in r.line for r in result.rejected["immigration"].collect())
    assert rows(spark.table("many.immigration").select("cicid")) == [(1,), (2,)]


def test_the_fact_is_read_twice_at_most(spark, path, databases, monkeypatch):
    from test_storage import arrivals_input, record

    inputs = arrivals_input(path, [record(1, 20545, 4, depdate="20550.0"), record(2, 20580, 5)])
    arrivals_job(spark, database="many", **inputs)
    scans = []
    table = type(spark).table

    def counted(self, name):
        scans.append(name)
        return table(self, name)

    monkeypatch.setattr(type(spark), "table", counted)
    whole = arrivals_job(spark, database="many", **inputs)
    plan = whole.quality_report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("immigration.versions") <= 3
    reads = [n for n in scans if n.endswith(".immigration")]
    assert len(reads) <= 3  # the count of the codes, the check of the key, and the loader's own look at the columns

    may = arrivals_input(path, [record(2, 20580, 5), record(3, 20581, 5)])
    part = arrivals_job(spark, database="many", reload="partitions", **may)
    fresh = arrivals_input(f"{path}/fresh", [record(1, 20545, 4, depdate="20550.0"), record(2, 20580, 5), record(3, 20581, 5)])
    again = arrivals_job(spark, database="one", **fresh)

    def checks(result):
        return {(r.table_name, r.check_name): r.value for r in result.quality_report.collect()}

    assert checks(part) == checks(again)
