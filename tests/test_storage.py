import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.lookups import STATE_CODES
from starloom.operators.quality import QualityError
from starloom.plans.jobs import arrivals_job, music_job
from starloom.schemas import CONTRACTS, LOG_JSON, TableContract, struct
from starloom.session import scratch_path, shared_folder
from starloom.sinks.load import LoadError, run_load
from starloom.sinks.parquet import write_parquet
from starloom.sinks.manifest import ConflictError, Manifest, append_batch, read_batches
from starloom.sinks.tables import clean_table, conform, create_table, drop_table, load_table
from starloom.sources import files
from starloom.sources.logs import log_columns, read_log_events, read_songs
from starloom.streaming.incremental import read_staged, stage_new_files
from starloom.workload import storage


def put(folder, name, text):
    target = Path(folder, name)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text, encoding="utf-8")
    return str(target)


# --- session ----------------------------------------------------------------------------------


def test_scratch_paths_are_new_and_in_the_named_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


# --- sources ----------------------------------------------------------------------------------


def test_generic_scan_honours_options_columns_and_load_size(spark, path):
    put(path, "a.csv", "x;y\n1;2\n3;4\n5;6\n")
    df = files.read_table(spark, path, "csv", columns=["y"], load_size=2, sep=";", inferSchema=True)
    assert df.columns == ["y"] and df.schema["y"].dataType.simpleString() == "int"
    assert df.count() == 2
    assert files.read_table(spark, path, "csv", header=False, columns="*").count() == 4


def test_delimited_with_bad_lines(spark, path, rows):
    put(path, "a.csv", "x,y\n1,2.5\nbad,3\n4\n")
    df = files.read_delimited(spark, path, "x int, y double", corrupt_column="bad").cache()
    assert rows(df) == [(1, 2.5, None), (4, None, "4"), (None, 3.0, "bad,3")]


def test_delimited_refuses_another_column_order(spark, path, rows):
    put(path, "a.csv", "dt,y\n1743-11-01,6.1\n")
    assert rows(files.read_delimited(spark, path, "dt timestamp_ntz, y double")) == [(dt.datetime(1743, 11, 1), 6.1)]
    with pytest.raises(Exception, match="(?i)header"):
        files.read_delimited(spark, path, "y double, dt timestamp_ntz").collect()


def test_lookup_keeps_two_text_columns(spark, path, rows):
    put(path, "a.csv", "Code;Note;Country\n101;n;ALBANIA\n 5;;X, Y\n")
    assert rows(files.read_lookup(spark, path)) == [(" 5", "X, Y"), ("101", "ALBANIA")]
    assert files.read_lookup(spark, path).dtypes == [("Code", "string"), ("Country", "string")]


def test_state_codes(spark, path):
    put(path, "s.csv", "Code;State\n" + "".join(f"{c};{s}\n" for c, s in STATE_CODES))
    states = files.read_state_lookup(spark, path)
    assert states.count() == 55 and states.where("Code = '99'").first().State == "All Other Code"
    assert len({c for c, _ in STATE_CODES}) == 55


DEMOGRAPHICS = """City;State;Median Age;Male Population;Female Population;Total Population;{v};Foreign-born;Average Household Size;State Code;Race;Count
Kent;Ohio;33.5;40;60;100;7;9;2.5;OH;Asian;5
Kent;Ohio;33.5;40;60;100;7;9;2.5;OH;White;80
Provo;Utah;;10;20;30;;;;UT;White;30
"""


@pytest.mark.parametrize("header", ["Number of Veterans", "Number Veterans"])
def test_demographics_accept_both_headers(spark, path, header):
    put(path, "d.csv", DEMOGRAPHICS.format(v=header))
    df = files.read_demographics(spark, path)
    row = df.where("City = 'Kent' AND Race = 'Asian'").first()
    assert (row["Number of Veterans"], row["Median Age"], row["Count"]) == (7, 33.5, 5)
    assert df.where("City = 'Provo'").first()["Median Age"] is None


def test_demographics_name_the_missing_column(spark, path):
    put(path, "d.csv", "City;State;State Code;Race\n")
    with pytest.raises(ValueError, match="Median Age"):
        files.read_demographics(spark, path)


def test_monthly_files(spark, path, rows):
    for name, n in (("i94_apr16_sub", 2), ("i94_dec15_sub", 3), ("other", 1)):
        spark.range(n).write.json(f"{path}/{name}")
    df = files.read_monthly(spark, f"{path}/*", "json", schema="id bigint")
    found = rows(df.groupBy("source_month", "source_year").count())
    assert found == [(12, 15, 3), (4, 16, 2), (None, None, 1)]


def test_schema_report_and_preview(spark, rows):
    df = spark.createDataFrame([(1, "a")], "n int, t string").select(F.lit(1).alias("one"), "t")
    assert rows(files.schema_report(df)) == [(0, "one", "int", False), (1, "t", "string", True)]
    assert files.preview(spark.range(10)).count() == 5


LOG_LINE = {
    "artist": "Sophie B. Hawkins", "auth": "Logged In", "firstName": "Katrin", "gender": "F",
    "itemInSession": 1, "lastName": "Neruda", "length": 99.1234, "level": "free", "location": "New York",
    "method": "PUT", "page": "NextSong", "registration": 1542837407796.0, "sessionId": 200,
    "song": "Harajuku Girls", "status": 200, "ts": 1542837407796, "userAgent": "UA", "userId": "26",
}


def write_logs(path, lines):
    put(path, "2018/11/log.json", "\n".join(json.dumps(x) for x in lines) + "\n")
    return path


def test_log_scan(spark, path):
    write_logs(path, [LOG_LINE, {**LOG_LINE, "userId": "", "ts": 0, "song": None}])
    log = read_log_events(spark, path)
    staging = CONTRACTS["staging_events"].schema
    assert {f.name: f.dataType for f in log.schema} == {f.name: f.dataType for f in staging[1:]}
    full, blank = log.orderBy("ts", ascending=False).collect()
    assert full.ts == dt.datetime(2018, 11, 21, 21, 56, 47, 796000)
    assert (full.registration, full.user_id, str(full.length)) == (1542837407796, 26, "99.12340")
    assert (blank.user_id, blank.song, blank.ts) == (None, None, dt.datetime(1970, 1, 1))


SONG = {
    "num_songs": 1, "artist_id": "AR8", "artist_latitude": None, "artist_longitude": None,
    "artist_location": "Panama", "artist_name": "Danilo Perez", "song_id": "SOG", "title": "City Slickers",
    "duration": 149.86404, "year": 2008,
}


def test_song_scan_in_nested_folders(spark, path):
    put(path, "A/B/one.json", json.dumps(SONG))
    put(path, "A/C/D/two.json", json.dumps({**SONG, "song_id": "SO2"}))
    songs = read_songs(spark, path)
    assert songs.count() == 2
    assert {str(r.duration) for r in songs.collect()} == {"149.86404"}


# --- sinks ------------------------------------------------------------------------------------


def test_optional_sink(spark, path):
    df = spark.range(3)
    assert write_parquet(df, None) is df
    assert write_parquet(df, f"{path}/out") is df
    assert spark.read.parquet(f"{path}/out").count() == 3
    for bad in ({"replace": "some"}, {"replace": "partitions"}):
        with pytest.raises(ValueError):
            write_parquet(df, f"{path}/out", **bad)


def months(spark, data):
    return spark.createDataFrame(data, "v int, y int, m int")


def test_reload_of_one_month(spark, path, rows):
    out = f"{path}/fact"
    write_parquet(months(spark, [(1, 2016, 4), (2, 2016, 5), (3, 2017, 4)]), out, ["y", "m"])
    write_parquet(months(spark, [(9, 2016, 5)]), out, ["y", "m"], replace="partitions")
    assert rows(spark.read.parquet(out)) == [(1, 2016, 4), (3, 2017, 4), (9, 2016, 5)]
    write_parquet(months(spark, [(7, 2016, 4)]), out, ["y", "m"], replace="nothing")
    assert spark.read.parquet(out).count() == 4
    write_parquet(months(spark, [(8, 2018, 1)]), out, ["y", "m"])
    assert rows(spark.read.parquet(out)) == [(8, 2018, 1)]


def test_partition_filter_prunes_folders(spark, path):
    out = f"{path}/fact"
    write_parquet(months(spark, [(1, 2016, 4), (2, 2016, 5)]), out, ["y", "m"])
    plan = spark.read.parquet(out).where("y = 2016 AND m = 5")._jdf.queryExecution().executedPlan()
    assert "(m#" in plan.toString().split("PartitionFilters")[1].split("]")[0]


def test_hot_partition_is_written_by_several_tasks(spark, path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    try:
        hot = spark.range(60_000, numPartitions=8).select("id", F.lit(2016).alias("y"))
        write_parquet(hot, f"{path}/hot", ["y"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(Path(path, "hot", "y=2016").glob("*.parquet"))) > 1


def test_sorted_layout(spark, path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    write_parquet(df, f"{path}/sorted", sort_by=["k"])
    for file in Path(path, "sorted").glob("*.parquet"):
        found = [r.k for r in spark.read.parquet(str(file)).collect()]
        assert found == sorted(found)


CONTRACT = TableContract(
    name="demo", schema=struct("id int, day date, part string, price double"), key=("id",),
    partition_by=("part",),
)


@pytest.fixture
def demo_rows(spark):
    return spark.createDataFrame(
        [("a", 1.5, "7", "2020-01-02", 0), ("b", 2.5, "8", "2020-01-03", 0)],
        "part string, price double, id string, day string, extra int",
    )


@pytest.fixture
def demo_table(spark, path):
    yield "demo_table", f"{path}/demo"
    drop_table(spark, "demo_table")


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_load_by_name_and_reload(spark, demo_rows, demo_table, rows, session_mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    table, location = demo_table
    for _ in range(2):
        assert load_table(demo_rows, CONTRACT, table, location=location) == 2
    stored = spark.table(table)
    assert stored.columns == ["id", "day", "price", "part"]
    assert rows(stored) == [(7, dt.date(2020, 1, 2), 1.5, "a"), (8, dt.date(2020, 1, 3), 2.5, "b")]
    load_table(demo_rows, CONTRACT, table, mode="append", location=location)
    assert spark.table(table).count() == 4
    one = demo_rows.where("part = 'b'")
    assert load_table(one, CONTRACT, table, mode="overwrite_partitions", location=location) == 1
    assert rows(spark.table(table).groupBy("part").count()) == [("a", 2), ("b", 1)]
    load_table(one, CONTRACT, table, location=location)
    assert spark.table(table).count() == 1


PLAIN = TableContract(name="plain", schema=struct("id int, price double"), key=("id",))


def test_readers_see_the_old_rows_until_a_load_is_through(spark, demo_rows, demo_table, path, rows):
    from pyspark.sql import functions as F

    table, location = demo_table
    load_table(demo_rows, CONTRACT, table, location=location)
    load_table(demo_rows, PLAIN, "plain_table", location=f"{path}/plain")
    before = [rows(spark.table(t)) for t in (table, "plain_table")]
    broken = demo_rows.withColumn("price", F.when(F.col("part") == "a", 9.0).otherwise(F.raise_error(F.lit("no price")).cast("double")))
    for mode in ("overwrite", "overwrite_partitions"):
        with pytest.raises(Exception, match="no price"):
            load_table(broken, CONTRACT, table, mode=mode, location=location)
        assert rows(spark.table(table)) == before[0]
    with pytest.raises(Exception, match="no price"):
        load_table(broken, PLAIN, "plain_table", location=f"{path}/plain")
    assert rows(spark.table("plain_table")) == before[1]
    load_table(demo_rows.limit(1), PLAIN, "plain_table", location=f"{path}/plain")
    assert spark.table("plain_table").count() == 1
    drop_table(spark, "plain_table")


def test_partitions_with_odd_and_missing_values(spark, path, rows):
    from starloom.sinks.publish import partition_folders, table_partitions

    odd = ["a b", "it's", "50%/x=y", "ü", "back\\slash", None]
    df = spark.createDataFrame([(i, None, p, 1.0) for i, p in enumerate(odd)], "id int, day date, part string, price double")
    for _ in range(2):
        load_table(df, CONTRACT, "odd_table", location=f"{path}/odd")
    assert rows(spark.table("odd_table").select("id", "part")) == [(i, p) for i, p in enumerate(odd)]
    known = table_partitions(spark, "odd_table", ["part"])
    assert known == {(p,) for p in odd}
    newest = max(Path(f"{path}/odd.versions").iterdir())
    assert set(partition_folders(spark, str(newest), ["part"])) == known
    load_table(df.where("id = 1"), CONTRACT, "odd_table", mode="overwrite_partitions", location=f"{path}/odd")
    assert spark.table("odd_table").count() == 6
    load_table(df.where("id = 1"), CONTRACT, "odd_table", location=f"{path}/odd")
    assert rows(spark.table("odd_table").select("part")) == [("it's",)]
    drop_table(spark, "odd_table")


def test_old_versions_are_deleted_only_when_nothing_shows_them(spark, demo_rows, demo_table, path, rows):
    table, location = demo_table
    for _ in range(2):
        load_table(demo_rows, CONTRACT, table, location=location)
    load_table(demo_rows.where("part = 'b'"), CONTRACT, table, mode="overwrite_partitions", location=location)
    assert clean_table(spark, CONTRACT, table) == []
    assert len(clean_table(spark, CONTRACT, table, older_than_hours=0)) == 1
    assert len(list(Path(f"{location}.versions").iterdir())) == 2
    assert spark.table(table).count() == 2
    for _ in range(3):
        load_table(demo_rows, PLAIN, "plain_table", location=f"{path}/plain")
    assert len(clean_table(spark, PLAIN, "plain_table", older_than_hours=0)) == 2
    assert spark.table("plain_table").count() == 2
    drop_table(spark, "plain_table")


# --- commits ----------------------------------------------------------------------------------


def test_batches_are_appended_once_and_ids_go_on(spark, path, rows):
    schema = "v string, id bigint"
    batches = {f"b{i}": spark.range(i * 10, i * 10 + 3 + i).select(F.concat(F.lit(f"b{i}-"), "id").alias("v")) for i in range(3)}
    folder = f"{path}/kept"
    assert read_batches(spark, folder, schema).count() == 0
    first = {}
    for name in ("b0", "b1", "b1", "b2", "b0"):
        done = append_batch(batches[name].repartition(2), folder, name, id_column="id")
        assert first.setdefault(name, done) == done
    stored = read_batches(spark, folder, schema)
    assert sorted(r.id for r in stored.collect()) == list(range(3 + 4 + 5))
    assert {r.v for r in stored.where("id < 3").collect()} == {r.v for r in batches["b0"].collect()}
    assert [c.facts["first_id"] for c in Manifest(spark, f"{folder}/_commits").commits()] == [0, 3, 7]


def test_a_batch_that_broke_off_is_seen_by_no_reader(spark, path):
    folder = f"{path}/kept"
    broken = spark.range(5).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("v"))
    with pytest.raises(Exception, match="stop"):
        append_batch(broken, folder, "one")
    assert read_batches(spark, folder, "v bigint").count() == 0
    append_batch(spark.range(5).select(F.col("id").alias("v")), folder, "one")
    assert read_batches(spark, folder, "v bigint").count() == 5


def test_one_of_two_writers_commits(spark, path):
    manifest = Manifest(spark, f"{path}/commits")
    assert manifest.commits() == [] and manifest.next_id() == 0
    manifest.commit("a", 0, rows=1, next_id=4)
    with pytest.raises(ConflictError):
        manifest.commit("b", 0, rows=2)
    assert manifest.committed("b") is None and manifest.committed("a").facts["rows"] == 1
    manifest.commit("b", 1, rows=2)
    assert [c.batch for c in manifest.commits()] == ["a", "b"] and manifest.next_id() == 4


def test_conform_names_missing_columns(spark, demo_rows):
    with pytest.raises(ValueError, match="price"):
        conform(demo_rows.drop("price"), CONTRACT)
    with pytest.raises(ValueError, match="mode"):
        load_table(demo_rows, CONTRACT, mode="merge")
    with pytest.raises(ValueError, match="no partitions"):
        load_table(demo_rows, CONTRACTS["country"], mode="overwrite_partitions")


def test_create_is_repeatable_and_follows_the_contract(spark, path):
    for contract in CONTRACTS.values():
        name = f"made_{contract.name}"
        for _ in range(2):
            create_table(spark, contract, name, f"{path}/{name}")
        stored = {f.name: f.dataType for f in spark.table(name).schema}
        assert stored == {f.name: f.dataType for f in contract.schema}
        drop_table(spark, name)
        drop_table(spark, name)
        assert not spark.catalog.tableExists(name)


def test_load_report(spark, rows):
    def fail():
        raise RuntimeError("no disk")

    report = run_load(spark, [{"a": lambda: 3}, {"b": lambda: None, "c": lambda: 4}])
    assert rows(report) == [(1, "a", "ok", 3, None), (2, "b", "ok", None, None), (2, "c", "ok", 4, None)]
    with pytest.raises(LoadError, match="b: no disk") as failure:
        run_load(spark, [{"a": lambda: 1}, {"b": fail, "c": lambda: 2}, {"d": lambda: 3}])
    assert rows(failure.value.report) == [
        (1, "a", "ok", 1, None),
        (2, "b", "failed", None, "no disk"),
        (2, "c", "ok", 2, None),
        (3, "d", "skipped", None, None),
    ]


# --- streaming --------------------------------------------------------------------------------


def test_incremental_staging(spark, path):
    source, target, progress = f"{path}/in", f"{path}/out", f"{path}/progress"

    def deliver(name, n):
        lines = [{**LOG_LINE, "itemInSession": i} for i in range(n)]
        put(source, name, "\n".join(json.dumps(x) for x in lines) + "\n")

    def stage():
        return stage_new_files(
            spark, source, target, progress, LOG_JSON,
            transform=lambda df: df.select(*log_columns()), max_files_per_batch=1,
        )

    deliver("one.json", 3)
    deliver("two.json", 2)
    assert stage() == 5
    assert stage() == 0
    deliver("three.json", 4)
    assert stage() == 4
    staged = read_staged(spark, target)
    assert staged.count() == 9
    assert "batch_id" not in staged.columns and "first_name" in staged.columns
    assert len(list(Path(target).glob("stream_id=*/batch_id=*"))) == 3


def test_staging_takes_late_files_and_refuses_a_foreign_target(spark, path):
    import os

    source, target = f"{path}/in", f"{path}/out"
    schema = "a int"

    def stage(progress):
        return stage_new_files(spark, source, target, f"{path}/{progress}", schema)

    Path(source).mkdir()
    assert stage("p") == 0
    assert read_staged(spark, target, schema).count() == 0
    put(source, "new.json", '{"a": 1}\n')
    assert stage("p") == 1
    late = put(source, "late.json", '{"a": 2}\n')
    month_ago = Path(late).stat().st_mtime - 30 * 86400
    os.utime(late, (month_ago, month_ago))
    assert stage("p") == 1
    with pytest.raises(ValueError, match="another stream"):
        stage("lost")
    assert sorted(r.a for r in read_staged(spark, target, schema).collect()) == [1, 2]


def test_no_file_is_lost_when_the_target_cannot_be_listed(spark, path, monkeypatch):
    from starloom.streaming import incremental

    source, target, progress = f"{path}/in", f"{path}/out", f"{path}/progress"
    put(source, "one.json", '{"a": 1}\n{"a": 2}\n')
    names = incremental._names

    def broken(session, folder):
        if folder == target:
            raise OSError("cannot list")
        return names(session, folder)

    monkeypatch.setattr(incremental, "_names", broken)
    with pytest.raises(OSError):
        stage_new_files(spark, source, target, progress, "a int")
    monkeypatch.setattr(incremental, "_names", names)
    assert stage_new_files(spark, source, target, progress, "a int") == 2
    # a stream whose id cannot be read fails its batch and takes the files the next time
    put(source, "two.json", '{"a": 3}\n')
    monkeypatch.setattr(incremental, "_stream_id", lambda *_: None)
    with pytest.raises(Exception, match="another stream|does not name its stream"):
        stage_new_files(spark, source, target, progress, "a int")
    monkeypatch.undo()
    assert stage_new_files(spark, source, target, progress, "a int") == 1
    assert sorted(r.a for r in read_staged(spark, target, "a int").collect()) == [1, 2, 3]


def test_a_slow_listing_of_a_foreign_target_ends(spark, path, monkeypatch):
    import time

    from starloom.streaming import incremental

    source, target = f"{path}/in", f"{path}/out"
    put(source, "one.json", '{"a": 1}\n')
    assert stage_new_files(spark, source, target, f"{path}/p", "a int") == 1
    names = incremental._names

    def slow(session, folder):
        time.sleep(2)
        return names(session, folder)

    monkeypatch.setattr(incremental, "_names", slow)
    with pytest.raises(ValueError, match="another stream"):
        stage_new_files(spark, source, target, f"{path}/other", "a int")
    assert not Path(f"{path}/other").exists()


# --- jobs -------------------------------------------------------------------------------------


@pytest.fixture
def database(spark, path):
    spark.sql(f"CREATE DATABASE job LOCATION '{path}/db'")
    yield "job"
    spark.sql("DROP DATABASE job CASCADE")


def arrivals_input(path, records):
    names = (
        "cicid i94res i94cit arrdate i94addr i94yr i94mon i94port i94mode i94visa visatype depdate "
        "dtaddto entdepa entdepd i94bir biryear gender airline"
    ).split()
    lines = [",".join(str(r.get(n, "")) for n in names) for r in records]
    put(path, "arrivals.csv", "\n".join([",".join(names), *lines]) + "\n")
    put(path, "codes.csv", "Code;Country\n101;ALBANIA\n209;JAPAN\n")
    put(path, "demographics.csv", DEMOGRAPHICS.format(v="Number of Veterans"))
    put(
        path,
        "temperature.csv",
        "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
        "2000-01-01,10.5,0.1,Tirana,Albania,41N,19E\n2000-02-01,,,Tirana,Albania,41N,19E\n"
        "2000-03-01,13.5,0.1,Tirana,Albania,41N,19E\n",
    )
    return {
        "arrivals": f"{path}/arrivals.csv",
        "temperature": f"{path}/temperature.csv",
        "country_codes": f"{path}/codes.csv",
        "demographics": f"{path}/demographics.csv",
        "output": f"{path}/out",
    }


def record(cicid, arrdate, month, **more):
    return {"cicid": f"{cicid}.0", "arrdate": f"{arrdate}.0", "i94yr": "2016.0", "i94mon": f"{month}.0",
            "i94res": "101.0", "i94addr": "OH", **more}


def test_arrivals_job(spark, path, database, rows):
    inputs = arrivals_input(path, [record(1, 20545, 4, depdate="20550.0"), record(2, 20580, 5)])
    result = arrivals_job(spark, database=database, **inputs)
    assert rows(result.load_report.select("step", "status", "n_rows")) == [
        ("country", "ok", 2), ("date", "ok", 3), ("immigration", "ok", 2), ("state", "ok", 2)
    ]
    assert result.quality_report.where("NOT passed").count() == 0
    assert rows(spark.table("job.country")) == [(101, "Albania", 12.0), (209, "Japan", None)]
    assert spark.table("job.immigration").where("cicid = 1").first().stay == 5
    assert spark.table("job.immigration").count() == 2

    arrivals_job(spark, database=database, **inputs)
    assert spark.table("job.immigration").count() == 2

    may = arrivals_input(path, [record(3, 20581, 5), record(4, 20582, 5)])
    arrivals_job(spark, database=database, reload="partitions", **may)
    assert rows(spark.table("job.immigration").select("cicid")) == [(1,), (3,), (4,)]
    assert spark.table("job.date").count() == 4


def test_arrivals_job_fails_on_repeated_key(spark, path, database):
    inputs = arrivals_input(path, [record(1, 20545, 4), record(1, 20545, 4)])
    with pytest.raises(QualityError, match=r"unique\(cicid\) = 1"):
        arrivals_job(spark, database=database, **inputs)
    lenient = arrivals_job(spark, database=database, enforce=False, **inputs)
    assert lenient.quality_report.where("NOT passed").count() == 1


def test_unknown_codes_are_reported_and_fail_only_if_strict(spark, path, database, rows):
    inputs = arrivals_input(path, [record(1, 20545, 4, i94addr="ZZ"), record(2, 20545, 4)])
    report = arrivals_job(spark, database=database, **inputs).quality_report
    assert rows(report.where("NOT passed").select("check_name", "value")) == [("referential(i94addr)", 1)]
    with pytest.raises(QualityError, match="i94addr"):
        arrivals_job(spark, database=database, strict_codes=True, **inputs)


def test_arrivals_job_reports_a_missing_input(spark, path, database, rows):
    inputs = arrivals_input(path, [record(1, 20545, 4)]) | {"temperature": f"{path}/absent.csv"}
    with pytest.raises(LoadError, match="country") as failure:
        arrivals_job(spark, database=database, **inputs)
    found = dict(rows(failure.value.report.select("step", "status")))
    assert found == {"immigration": "ok", "date": "ok", "country": "failed", "state": "ok"}


def test_music_job(spark, path, database, rows):
    song = {**SONG, "title": LOG_LINE["song"], "artist_name": LOG_LINE["artist"], "duration": LOG_LINE["length"]}
    lines = [
        LOG_LINE, {**LOG_LINE, "level": "paid", "ts": LOG_LINE["ts"] + 1000},
        {**LOG_LINE, "page": "Home"}, {**LOG_LINE, "song": None, "artist": None, "length": None, "userId": "27"},
    ]
    write_logs(f"{path}/logs", lines)
    put(f"{path}/songs", "A/one.json", json.dumps(song))
    inputs = {"logs": f"{path}/logs", "songs": f"{path}/songs", "output": f"{path}/out", "database": database}
    ids = set()
    for rebuild in (False, False, True):
        result = music_job(spark, rebuild=rebuild, **inputs)
        ids |= {r.songplay_id for r in spark.table("job.songplays").collect()}
        assert len(ids) == 3  # the same in every run
        assert result.load_report.where("status = 'ok'").count() == 7
        assert result.quality_report.where("NOT passed").count() == 0
        assert rows(spark.table("job.songplays").select("user_id", "level", "song_id")) == [
            (26, "free", "SOG"), (26, "paid", "SOG"), (27, "free", None)
        ]
        assert rows(spark.table("job.users").select("user_id", "level")) == [(26, "paid"), (27, "free")]
        assert spark.table("job.time").count() == 2
        assert spark.table("job.staging_events").select("staging_event_id").distinct().count() == 4


def test_music_job_reads_only_new_logs(spark, path, database):
    put(f"{path}/songs", "one.json", json.dumps(SONG))
    inputs = {"logs": f"{path}/logs", "songs": f"{path}/songs", "output": f"{path}/out", "database": database,
              "progress": f"{path}/progress"}
    for n, staged in ((1, 1), (2, 1), (2, 0)):
        put(f"{path}/logs", f"2018/{n:02d}/log.json", json.dumps({**LOG_LINE, "ts": n * 1000}) + "\n")
        report = music_job(spark, **inputs).load_report
        assert report.where("step = 'staging_events'").first().n_rows == staged
        assert spark.table("job.songplays").count() == n


# --- one-call functions and command line ------------------------------------------------------


def test_etl_functions_write_only_where_told(spark, path, rows):
    from starloom.plans.etl import etl_countries, etl_immigration, etl_states

    inputs = arrivals_input(path, [record(1, 20545, 4, depdate="20550.0"), record(2, 20580, 5)])
    fact = etl_immigration(spark, inputs["arrivals"])
    assert fact.count() == 2 and not Path(path, "out").exists()
    etl_immigration(spark, inputs["arrivals"], f"{path}/out/fact", f"{path}/out/date", load_size=1)
    assert rows(spark.read.parquet(f"{path}/out/fact").select("cicid", "i94yr", "i94mon")) == [(1, 2016, 4)]
    assert spark.read.parquet(f"{path}/out/date").count() == 2

    country = etl_countries(spark, inputs["temperature"], inputs["country_codes"], f"{path}/out/country")
    assert rows(spark.read.parquet(f"{path}/out/country")) == rows(country)
    state = etl_states(
        spark, inputs["demographics"], f"{path}/out/state", columns=["State", "StateCode", "MedianAge"],
        partition_by=["StateCode"],
    )
    assert state.count() == 2
    stored = spark.read.parquet(f"{path}/out/state")
    assert rows(stored.select("StateCode", "MedianAge")) == [("OH", 33.5), ("UT", 0.0)]


def test_create_and_drop_all(spark, database):
    from starloom.sinks.tables import create_tables, drop_tables

    for _ in range(2):
        create_tables(spark, list(CONTRACTS), database)
    assert {t.name for t in spark.catalog.listTables(database)} == set(CONTRACTS)
    for _ in range(2):
        drop_tables(spark, list(CONTRACTS), database)
    assert spark.catalog.listTables(database) == []


def test_command_line_arguments():
    from starloom.__main__ import parser

    given = parser().parse_args(
        "arrivals --arrivals a --temperature t --country-codes c --demographics d --output o "
        "--reload partitions --database db".split()
    )
    assert (given.country_codes, given.reload, given.load_size, given.database) == ("c", "partitions", None, "db")
    assert parser().parse_args(["create", "users", "songs"]).tables == ["users", "songs"]
    assert parser().parse_args(["drop"]).tables == []


def test_sized_conf():
    from starloom.session import sized_conf

    small = sized_conf(10**9, 10**8, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * 1024 * 1024)
    large = sized_conf(10**14, 2 * 10**13, 4000)
    assert large["spark.sql.shuffle.partitions"] == "50000"
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 500_000_000


def test_the_log_is_written_compressed(spark, path):
    storage.write_log(spark, "/root/testdata/sf0.001", f"{path}/log")
    names = [p.name for p in Path(f"{path}/log").glob("part-*")]
    assert names and all(n.endswith(".json.gz") for n in names)
    assert read_log_events(spark, f"{path}/log").count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
