"""Queries over sources and sinks. They write to new paths in the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starloom.functions.calendar import epoch_millis, epoch_millis_ts
from starloom.operators.profile import missing_profile
from starloom.plans import songplays as music
from starloom.plans.immigration import build_dates, build_immigration
from starloom.schemas import CONTRACTS, TableContract, struct
from starloom.session import scratch_path
from starloom.sinks.buckets import bucket_count, bucketed_left_join, load_bucketed
from starloom.sinks.load import LoadError, run_load
from starloom.sinks.parquet import write_parquet
from starloom.sinks.tables import create_table, drop_table, load_table
from starloom.sources.files import (
    preview,
    read_delimited,
    read_lookup,
    read_monthly,
    read_table,
    schema_report,
)
from starloom.sources.filesets import month_report, read_set, scan_set, set_report
from starloom.sources.logs import read_log_events, read_songs
from starloom.streaming.incremental import read_staged, stage_new_files
from starloom.workload import frames
from starloom.workload.registry import query, table

# --- sources ----------------------------------------------------------------------------------


@query(
    "generic_scan",
    "SELECT l_orderkey, l_partkey, l_returnflag, l_shipdate FROM lineitem",
)
def generic_scan(spark, sf):
    columns = ["l_orderkey", "l_partkey", "l_returnflag", "l_shipdate"]
    return read_table(spark, f"{sf}/lineitem.parquet", "parquet", columns=columns)


@query("parquet_scan", "SELECT * FROM orders")
def parquet_scan(spark, sf):
    return read_table(spark, f"{sf}/orders.parquet")


@query("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "orders-csv")
    orders.write.csv(path, sep=";", header=True)
    return read_delimited(spark, path, orders.schema, sep=";")


@query(
    "csv_inferred",
    """SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal
    FROM supplier""",
)
def csv_inferred(spark, sf):
    path = scratch_path(spark, "supplier-csv")
    table(spark, sf, "supplier").write.csv(path, header=True)
    return read_delimited(spark, path)


@query(
    "csv_corrupt_rows",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
      CASE WHEN o_orderstatus = 'P' THEN o_orderkey || ';n/a' END AS bad_line FROM orders""",
)
def csv_corrupt_rows(spark, sf):
    """Orders as text lines whose price is no number when the status is P."""
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    lines = table(spark, sf, "orders").select(
        F.concat_ws(";", F.col("o_orderkey").cast("string"), price).alias("value")
    )
    path = scratch_path(spark, "orders-text")
    lines.write.text(path)
    return read_delimited(
        spark,
        path,
        "o_orderkey bigint, o_totalprice double",
        sep=";",
        corrupt_column="bad_line",
        header=False,
    )


@query(
    "lookup_scan",
    'SELECT CAST(c_custkey AS VARCHAR) AS "Code", c_name AS "Country" FROM customer',
)
def lookup_scan(spark, sf):
    path = scratch_path(spark, "lookup")
    table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Code"),
        F.col("c_mktsegment").alias("Note"),
        F.col("c_name").alias("Country"),
    ).write.csv(path, sep=";", header=True)
    return read_lookup(spark, path)


def json_log(spark, sf):
    """Staged log rows back to the service's JSON keys; user 0 becomes a blank user."""
    return frames.log_events(spark, sf).select(
        "artist",
        "auth",
        F.col("first_name").alias("firstName"),
        "gender",
        F.col("item_in_session").alias("itemInSession"),
        F.col("last_name").alias("lastName"),
        "length",
        "level",
        "location",
        "method",
        "page",
        "registration",
        F.col("session_id").alias("sessionId"),
        "song",
        "status",
        epoch_millis("ts").alias("ts"),
        F.col("user_agent").alias("userAgent"),
        F.when(F.col("user_id") > 0, F.col("user_id").cast("string")).otherwise("").alias("userId"),
    )


def write_log(spark, sf, path):
    """The log as files the way services keep them: a tenth of the text's size."""
    json_log(spark, sf).write.json(path, compression="gzip")


@query(
    "json_log_scan",
    f"""WITH {frames.LOG_SQL} SELECT artist, auth, first_name, gender, item_in_session, last_name,
      CAST(length AS DOUBLE) AS length, level, location, method, page, registration,
      CAST(session_id AS BIGINT) AS session_id, song, status, ts, user_agent, CAST(nullif(user_id, 0) AS BIGINT) AS user_id FROM log""",
)
def json_log_scan(spark, sf):
    path = scratch_path(spark, "log-json")
    write_log(spark, sf, path)
    log = read_log_events(spark, path)
    return log.withColumn("length", F.col("length").cast("double"))


_SONG_OUT = """num_songs, artist_id, CAST(artist_latitude AS DOUBLE) AS artist_latitude,
  CAST(artist_longitude AS DOUBLE) AS artist_longitude, artist_location, artist_name, song_id,
  title, CAST(duration AS DOUBLE) AS duration, "year" """


@query("json_song_scan", f"WITH {frames.SONG_SQL} SELECT {_SONG_OUT} FROM song")
def json_song_scan(spark, sf):
    """Song files in nested folders, matched by key name."""
    path = scratch_path(spark, "song-json")
    songs = frames.song_metadata(spark, sf)
    folder = songs.withColumns({"a": F.col("year") % 3, "b": F.col("year") % 2})
    folder.write.partitionBy("a", "b").json(path)
    numbers = ("artist_latitude", "artist_longitude", "duration")
    return read_songs(spark, path).withColumns({c: F.col(c).cast("double") for c in numbers})


@query(
    "monthly_files",
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS source_month,
      CAST(year(o_orderdate) % 100 AS INTEGER) AS source_year, count(*) AS n_rows,
      min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders GROUP BY ALL""",
)
def monthly_files(spark, sf):
    """Orders kept as one folder per month named like i94_apr96_sub, below one that names a month too."""
    root = scratch_path(spark, "monthly_mar20")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    name = F.date_format("o_orderdate", "MMMyy")
    name = F.when(F.month("o_orderdate") == 4, F.upper(name)).otherwise(F.lower(name))
    folder = F.concat(F.lit("i94_"), name, F.lit("_sub"))
    write_parquet(orders.withColumn("set", folder), root, ["set"])
    months = read_monthly(spark, f"{root}/set=i94_*_sub")
    return months.groupBy("source_month", "source_year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("o_orderdate").alias("first_day"),
        F.max("o_orderdate").alias("last_day"),
    )


def _order_months(spark, sf):
    """Orders by month, in three layouts: April to June lack the price and have a priority, from July on the columns are
    turned round and the customer is narrower. Urgent orders stand in the folder of the month after theirs.
    """
    root = scratch_path(spark, "order-months")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    filed = F.when(urgent, F.add_months("o_orderdate", 1)).otherwise(F.to_date("o_orderdate"))
    orders = table(spark, sf, "orders").withColumn("set", F.concat(F.lit("i94_"), F.lower(F.date_format(filed, "MMMyy")), F.lit("_sub")))
    orders = orders.withColumn("filed", F.month(filed))
    key, day, price = "o_orderkey", "o_orderdate", "o_totalprice"
    layouts = [
        ((1, 3), [key, F.col("o_custkey"), price, day]),
        ((4, 6), [key, F.col("o_custkey"), day, "o_orderpriority"]),
        ((7, 12), [day, price, F.col("o_custkey").cast("int").alias("O_CUSTKEY"), key]),
    ]
    for (first, last), columns in layouts:
        # Folders by month, whose names are no column of the files.
        some = orders.where(F.col("filed").between(first, last)).select(*columns, "set")
        write_parquet(some, root, ["set"], replace="nothing")
    return scan_set(spark, f"{root}/set=i94_*_sub", required=[key])


_FILED_SQL = """filed AS (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate + INTERVAL 1 MONTH
      ELSE o_orderdate END AS filed FROM orders)"""


@query(
    "monthly_schemas",
    f"""WITH {_FILED_SQL} SELECT o_orderkey, o_custkey,
      CASE WHEN month(filed) NOT BETWEEN 4 AND 6 THEN o_totalprice END AS o_totalprice, o_orderdate,
      CASE WHEN month(filed) BETWEEN 4 AND 6 THEN o_orderpriority END AS o_orderpriority,
      CAST(month(filed) AS INTEGER) AS source_month, CAST(year(filed) % 100 AS INTEGER) AS source_year FROM filed""",
)
def monthly_schemas(spark, sf):
    """Months of three layouts as one table: columns by name, types widened, null where a month lacks a column."""
    return read_set(spark, _order_months(spark, sf)).drop("source_file")


@query(
    "monthly_schema_report",
    f"""WITH {_FILED_SQL}, months AS (SELECT DISTINCT year(filed) AS y, month(filed) AS m FROM filed),
      n AS (SELECT count(*) AS a, count(*) FILTER (m BETWEEN 4 AND 6) AS b, count(*) FILTER (m > 6) AS c FROM months)
    SELECT column_name, CAST(held AS INTEGER) AS n_members, CAST(a - held AS INTEGER) AS n_missing, held_types, read_type
    FROM n, LATERAL (VALUES ('o_orderkey', a, 'bigint', 'bigint'), ('o_custkey', a, 'bigint,int', 'bigint'),
      ('o_totalprice', a - b, 'double', 'double'), ('o_orderdate', a, 'timestamp_ntz', 'timestamp_ntz'),
      ('o_orderpriority', b, 'string', 'string')) AS t(column_name, held, held_types, read_type)""",
)
def monthly_schema_report(spark, sf):
    """How many months have a column, with which types, and the type it is read as."""
    report = set_report(spark, _order_months(spark, sf))
    names = ("column_name", "n_members", "n_missing", "read_type")
    return report.select(*names, F.concat_ws(",", "held_types").alias("held_types")).withColumn("column_name", F.lower("column_name"))


@query(
    "monthly_month_check",
    f"""WITH {_FILED_SQL} SELECT CAST(month(filed) AS INTEGER) AS source_month, CAST(year(filed) % 100 AS INTEGER) AS source_year,
      count(*) AS n_rows, count(*) FILTER (o_orderpriority = '1-URGENT') AS n_other_month, CAST(0 AS BIGINT) AS n_unknown
    FROM filed GROUP BY ALL""",
)
def monthly_month_check(spark, sf):
    """Rows that stand in the files of another month than their own."""
    rows = read_set(spark, _order_months(spark, sf), ["o_orderdate"])
    return month_report(rows, F.year("o_orderdate"), F.month("o_orderdate"))


def _row_check(spark, sf, some):
    """How many rows there are, and how many of them stand in the table; which come is not defined."""
    lines = table(spark, sf, "lineitem").select(F.xxhash64("*").alias("row")).distinct()
    found = some.select(F.xxhash64("*").alias("row")).join(lines, "row", "left")
    return found.agg(F.count(F.lit(1)).alias("n_rows"), F.count("row").alias("n_known"))


@query("preview", "SELECT count(*) AS n_rows, count(*) AS n_known FROM (SELECT * FROM lineitem LIMIT 5)")
def preview_query(spark, sf):
    """The limit is the operator here."""
    return _row_check(spark, sf, preview(table(spark, sf, "lineitem"), 5))


@query("load_size", "SELECT count(*) AS n_rows, count(*) AS n_known FROM (SELECT * FROM lineitem LIMIT 1000)")
def load_size_query(spark, sf):
    """The limit is the operator here."""
    return _row_check(spark, sf, read_table(spark, f"{sf}/lineitem.parquet", load_size=1000))


@query(
    "json_corrupt_rows",
    """SELECT CASE WHEN l_linenumber <> 4 THEN CAST(l_orderkey AS BIGINT) END AS session_id,
      CASE WHEN l_linenumber = 4 THEN '{"sessionId":' || l_orderkey || ',"ts":' END AS bad_line FROM lineitem""",
)
def json_corrupt_rows(spark, sf):
    """Line items as log lines that break off where the line number is 4."""
    head = F.concat(F.lit('{"sessionId":'), F.col("l_orderkey").cast("string"), F.lit(',"ts":'))
    line = F.when(F.col("l_linenumber") == 4, head).otherwise(F.concat(head, F.lit("0}")))
    path = scratch_path(spark, "log-text")
    table(spark, sf, "lineitem").select(line.alias("value")).write.text(path)
    return read_log_events(spark, path, corrupt_column="bad_line").select("session_id", "bad_line")


@query(
    "schema_report",
    """SELECT CAST(ordinal_position - 1 AS INTEGER) AS "position", column_name,
      CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
        WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS data_type,
      true AS nullable, CAST(0 AS BIGINT) AS missing, (SELECT count(*) FROM lineitem) AS n_rows
    FROM (VALUES (1, 'l_orderkey', 'BIGINT'), (2, 'l_partkey', 'BIGINT'),
      (3, 'l_suppkey', 'BIGINT'), (4, 'l_linenumber', 'INTEGER'), (5, 'l_quantity', 'DOUBLE'),
      (6, 'l_extendedprice', 'DOUBLE'), (7, 'l_discount', 'DOUBLE'), (8, 'l_tax', 'DOUBLE'),
      (9, 'l_returnflag', 'VARCHAR'), (10, 'l_linestatus', 'VARCHAR'),
      (11, 'l_shipdate', 'TIMESTAMP')) AS t(ordinal_position, column_name, data_type)""",
)
def schema_report_query(spark, sf):
    """Schema listing next to what the columns hold."""
    lines = table(spark, sf, "lineitem")
    held = missing_profile(lines).select("column_name", "missing", "n_rows")
    return schema_report(lines).join(held, "column_name")


# --- sinks ------------------------------------------------------------------------------------


@query("parquet_overwrite", "SELECT * FROM customer")
def parquet_overwrite(spark, sf):
    """The second write replaces the first."""
    path = scratch_path(spark, "customer")
    customer = table(spark, sf, "customer")
    write_parquet(customer, path)
    write_parquet(customer, path)
    return spark.read.schema(customer.schema).parquet(path)


@query(
    "parquet_partitioned",
    f"""WITH {frames.ARRIVALS_SQL} SELECT cicid, i94res, arrdate,
      CASE WHEN i94yr = 1997 AND i94mon = 4 THEN 'reloaded' ELSE i94addr END AS i94addr,
      i94yr, i94mon, stay FROM fact""",
)
def parquet_partitioned(spark, sf):
    """Fact partitioned by year and month, one month reloaded: only that month is replaced."""
    path = scratch_path(spark, "fact")
    fact = build_immigration(frames.arrivals_raw(spark, sf))
    months = CONTRACTS["immigration"].partition_by
    write_parquet(fact, path, months)
    april = fact.where((F.col("i94yr") == 1997) & (F.col("i94mon") == 4))
    write_parquet(
        april.withColumn("i94addr", F.lit("reloaded")), path, months, replace="partitions"
    )
    columns = ["cicid", "i94res", "arrdate", "i94addr", "i94yr", "i94mon", "stay"]
    return spark.read.schema(fact.schema).parquet(path).select(*columns)


@query(
    "partition_pruned_read",
    f"""WITH {frames.ARRIVALS_SQL} SELECT i94res, count(*) AS arrivals FROM fact
    WHERE i94yr = 1998 AND i94mon BETWEEN 3 AND 5 GROUP BY i94res""",
)
def partition_pruned_read(spark, sf):
    """A period of the fact: only its month folders are read."""
    path = scratch_path(spark, "fact")
    fact = build_immigration(frames.arrivals_raw(spark, sf))
    write_parquet(fact, path, CONTRACTS["immigration"].partition_by)
    stored = spark.read.schema(fact.schema).parquet(path)
    period = stored.where((F.col("i94yr") == 1998) & F.col("i94mon").between(3, 5))
    return period.groupBy("i94res").agg(F.count(F.lit(1)).alias("arrivals"))


@query("layout_sorted", "SELECT p_partkey, p_name, p_brand FROM part")
def layout_sorted(spark, sf):
    path = scratch_path(spark, "part-sorted")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    write_parquet(part, path, sort_by=["p_partkey"])
    return spark.read.schema(part.schema).parquet(path)


def _table(name: str) -> str:
    return f"starloom_{name}_{uuid.uuid4().hex[:12]}"


_ORDER_TABLE = TableContract(
    name="order_totals",
    schema=struct("order_id int, placed date, price double, status string"),
    key=("order_id",),
    partition_by=("status",),
)

_ORDER_SQL = """SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_orderdate AS DATE) AS placed,
  o_totalprice AS price, o_orderstatus AS status FROM orders"""


def _order_rows(spark, sf):
    """Columns in another order and with other types than the table has, and one column too many."""
    return table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("unused"),
        F.col("o_orderdate").alias("placed"),
        F.col("o_orderkey").cast("string").alias("order_id"),
    )


@query("table_load_by_name", _ORDER_SQL)
def table_load_by_name(spark, sf):
    """Create from the contract, load by column name, twice: the second load replaces the first."""
    name, path = _table("orders"), scratch_path(spark, "orders-table")
    create_table(spark, _ORDER_TABLE, name, path)
    load_table(_order_rows(spark, sf), _ORDER_TABLE, name, location=path)
    load_table(_order_rows(spark, sf), _ORDER_TABLE, name, location=path)
    return spark.table(name)


@query(
    "table_partition_reload",
    _ORDER_SQL.replace("o_totalprice AS", "CASE o_orderstatus WHEN 'F' THEN 0 ELSE o_totalprice END AS"),
)
def table_partition_reload(spark, sf):
    """Only the partition that is loaded again changes."""
    name, path = _table("orders"), scratch_path(spark, "orders-table")
    rows = _order_rows(spark, sf)
    load_table(rows, _ORDER_TABLE, name, location=path)
    filled = rows.where(F.col("status") == "F").withColumn("price", F.lit(0.0))
    load_table(filled, _ORDER_TABLE, name, mode="overwrite_partitions", location=path)
    return spark.table(name)


@query(
    "rows_during_a_load",
    """SELECT status, count(*) AS n_rows, CAST(sum(CAST(round(price * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM (""" + _ORDER_SQL + """) GROUP BY status""",
)
def rows_during_a_load(spark, sf):
    """A reload that breaks off half way, in whole and by partitions: readers see the rows of the load before."""
    name, path = _table("orders"), scratch_path(spark, "orders-table")
    rows = _order_rows(spark, sf)
    load_table(rows, _ORDER_TABLE, name, location=path)
    stops = F.when(F.col("status") == "F", F.raise_error(F.lit("stop"))).otherwise("0").cast("double")
    for mode in ("overwrite", "overwrite_partitions"):
        try:
            load_table(rows.withColumn("price", stops), _ORDER_TABLE, name, mode=mode, location=path)
        except PySparkException:
            continue
        raise AssertionError("the load went through")
    cents = F.sum(F.round(F.col("price") * 100).cast("bigint")).alias("cents")
    return spark.table(name).groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"), cents)


@query(
    "bucketed_join",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, o_orderdate
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def bucketed_join(spark, sf):
    """Line items and orders stored by the order's key: the join moves no row."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    left, right = _table("lines"), _table("orders")
    buckets = bucket_count(lines, least=8)
    load_bucketed(lines, left, ["l_orderkey"], buckets, location=scratch_path(spark, "bucketed-lines"))
    load_bucketed(orders, right, ["o_orderkey"], buckets, location=scratch_path(spark, "bucketed-orders"))
    return bucketed_left_join(spark, left, right, {"l_orderkey": "o_orderkey"}, spread_by=["l_linenumber"]).drop("o_orderkey")


_HOT_SUPPLIER = "CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN l_suppkey END"


@query(
    "bucketed_hot_join",
    f"""SELECT l_orderkey, l_linenumber, key, s_name, s_nationkey
    FROM (SELECT *, {_HOT_SUPPLIER} AS key FROM lineitem) LEFT JOIN supplier ON key = s_suppkey""",
)
def bucketed_hot_join(spark, sf):
    """Half of the lines have one supplier and a quarter have none: these rows are stored apart, after a load of other rows."""
    lines = table(spark, sf, "lineitem")
    lines = lines.select("l_orderkey", "l_linenumber", F.expr(_HOT_SUPPLIER).alias("key"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    left, right = _table("lines"), _table("suppliers")
    at = scratch_path(spark, "bucketed-lines")
    buckets = bucket_count(lines, least=8)
    load_bucketed(lines.where("key = 1"), left, ["key"], buckets, location=at)
    hot = lines.count() // 10
    load_bucketed(lines, left, ["key"], buckets, location=at, hot_rows=hot)
    load_bucketed(suppliers, right, ["s_suppkey"], buckets, location=scratch_path(spark, "bucketed-suppliers"))
    found = bucketed_left_join(spark, left, right, {"key": "s_suppkey"}, spread_by=["l_orderkey", "l_linenumber"])
    return found.drop("s_suppkey")


@query("table_drop_and_load", _ORDER_SQL)
def table_drop_and_load(spark, sf):
    """A filled table is dropped; the next load shows its own rows only."""
    name, path = _table("dropped"), scratch_path(spark, "dropped")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("order_id"),
        F.lit(None).cast("date").alias("placed"),
        F.col("p_retailprice").alias("price"),
        F.col("p_brand").alias("status"),
    )
    load_table(parts, _ORDER_TABLE, name, location=path)
    drop_table(spark, name)
    load_table(_order_rows(spark, sf), _ORDER_TABLE, name, location=path)
    return spark.table(name)


def _uri(spark, path: str) -> str:
    """The path with the scheme of its store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()


@query("uri_roundtrip", "SELECT * FROM customer")
def uri_roundtrip(spark, sf):
    """Scan and sink by URI instead of by path."""
    source, target = _uri(spark, f"{sf}/customer.parquet"), _uri(spark, scratch_path(spark, "customer-uri"))
    write_parquet(read_table(spark, source), target)
    return read_table(spark, target)


@query(
    "append_load",
    """SELECT CAST(p_partkey AS INTEGER) AS order_id, CAST(NULL AS DATE) AS placed,
      p_retailprice AS price, p_brand AS status FROM part
    UNION ALL """
    + _ORDER_SQL,
)
def append_load(spark, sf):
    """INSERT INTO ... SELECT and an appending load into one table."""
    name, path = _table("appended"), scratch_path(spark, "appended")
    drop_table(spark, name)
    create_table(spark, _ORDER_TABLE, name, path)
    spark.sql(
        f"INSERT INTO {name} (order_id, placed, price, status) "
        "SELECT cast(p_partkey AS int), cast(NULL AS date), p_retailprice, p_brand FROM {part}",
        part=table(spark, sf, "part"),
    )
    load_table(_order_rows(spark, sf), _ORDER_TABLE, name, mode="append", location=path)
    return spark.table(name)


@query(
    "load_report",
    f"""{frames.PLAYS_SQL}, {frames.ARRIVALS_SQL} SELECT 1 AS phase, 'fact' AS step, 'ok' AS status,
      count(*) AS n_rows, CAST(NULL AS VARCHAR) AS error FROM fact
    UNION ALL SELECT 2, 'dates', 'ok', (SELECT count(*) FROM (
      SELECT arrdate AS d FROM fact UNION SELECT depdate FROM fact) WHERE d IS NOT NULL), NULL
    UNION ALL SELECT 2, 'users', 'ok', count(DISTINCT user_id), NULL FROM play""",
)
def load_report(spark, sf):
    """A fact, then two dimensions side by side; the report counts the rows as they are written."""
    root = scratch_path(spark, "job")
    names = {n: _table(n) for n in ("immigration", "date", "users")}

    def load(name, df):
        return load_table(df, CONTRACTS[name], names[name], location=f"{root}/{name}")

    return run_load(
        spark,
        [
            {"fact": lambda: load("immigration", build_immigration(frames.arrivals_raw(spark, sf)))},
            {
                "dates": lambda: load("date", build_dates(spark.table(names["immigration"]))),
                "users": lambda: load("users", music.build_users(frames.log_events(spark, sf))),
            },
        ],
    )


@query(
    "load_failure_report",
    """SELECT 1 AS phase, 'lines' AS step, 'ok' AS status, count(*) AS n_rows, CAST(0 AS INTEGER) AS n_chars FROM lineitem
    UNION ALL SELECT 1, 'broken', 'failed', NULL, 3000 UNION ALL SELECT 2, 'later', 'skipped', NULL, 0""",
)
def load_failure_report(spark, sf):
    """A step that fails keeps its whole error text, its phase goes on, and the next phase is skipped."""

    def broken():
        raise ValueError("x" * 3000)

    def lines():
        return table(spark, sf, "lineitem").count()

    try:
        run_load(spark, [{"lines": lines, "broken": broken}, {"later": lines}])
    except LoadError as error:
        n_chars = F.coalesce(F.char_length("error"), F.lit(0)).alias("n_chars")
        return error.report.select("phase", "step", "status", "n_rows", n_chars)
    raise AssertionError("a failed step went unnoticed")


@query(
    "incremental_stage",
    """SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id, event_type, value, props
    FROM events""",
)
def incremental_stage(spark, sf):
    """Events arrive in three deliveries; a run after each, and one more that finds nothing new."""
    root = scratch_path(spark, "incoming")
    source, target, progress = f"{root}/in", f"{root}/out", f"{root}/progress"
    events = table(spark, sf, "events").withColumn("ts", epoch_millis("ts"))
    schema = "event_id bigint, ts bigint, user_id bigint, event_type string, value double, props string"

    def stage():
        return stage_new_files(
            spark,
            f"{source}/*",
            target,
            progress,
            schema,
            transform=lambda df: df.withColumn("ts", epoch_millis_ts("ts")),
            max_files_per_batch=1000,
        )

    deliveries = {"web": ("view", "click"), "shop": ("purchase", "signup"), "rest": ("error",)}
    for name, kinds in deliveries.items():
        events.where(F.col("event_type").isin(*kinds)).write.json(f"{source}/{name}")
        stage()
    stage()
    return read_staged(spark, target)
