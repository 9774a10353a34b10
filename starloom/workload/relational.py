"""Queries over projections, filters, joins, aggregations, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import calendar, values
from starloom.functions.keys import md5_key
from starloom.lookups import MODE_LABELS, VISA_LABELS
from starloom.operators import aggregates, clean
from starloom.operators.joins import broadcast_if_small, left_join, star_join
from starloom.workload.registry import query, table

_MONEY = "decimal(18,2)"


# --- projections and predicates ---------------------------------------------------------------


@query(
    "project_columns",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus,
      o_orderpriority, o_orderkey * 2 + 1 - o_custkey AS mixed FROM orders""",
)
def project_columns(spark, sf):
    return (
        table(spark, sf, "orders")
        .withColumns({"mixed": F.col("o_orderkey") * 2 + 1 - F.col("o_custkey")})
        .drop("o_totalprice", "o_orderdate")
        .withColumnsRenamed({"o_orderkey": "order_id", "o_custkey": "customer_id"})
    )


@query(
    "filter_before_join",
    """SELECT e.event_id, e.user_id, e.start_time, c_name FROM
      (SELECT date_trunc('second', ts) AS start_time, * FROM events WHERE event_type = 'purchase') e
      LEFT JOIN customer ON user_id = c_custkey""",
)
def filter_before_join(spark, sf):
    bought = (
        table(spark, sf, "events")
        .where(F.col("event_type") == "purchase")
        .select("*", calendar.truncate_to_second("ts").alias("start_time"))
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    joined = left_join(bought, customer, {"user_id": "c_custkey"})
    return joined.select("event_id", "user_id", "start_time", "c_name")


@query(
    "cast_columns",
    """SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS price_text,
      CAST(trunc(p_retailprice) AS INTEGER) AS price_int, CAST(p_size AS DOUBLE) AS size_double,
      TRY_CAST(TRY_CAST(p_type AS DOUBLE) AS INTEGER) AS type_int FROM part""",
)
def cast_columns(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_retailprice").alias("price_text"),
        F.col("p_retailprice").cast("string").alias("price_int"),
        F.col("p_size").alias("size_double"),
        F.col("p_type").alias("type_int"),
    )
    return clean.cast_columns(
        part, ints=["price_int", "type_int"], doubles=["size_double"], texts=["price_text"]
    )


@query(
    "recode_values",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'INDUSTRY'
      WHEN 'AUTOMOBILE' THEN 'CARS' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
)
def recode_values(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    rules = {"c_mktsegment": {"MACHINERY": "INDUSTRY", "AUTOMOBILE": "CARS"}}
    return clean.recode_columns(customer, rules)


@query(
    "conditional_value",
    """SELECT l_returnflag, count(CASE WHEN l_discount > 0.05 THEN 1 END) AS n_discounted,
      sum(CASE WHEN l_linestatus = 'O' THEN l_linenumber ELSE 0 END)::BIGINT AS open_lines
    FROM lineitem GROUP BY l_returnflag""",
)
def conditional_value(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.when(F.col("l_discount") > 0.05, 1)).alias("n_discounted"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_linenumber")).otherwise(0)).alias(
            "open_lines"
        ),
    )


@query(
    "fill_zero",
    """SELECT c_custkey, coalesce(o_orderkey, 0) AS o_orderkey,
      coalesce(o_totalprice, 0) AS o_totalprice, o_orderpriority
    FROM customer LEFT JOIN (SELECT * FROM orders
      WHERE o_orderstatus = 'F' AND o_totalprice > 300000) ON c_custkey = o_custkey""",
)
def fill_zero(spark, sf):
    return clean.fill_zero(_customers_with_large_orders(spark, sf), ["o_orderkey", "o_totalprice"])


def _customers_with_large_orders(spark, sf):
    large = table(spark, sf, "orders").where(
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)
    )
    customer = table(spark, sf, "customer").select("c_custkey")
    return left_join(customer, large, {"c_custkey": "o_custkey"}).select(
        "c_custkey", "o_orderkey", "o_totalprice", "o_orderpriority"
    )


@query(
    "drop_null_rows",
    """SELECT c_custkey, o_orderkey, o_totalprice, o_orderpriority
    FROM customer JOIN orders ON c_custkey = o_custkey
    WHERE o_orderstatus = 'F' AND o_totalprice > 300000""",
)
def drop_null_rows(spark, sf):
    return clean.drop_rows_missing_all(
        _customers_with_large_orders(spark, sf), ["o_orderkey", "o_totalprice"]
    )


# --- joins ------------------------------------------------------------------------------------


@query(
    "left_join_multi_key",
    """SELECT a.l_orderkey, a.l_partkey, a.l_suppkey, a.l_linenumber,
      b.l_quantity AS returned_quantity
    FROM lineitem a LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') b
      ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey""",
)
def left_join_multi_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    returned = lines.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("r_orderkey"),
        F.col("l_partkey").alias("r_partkey"),
        F.col("l_suppkey").alias("r_suppkey"),
        F.col("l_quantity").alias("returned_quantity"),
    )
    left = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    on = {"l_orderkey": "r_orderkey", "l_partkey": "r_partkey", "l_suppkey": "r_suppkey"}
    return left_join(left, returned, on, spread_by=["l_linenumber"]).select(
        *left.columns, "returned_quantity"
    )


@query(
    "left_join_unmatched",
    """SELECT c_custkey, o_orderkey, o_totalprice, o_orderpriority
    FROM customer LEFT JOIN (SELECT * FROM orders
      WHERE o_orderstatus = 'F' AND o_totalprice > 300000) ON c_custkey = o_custkey""",
)
def left_join_unmatched(spark, sf):
    return _customers_with_large_orders(spark, sf)


@query(
    "inner_join_using",
    f"""SELECT l_orderkey, o_custkey, o_totalprice, CAST(quantity AS DOUBLE) AS quantity
    FROM (SELECT l_orderkey, sum(CAST(l_quantity AS {_MONEY})) AS quantity FROM lineitem GROUP BY ALL)
      JOIN (SELECT o_orderkey AS l_orderkey, o_custkey, o_totalprice FROM orders) USING (l_orderkey)""",
)
def inner_join_using(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("quantity", F.col("l_quantity").cast(_MONEY))
    total = aggregates.sum_per_key(lines, ["l_orderkey"], ["quantity"])
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice")
    return total.join(orders, "l_orderkey", "inner").withColumn("quantity", F.col("quantity").cast("double"))


@query(
    "star_join",
    """SELECT r_name, p_brand, count(*) AS n_lines FROM lineitem
      LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
      LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey
    GROUP BY ALL""",
)
def star_join_query(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return (
        star_join(
            table(spark, sf, "lineitem").select("l_suppkey", "l_partkey"),
            (supplier, "l_suppkey", "s_suppkey"),
            (nation, "s_nationkey", "n_nationkey"),
            (table(spark, sf, "region"), "n_regionkey", "r_regionkey"),
            (part, "l_partkey", "p_partkey"),
        )
        .groupBy("r_name", "p_brand")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


@query(
    "layout_broadcast",
    """SELECT n_name, count(*) AS n_customers FROM customer
      JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def layout_broadcast(spark, sf):
    nation = broadcast_if_small(table(spark, sf, "nation"))
    customer = table(spark, sf, "customer")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )


# --- aggregations -----------------------------------------------------------------------------


@query(
    "min_per_key",
    """SELECT l_orderkey, l_partkey, l_suppkey, min(l_quantity) AS l_quantity,
      min(l_extendedprice) AS l_extendedprice, min(l_discount) AS l_discount
    FROM lineitem GROUP BY ALL""",
)
def min_per_key(spark, sf):
    return aggregates.min_per_key(
        table(spark, sf, "lineitem"),
        ["l_orderkey", "l_partkey", "l_suppkey"],
        ["l_quantity", "l_extendedprice", "l_discount"],
    )


@query(
    "sum_per_key",
    """SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber,
      CAST(sum(l_suppkey) AS BIGINT) AS l_suppkey FROM lineitem GROUP BY ALL""",
)
def sum_per_key(spark, sf):
    return aggregates.sum_per_key(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_linenumber", "l_suppkey"]
    )


@query(
    "avg_per_key",
    """SELECT o_orderpriority, avg(CASE WHEN o_orderstatus <> 'P' THEN round(o_totalprice * 100) END)
      AS cents FROM orders GROUP BY o_orderpriority""",
)
def avg_per_key(spark, sf):
    cents = F.when(F.col("o_orderstatus") != "P", F.round(F.col("o_totalprice") * 100))
    orders = table(spark, sf, "orders").withColumn("cents", cents)
    return aggregates.avg_per_key(orders, ["o_orderpriority"], ["cents"])


@query(
    "pivot_sum",
    f"""SELECT c_nationkey,
      CAST(sum(CAST(c_acctbal AS {_MONEY})) FILTER (c_mktsegment = 'AUTOMOBILE') AS DOUBLE) AS cars,
      CAST(sum(CAST(c_acctbal AS {_MONEY})) FILTER (c_mktsegment = 'BUILDING') AS DOUBLE) AS building,
      CAST(sum(CAST(c_acctbal AS {_MONEY})) FILTER (c_mktsegment = 'NONE') AS DOUBLE) AS nothing
    FROM customer GROUP BY c_nationkey""",
)
def pivot_sum(spark, sf):
    names = {"AUTOMOBILE": "cars", "BUILDING": "building", "NONE": "nothing"}
    customer = table(spark, sf, "customer").withColumn("bal", F.col("c_acctbal").cast(_MONEY))
    pivoted = aggregates.pivot_sum(customer, ["c_nationkey"], "c_mktsegment", names, "bal")
    return pivoted.withColumns({c: F.col(c).cast("double") for c in names.values()})


@query(
    "weighted_mean",
    f"""SELECT l_suppkey,
      CAST(sum(CAST(l_extendedprice AS {_MONEY}) * CAST(l_quantity AS INTEGER)) AS DOUBLE)
        / nullif(CAST(CAST(sum(l_quantity) AS BIGINT) AS DOUBLE), 0) AS mean_price,
      CAST(sum(CAST(l_extendedprice AS {_MONEY}) * (l_linenumber - 1))
        FILTER (l_returnflag = 'N') AS DOUBLE)
        / nullif(CAST(CAST(sum(l_linenumber - 1) FILTER (l_returnflag = 'N') AS BIGINT) AS DOUBLE), 0)
        AS mean_kept
    FROM lineitem GROUP BY l_suppkey""",
)
def weighted_mean(spark, sf):
    price = F.col("l_extendedprice").cast(_MONEY)
    kept = F.when(F.col("l_returnflag") == "N", price)
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        values.weighted_mean(price, F.col("l_quantity").cast("int")).alias("mean_price"),
        values.weighted_mean(kept, F.col("l_linenumber") - 1, "skip").alias("mean_kept"),
    )


@query(
    "row_count",
    "SELECT count(*) AS n_rows, count(l_shipdate) AS n_dates FROM lineitem",
)
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("l_shipdate").alias("n_dates")
    )


@query("distinct_values", "SELECT DISTINCT o_orderdate FROM orders")
def distinct_values(spark, sf):
    return table(spark, sf, "orders").select("o_orderdate").distinct()


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct()


@query(
    "drop_duplicates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey, l_suppkey) = 1""",
)
def drop_duplicates(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return clean.one_per_key(lines, ["l_orderkey", "l_linenumber"])


# --- scalar functions -------------------------------------------------------------------------


_TITLED = (
    "array_to_string(list_transform(string_split(lower({0}), ' '), "
    "lambda w: upper(w[1]) || w[2:]), ' ')"
)


@query(
    "text_functions",
    f"""SELECT o_orderkey, lower(o_orderpriority) AS lowered,
      {_TITLED.format("o_orderpriority")} AS titled, o_orderkey || o_orderstatus AS joined
    FROM orders""",
)
def text_functions(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.lower("o_orderpriority").alias("lowered"),
        values.title_case("o_orderpriority").alias("titled"),
        F.concat(F.col("o_orderkey").cast("string"), "o_orderstatus").alias("joined"),
    )


@query(
    "title_case",
    f"SELECT p_partkey, {_TITLED.format('upper(p_name)')} AS titled FROM part",
)
def title_case(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", values.title_case(F.upper("p_name")).alias("titled")
    )


@query(
    "md5_key",
    "SELECT event_id, md5(user_id || CAST(ts AS VARCHAR)) AS event_key FROM events",
)
def md5_key_query(spark, sf):
    return table(spark, sf, "events").select("event_id", md5_key("user_id", "ts").alias("event_key"))


@query(
    "sas_date_roundtrip",
    """SELECT o_orderkey, date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE))::INTEGER
      AS day_number, CAST(o_orderdate AS DATE) AS "date",
      strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders""",
)
def sas_date_roundtrip(spark, sf):
    days = calendar.sas_day_number(F.to_date("o_orderdate"))
    orders = table(spark, sf, "orders").select("o_orderkey", days.alias("day_number"))
    date = calendar.sas_date(F.col("day_number").cast("double").cast("string"))
    return orders.select(
        "*", date.alias("date"), calendar.iso_text(date).alias("iso")
    )


@query(
    "stay_days",
    """SELECT l_orderkey, l_linenumber, l_partkey, date_diff('day', CAST(o_orderdate AS DATE),
      CAST(CASE WHEN l_returnflag <> 'A' THEN l_shipdate END AS DATE))::INTEGER AS stay
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def stay_days(spark, sf):
    shipped = F.when(F.col("l_returnflag") != "A", F.col("l_shipdate"))
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        calendar.stay_days(F.to_date("o_orderdate"), F.to_date(shipped)).alias("stay"),
    )


@query(
    "date_text",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed FROM orders""",
)
def date_text(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.to_date(calendar.iso_text("o_orderdate"), "yyyy-MM-dd").alias("parsed")
    )


@query(
    "epoch_millis_ts",
    "SELECT event_id, date_trunc('millisecond', ts) AS start_time FROM events",
)
def epoch_millis_ts(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", calendar.epoch_millis_ts(calendar.epoch_millis("ts")).alias("start_time")
    )


@query(
    "epoch_seconds_ts",
    "SELECT event_id, date_trunc('second', ts) AS start_time FROM events",
)
def epoch_seconds_ts(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", calendar.epoch_seconds_ts(calendar.epoch_millis("ts")).alias("start_time")
    )


@query(
    "code_labels",
    """SELECT l_linenumber, CASE l_linenumber WHEN 1 THEN 'air' WHEN 2 THEN 'sea'
      WHEN 3 THEN 'land' END AS "mode", CASE l_linenumber WHEN 1 THEN 'business'
      WHEN 2 THEN 'pleasure' WHEN 3 THEN 'student' ELSE 'unknown' END AS visa, count(*) AS n_lines
    FROM lineitem GROUP BY l_linenumber""",
)
def code_labels(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n_lines"))
    return counts.select(
        "l_linenumber",
        values.code_label("l_linenumber", MODE_LABELS).alias("mode"),
        values.code_label("l_linenumber", VISA_LABELS, "unknown").alias("visa"),
        "n_lines",
    )
