"""Queries over profiling and data quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.lookups import STATE_CODES
from starloom.operators import profile, quality, sketches
from starloom.operators.joins import orphans
from starloom.operators.matching import name_candidates
from starloom.plans.immigration import build_immigration
from starloom.schemas import CONTRACTS
from starloom.session import scratch_path
from starloom.sinks.parquet import write_parquet
from starloom.sources.files import read_state_lookup
from starloom.workload import frames
from starloom.workload.registry import query, table


def _sparse_orders(spark, sf):
    """Orders with gaps: priority missing for two in three, price NaN for cheap orders."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "F", F.col("o_orderpriority")).alias("priority"),
        F.when(price < 100000, F.lit(float("nan"))).when(status != "P", price).alias("price"),
        F.when(key % 10 == 0, F.col("o_orderdate")).alias("placed"),
        F.when(key % 20 == 0, F.col("o_custkey")).alias("customer"),
    )


_SPARSE_SQL = """sparse AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority,
    CASE WHEN o_totalprice < 100000 THEN NULL WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
    CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate END AS placed,
    CASE WHEN o_orderkey % 20 = 0 THEN o_custkey END AS customer FROM orders)"""


@query(
    "missing_counts",
    f"""WITH {_SPARSE_SQL} SELECT count(*) - count(o_orderkey) AS o_orderkey,
      count(*) - count(priority) AS priority, count(*) - count(price) AS price,
      count(*) - count(placed) AS placed, count(*) - count(customer) AS customer FROM sparse""",
)
def missing_counts(spark, sf):
    return profile.missing_counts(_sparse_orders(spark, sf))


_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS n_rows, "
    f"CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS missing_percent "
    "FROM sparse"
    for c in ("o_orderkey", "priority", "price", "placed", "customer")
)


@query("missing_profile", f"WITH {_SPARSE_SQL} {_PROFILE_SQL}")
def missing_profile(spark, sf):
    return profile.missing_profile(_sparse_orders(spark, sf))


@query("drop_sparse_columns", f"WITH {_SPARSE_SQL} SELECT o_orderkey, priority, price FROM sparse")
def drop_sparse_columns(spark, sf):
    kept = profile.drop_sparse_columns(_sparse_orders(spark, sf), 85.0)
    return kept.withColumn("price", F.when(~F.isnan("price"), F.col("price")))


@query(
    "duplicate_count",
    """SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys,
      count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem""",
)
def duplicate_count(spark, sf):
    return profile.duplicate_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "missing_key_count",
    f"""WITH {_SPARSE_SQL} SELECT count(*) AS n_rows,
      count(*) FILTER (price IS NULL AND placed IS NULL) AS n_missing_key FROM sparse""",
)
def missing_key_count(spark, sf):
    return profile.missing_key_count(_sparse_orders(spark, sf), ["price", "placed"])


@query(
    "table_profile",
    """SELECT count(*) AS n_rows, count(*) - count(DISTINCT (user_id, event_type)) AS n_duplicates,
      count(*) FILTER (event_type IN ('view', 'click')) AS n_missing_key FROM events""",
)
def table_profile(spark, sf):
    kind = F.col("event_type")
    shown = F.when(~kind.isin("view", "click"), F.col("value"))
    events = table(spark, sf, "events").withColumn("shown", shown)
    return profile.table_profile(events, ["user_id", "event_type"], ["shown"])


@query(
    "dq_row_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'row_count' AS check_name, count(*) AS value, "
        f"count(*) >= 1 AS passed FROM ({source})"
        for t, source in (
            ("orders", "SELECT * FROM orders"),
            ("lineitem", "SELECT * FROM lineitem"),
            ("none", "SELECT * FROM events WHERE event_type = 'absent'"),
        )
    ),
)
def dq_row_counts(spark, sf):
    events = table(spark, sf, "events")
    return quality.row_counts(
        {
            "orders": quality.readable("orders", lambda: table(spark, sf, "orders")),
            "lineitem": quality.readable("lineitem", lambda: table(spark, sf, "lineitem")),
            "none": events.where(F.col("event_type") == "absent"),
        }
    )


@query(
    "dq_unique",
    """SELECT 'orders' AS table_name, 'unique(o_orderkey)' AS check_name,
      count(*) - count(DISTINCT o_orderkey) AS value, count(*) = count(DISTINCT o_orderkey) AS passed
    FROM orders UNION ALL
    SELECT 'lineitem', 'unique(l_orderkey,l_linenumber)',
      count(*) - count(DISTINCT (l_orderkey, l_linenumber)),
      count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
)
def dq_unique(spark, sf):
    return quality.union_reports(
        quality.unique(table(spark, sf, "orders"), "orders", ["o_orderkey"]),
        quality.unique(table(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
    )


@query(
    "dq_not_null",
    f"""WITH {_SPARSE_SQL} """
    + " UNION ALL ".join(
        f"SELECT 'orders' AS table_name, 'not_null({c})' AS check_name, count(*) - count({c}) AS value,"
        f" count(*) = count({c}) AS passed FROM sparse"
        for c in ("o_orderkey", "placed", "customer")
    ),
)
def dq_not_null(spark, sf):
    return quality.not_null(
        _sparse_orders(spark, sf), "orders", ["o_orderkey", "placed", "customer"]
    )


@query(
    "dq_max_length",
    """SELECT 'part' AS table_name, 'max_length(p_name)' AS check_name,
      count(*) FILTER (length(p_name) > 9) AS value, count(*) FILTER (length(p_name) > 9) = 0 AS passed
    FROM part UNION ALL SELECT 'part', 'max_length(p_brand)',
      count(*) FILTER (length(p_brand) > 30), count(*) FILTER (length(p_brand) > 30) = 0 FROM part""",
)
def dq_max_length(spark, sf):
    return quality.max_length(table(spark, sf, "part"), "part", {"p_name": 9, "p_brand": 30})


@query(
    "dq_referential",
    """SELECT 'orders' AS table_name, 'referential(o_custkey)' AS check_name, count(*) AS value,
      count(*) = 0 AS passed FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""",
)
def dq_referential(spark, sf):
    known = table(spark, sf, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return quality.referential(table(spark, sf, "orders"), "orders", "o_custkey", known, "c_custkey")


@query(
    "dq_state_codes",
    """SELECT upper(split_part(p_name, ' ', 2)[1:2]) AS code, count(*) AS n_rows
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE upper(split_part(p_name, ' ', 2)[1:2]) NOT IN ("""
    + ", ".join(f"'{code}'" for code, _ in STATE_CODES)
    + ") GROUP BY ALL",
)
def dq_state_codes(spark, sf):
    """Codes of the fact that the state code list, read back from its file, does not know."""
    path = scratch_path(spark, "states")
    listed = spark.createDataFrame(list(STATE_CODES), "Code string, State string")
    listed.write.csv(path, sep=";", header=True)
    noun = F.element_at(F.split("p_name", " "), 2)
    fact = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.upper(F.substring(noun, 1, 2)).alias("i94addr"))
    )
    return orphans(fact, "i94addr", read_state_lookup(spark, path), "Code")


@query(
    "dq_completeness",
    """SELECT 'orders' AS table_name, 'completeness' AS check_name,
      (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders) AS value,
      (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM orders) AS passed
    UNION ALL SELECT 'customer', 'completeness', count(*) - count(c_custkey),
      count(*) = count(c_custkey) FROM customer""",
)
def dq_completeness(spark, sf):
    customer = table(spark, sf, "customer")
    return quality.union_reports(
        quality.completeness(table(spark, sf, "lineitem"), table(spark, sf, "orders"), "orders"),
        quality.completeness(customer, customer.select("c_custkey"), "customer"),
    )


@query(
    "dq_contract",
    f"""WITH {frames.ARRIVALS_SQL} SELECT 'immigration' AS table_name, 'row_count' AS check_name,
      count(*) AS value, count(*) >= 1 AS passed FROM fact
    UNION ALL SELECT 'immigration', 'unique(cicid)', count(*) - count(DISTINCT cicid),
      count(*) = count(DISTINCT cicid) FROM fact
    UNION ALL SELECT 'immigration', 'not_null(cicid)', count(*) - count(cicid),
      count(*) = count(cicid) FROM fact""",
)
def dq_contract(spark, sf):
    fact = build_immigration(frames.arrivals_raw(spark, sf))
    return quality.contract_checks(fact, CONTRACTS["immigration"])


# --- profiles that add up --------------------------------------------------------------------------

_SKETCHED = ("cicid", "i94res", "i94addr", "airline", "depdate", "i94bir")


@query(
    "profile_by_sketches",
    f"WITH {frames.ARRIVALS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_missing, true AS distinct_close, "
        + ("true" if c in ("cicid", "i94res", "i94bir") else "NULL::BOOLEAN") + " AS median_close FROM fact"
        for c in _SKETCHED
    ),
)
def profile_by_sketches(spark, sf):
    """A profile merged from monthly sketches, of which one year's were written again: counts, and whether distinct counts and
    medians are as close to the exact ones as stated."""
    fact = build_immigration(frames.arrivals_raw(spark, sf)).select(*_SKETCHED, "i94yr", "i94mon")
    path, months = scratch_path(spark, "sketches"), ["i94yr", "i94mon"]
    wrong = fact.withColumn("i94res", F.when(F.col("i94yr") == 1996, F.col("cicid")).otherwise(F.col("i94res")))
    write_parquet(sketches.column_sketches(wrong, months), path, months)
    write_parquet(sketches.column_sketches(fact.where("i94yr = 1996"), months), path, months, replace="partitions")
    merged = sketches.merged_profile(spark.read.parquet(path))
    exact = fact.agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED]).unpivot([], list(_SKETCHED), "column_name", "exact")
    numbers = fact.select(*[F.col(c).cast("double").alias(c) for c in ("cicid", "i94res", "i94bir")])
    ranked = numbers.unpivot([], numbers.columns, "column_name", "v").where("v is not null").join(merged.select("column_name", "`q0.5`"), "column_name")
    median = ranked.groupBy("column_name").agg(
        (F.avg((F.col("v") < F.col("`q0.5`")).cast("double")) - sketches.RANK_ERROR).alias("low"),
        (F.avg((F.col("v") <= F.col("`q0.5`")).cast("double")) + sketches.RANK_ERROR).alias("high"),
    )
    return merged.join(exact, "column_name").join(median, "column_name", "left").select(
        "column_name", "n_rows", "n_missing",
        (F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * sketches.DISTINCT_ERROR).alias("distinct_close"),
        F.when(F.col("low").isNotNull(), (F.col("low") <= 0.5) & (F.col("high") >= 0.5)).alias("median_close"),
    )


_GRAMS = "list_distinct([s[i:i + 2] for i in range(1, greatest(len(s) - 2, 1) + 1)])"


@query(
    "country_name_candidates",
    f"""WITH code AS (
      SELECT CASE n_nationkey WHEN 3 THEN 'INVALID: ' || upper(n_name) WHEN 4 THEN upper(n_name) || ' (ALL)' ELSE upper(n_name) END AS name FROM nation
    ), reading AS (
      SELECT DISTINCT CASE WHEN c_nationkey = 4 THEN 'Fourth Nation' WHEN c_nationkey = 5 AND c_custkey % 2 = 0 THEN 'Fifth Nation'
        ELSE 'Nation_' || CASE WHEN c_nationkey < 23 THEN c_nationkey ELSE 99 END END AS name FROM customer
    ), open_code AS (
      SELECT DISTINCT name FROM code WHERE lower(name) NOT IN (SELECT lower(name) FROM reading)
    ), a AS (
      SELECT name, plain, ' ' || plain || ' ' AS s FROM (SELECT name, trim(regexp_replace(lower(name), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS plain FROM open_code)
    ), b AS (
      SELECT name, plain, ' ' || plain || ' ' AS s FROM (SELECT name, trim(regexp_replace(lower(name), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS plain FROM reading)
    ), ga AS (SELECT *, {_GRAMS} AS g FROM a), gb AS (SELECT *, {_GRAMS} AS g FROM b), pair AS (
      SELECT ga.name, gb.name AS candidate, CAST(len(list_intersect(ga.g, gb.g)) AS DOUBLE) / least(len(ga.g), len(gb.g)) AS overlap,
        1 - CAST(levenshtein(ga.plain, gb.plain) AS DOUBLE) / greatest(len(ga.plain), len(gb.plain)) AS edit
      FROM ga, gb
    )
    SELECT name, candidate, overlap, edit,
      CAST(row_number() OVER (PARTITION BY name ORDER BY overlap DESC, edit DESC, candidate) AS INTEGER) AS rank
    FROM pair WHERE overlap >= 0.6 QUALIFY rank <= 3""",
)
def country_name_candidates(spark, sf):
    """For each uncorrected name of the code list that has no readings, the names of readings it may stand for."""
    codes = frames.country_codes(spark, sf).select(F.col("Country").alias("name"))
    readings = frames.temperature_readings(spark, sf).select(F.col("Country").alias("reading")).distinct()
    without = codes.join(readings, F.lower("name") == F.lower("reading"), "left_anti")
    return name_candidates(without, "name", readings, "reading")
