"""The registered queries: each operator over the supplied tables, with its oracle in SQL.

All queries run over whole tables. Values that have to agree between engines are integers, texts and
dates, or averages of integers, so that no result depends on the order of a floating-point sum.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.contracts import Contract, declare_table
from lakestar.functions.dates import calendar_bounds, date_precision, parse_partial_date
from lakestar.functions.hashing import row_hash, surrogate_key, version_key
from lakestar.operators import (
    asof, bridge, dedup, dimensions, facts, history, projection, quality, rankings, reconcile, scd, sketches,
)
from lakestar.plans.extract import run_extract
from lakestar.plans.fixture_data import LINK, cents, moment, pages, table
from lakestar.plans.gold import analysis, run_export, run_gold
from lakestar.plans.layout import Layout
from lakestar.plans.silver import merge_landing, run_silver
from lakestar.session import DROP_SHUFFLES, SORTED_SCAN_BYTES, scratch_dir, settings, small_scans
from lakestar.sources import landing, tables, timelines, writers
from lakestar.sources import pages as nested
from lakestar.sources.appends import appends_read, insert_filtered
from lakestar.sources.copartitioned import Buckets, copartitioned_insert, copartitioned_merge, copartitioned_read
from lakestar.sources.files import delete_folder
from lakestar.sources.ledger import ledger_read
from lakestar.sources.profiles import refresh_profiles, table_profile_estimate
from lakestar.sources.split_csv import read_csv_split as split_reader
from lakestar.streaming.pickup import stream_landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

T1 = "2026-01-01 00:00:00"
T2 = "2026-01-02 00:00:00"
DAY1, DAY2, DAY3 = datetime(2026, 1, 1), datetime(2026, 1, 2), datetime(2026, 1, 3)


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query with its oracle, under its function's name without the leading underscore."""
    def register(function: Query) -> Query:
        name = function.__name__.lstrip("_")
        QUERIES[name] = function
        ORACLES[name] = sql
        return function
    return register


# --- rankings ---------------------------------------------------------------------------------


@query("""
SELECT p.p_partkey, p.p_name, a.avg_quantity
FROM (SELECT l_partkey, avg(CAST(l_quantity AS INTEGER)) AS avg_quantity FROM lineitem GROUP BY 1) a
JOIN part p ON p.p_partkey = a.l_partkey
ORDER BY a.avg_quantity DESC, p.p_partkey LIMIT 10
""")
def top_entities_by_avg(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("int").alias("quantity"))
    return rankings.top_entities_by_avg(
        lines, table(spark, sf, "part"), "p_partkey", "quantity", "p_name", "avg_quantity")


@query("""
WITH g AS (SELECT o_custkey, coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)), 0) AS total_cents
           FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
SELECT c.c_custkey, c.c_name, CAST(g.total_cents AS BIGINT) AS total_cents
FROM g JOIN customer c ON c.c_custkey = g.o_custkey
""")
def top_groups_prelimit(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), cents("o_totalprice").alias("cents"))
    return rankings.top_groups_prelimit(
        orders, table(spark, sf, "customer"), "c_custkey", "cents", "c_name", "total_cents")


@query("SELECT l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def top_groups_by_count(spark: SparkSession, sf: str) -> DataFrame:
    return rankings.top_groups_by_count(table(spark, sf, "lineitem"), "l_suppkey", "n_rows")


@query(r"""
SELECT substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS year_added,
       avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS avg_cents
FROM orders WHERE regexp_matches(CAST(o_orderdate AS VARCHAR), '^\d{4}-') GROUP BY 1
""")
def avg_by_year(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("string").alias("added"), cents("o_totalprice").alias("cents"))
    return rankings.avg_by_year(orders, "added", "cents", "year_added", "avg_cents")


# --- one row per key --------------------------------------------------------------------------


@query("""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1
""")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_latest(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"],
        tiebreak=[F.asc("l_partkey"), F.asc("l_suppkey")])


@query("""
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""")
def dedup_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return dedup.dedup_first_seen(events, ["user_id"], ["ts", "event_id"])


@query("""
SELECT user_id, batch, event_id, event_type FROM (SELECT *, CAST(ts AS DATE) AS batch FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY batch DESC, ts, event_id) = 1
""")
def dedup_last_batch(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("batch", F.col("ts").cast("date"))
    last = dedup.dedup_last_batch(
        events.select("user_id", "batch", "ts", "event_id", "event_type"),
        ["user_id"], ["batch"], ["ts", "event_id"])
    return last.select("user_id", "batch", "event_id", "event_type")


@query("""
WITH c AS (SELECT user_id, 0 AS source, event_id FROM events WHERE event_type = 'purchase'
           UNION ALL SELECT user_id, 1, event_id FROM events WHERE event_type <> 'purchase'),
     f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY source, event_id) = 1)
SELECT user_id, source, event_id FROM f ORDER BY source, event_id, user_id LIMIT 50
""")
def first_n_unique(spark: SparkSession, sf: str) -> DataFrame:
    source = F.when(F.col("event_type") == "purchase", 0).otherwise(1)
    events = table(spark, sf, "events").filter(F.col("event_type").isNotNull())
    return dedup.first_n_unique(
        events.select("user_id", source.alias("source"), "event_id"),
        ["user_id"], ["source", "event_id"], 50)


# --- projections ------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_custkey, NULL FROM orders
""")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return projection.union_by_name(
        orders.select("o_orderkey", "o_custkey", "o_orderpriority"),
        orders.select("o_custkey", "o_orderkey"))


CUSTOMER = Contract(
    "customer",
    "customer_id bigint, customer_name string, balance decimal(18,2), nation int, joined date",
    keys=("customer_id",),
    required=("customer_id", "customer_name"),
    renames={"c_custkey": "customer_id", "c_name": "customer_name", "c_acctbal": "balance",
             "c_nationkey": "nation"},
)


def _text_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as landed text; the balances of one segment are not numbers."""
    balance = F.format_string("%.2f", F.col("c_acctbal"))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(balance).alias("c_acctbal"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_mktsegment")


@query("""
SELECT c_custkey AS customer_id, c_name AS customer_name,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS balance_cents,
       c_nationkey AS nation, CAST(NULL AS DATE) AS joined
FROM customer
""")
def enforce_contract(spark: SparkSession, sf: str) -> DataFrame:
    typed = projection.enforce_contract(_text_customers(spark, sf), CUSTOMER)
    balance = (F.col("balance") * 100).cast("bigint").alias("balance_cents")
    return typed.select("customer_id", "customer_name", balance, "nation", "joined")


@query("""
WITH t AS (SELECT count(*) AS row_count, count(*) FILTER (c_mktsegment = 'BUILDING') AS bad FROM customer)
SELECT column_name, expected_type, actual_type, status, required,
       CAST(CASE WHEN column_name = 'balance' THEN bad ELSE 0 END AS BIGINT) AS misfits, row_count
FROM t, (VALUES ('customer_id', 'bigint', 'string', 'cast', TRUE), ('customer_name', 'string', 'string', 'ok', TRUE),
  ('balance', 'decimal(18,2)', 'string', 'cast', FALSE), ('nation', 'int', 'string', 'cast', FALSE),
  ('joined', 'date', NULL, 'missing', FALSE), ('c_mktsegment', NULL, 'string', 'extra', FALSE)
) v(column_name, expected_type, actual_type, status, required)
""")
def contract_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.contract_report(_text_customers(spark, sf), CUSTOMER)


@query("""
SELECT c_custkey AS customer_id, c_name AS customer_name, c_name AS display_name,
       c_acctbal AS balance, c_nationkey AS nation, c_mktsegment
FROM customer
""")
def canonicalize(spark: SparkSession, sf: str) -> DataFrame:
    return projection.canonicalize(
        table(spark, sf, "customer"), {**CUSTOMER.renames, "absent": "ignored"},
        {"display_name": "customer_name"})


@query(f"""
SELECT s_suppkey, 'src' AS source_system, TIMESTAMP '{T1}' AS last_updated, 1 AS play_count FROM supplier
""")
def stamp_audit(spark: SparkSession, sf: str) -> DataFrame:
    return projection.stamp_audit(
        table(spark, sf, "supplier").select("s_suppkey"), moment(T1), "src", play_count=1)


@query(f"SELECT event_id, ts, TIMESTAMP '{T1}' AS extraction_date FROM events")
def with_default_column(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts")
    kept = projection.with_default_column(events, "ts", moment(T2))
    return projection.with_default_column(kept, "extraction_date", moment(T1))


@query("""
SELECT o_orderkey,
  CASE left(o_orderpriority, 1) WHEN '1' THEN date_trunc('year', o_orderdate)
    WHEN '2' THEN date_trunc('month', o_orderdate) WHEN '3' THEN o_orderdate END AS released,
  CASE left(o_orderpriority, 1) WHEN '1' THEN 'year' WHEN '2' THEN 'month' WHEN '3' THEN 'day' END AS precision
FROM orders
""")
def _parse_partial_date(spark: SparkSession, sf: str) -> DataFrame:
    kind, day = F.substring("o_orderpriority", 1, 1), F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(kind == "1", F.substring(day, 1, 4)).when(kind == "2", F.substring(day, 1, 7))
        .when(kind == "3", day).when(kind == "4", "0000").otherwise("")
    )
    texts = table(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return texts.select(
        "o_orderkey", parse_partial_date("text", "timestamp_ntz").alias("released"),
        date_precision("text").alias("precision"))


# --- hashes and keys --------------------------------------------------------------------------

SEGMENT = "nullif(c_mktsegment, 'BUILDING')"


@query(f"""
SELECT c_custkey, sha256(
  length(CAST(c_custkey AS VARCHAR)) || ':' || CAST(c_custkey AS VARCHAR) || length(c_name) || ':' || c_name ||
  CASE WHEN {SEGMENT} IS NULL THEN '~' ELSE length({SEGMENT}) || ':' || {SEGMENT} END) AS hash_key
FROM customer
""")
def _row_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", row_hash("c_custkey", "c_name", F.expr(SEGMENT)).alias("hash_key"))


@query("""
SELECT l_orderkey, l_linenumber, sha256(CAST(l_partkey AS VARCHAR) || 'src') AS part_key,
  sha256(l_orderkey || chr(31) || l_linenumber || chr(31) || 'src') AS line_key,
  sha256(sha256(CAST(l_partkey AS VARCHAR) || 'src') || chr(31) || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f')) AS part_version_key
FROM lineitem
""")
def _surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    part_key = surrogate_key("l_partkey", source="src")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", part_key.alias("part_key"),
        surrogate_key("l_orderkey", "l_linenumber", source="src").alias("line_key"),
        version_key(part_key, "l_shipdate").alias("part_version_key"))


# --- slowly changing dimensions ---------------------------------------------------------------


def _hashed(df: DataFrame, *tracked: str) -> DataFrame:
    return scd.with_hash(df, tracked)


def _parts(spark: SparkSession, sf: str, changed: bool) -> DataFrame:
    """All parts; in the changed state one brand has new prices."""
    price = cents("p_retailprice") + (F.when(F.col("p_brand") == "Brand#7", 1).otherwise(0) if changed else 0)
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_type", price.alias("price"))


def _known_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of an earlier load, before the promotional ones were introduced."""
    return _parts(spark, sf, False).filter("p_type <> 'PROMO'")


NEW_PARTS = """SELECT p_partkey, p_name, p_type,
  CAST(round(p_retailprice * 100) AS BIGINT) + CASE WHEN p_brand = 'Brand#7' THEN 1 ELSE 0 END AS price FROM part"""


@query(f"{NEW_PARTS} WHERE p_type = 'PROMO'")
def insert_new_only(spark: SparkSession, sf: str) -> DataFrame:
    return scd.insert_new_only(_known_parts(spark, sf), _parts(spark, sf, True), ["p_partkey"])


@query(f"{NEW_PARTS} WHERE p_type = 'PROMO' OR p_brand = 'Brand#7'")
def changed_or_new(spark: SparkSession, sf: str) -> DataFrame:
    current = _hashed(_known_parts(spark, sf), "p_name", "price")
    staged = _hashed(_parts(spark, sf, True), "p_name", "price")
    return scd.changed_or_new(current, staged, ["p_partkey"]).drop("hash_key")


@query(f"""
SELECT c_custkey, c_name, TRUE AS is_current, TIMESTAMP '{T1}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
FROM customer
""")
def scd2_initial(spark: SparkSession, sf: str) -> DataFrame:
    return scd.scd2_initial(table(spark, sf, "customer").select("c_custkey", "c_name"), moment(T1))


def _balances(spark: SparkSession, sf: str, present: str, changed: bool) -> DataFrame:
    balance = cents("c_acctbal") + (F.when(F.col("c_nationkey") < 5, 1).otherwise(0) if changed else 0)
    rows = table(spark, sf, "customer").filter(present).select("c_custkey", "c_name", balance.alias("balance"))
    return _hashed(rows, "c_name", "balance")


def _stage_balances(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two extracts: one segment is new in the second, another is gone, five nations have changed."""
    return (_balances(spark, sf, "c_mktsegment <> 'BUILDING'", False),
            _balances(spark, sf, "c_mktsegment <> 'MACHINERY'", True))


SCD2_BALANCES = f"""
WITH s1 AS (SELECT c_custkey, c_name, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer
            WHERE c_mktsegment <> 'BUILDING'),
     s2 AS (SELECT c_custkey, c_name, CAST(round(c_acctbal * 100) AS BIGINT) + CASE WHEN c_nationkey < 5 THEN 1 ELSE 0 END
            AS balance FROM customer WHERE c_mktsegment <> 'MACHINERY'),
     j AS (SELECT s1.*, s2.c_custkey IS NOT NULL AND s2.balance IS DISTINCT FROM s1.balance AS changed
           FROM s1 LEFT JOIN s2 USING (c_custkey)),
     result AS (
       SELECT c_custkey, c_name, balance, NOT changed AS is_current, TIMESTAMP '{T1}' AS valid_from,
              CASE WHEN changed THEN TIMESTAMP '{T2}' END AS valid_to FROM j
       UNION ALL
       SELECT s2.c_custkey, s2.c_name, s2.balance, TRUE, TIMESTAMP '{T2}', NULL
       FROM s2 LEFT JOIN s1 USING (c_custkey) WHERE s1.c_custkey IS NULL OR s1.balance IS DISTINCT FROM s2.balance)
"""


@query(f"{SCD2_BALANCES} SELECT * FROM result")
def scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _stage_balances(spark, sf)
    target = scd.scd2_initial(first, moment(T1))
    return scd.scd2_apply(target, second, ["c_custkey"], moment(T2)).drop("hash_key")


@query(f"{SCD2_BALANCES} SELECT * FROM result WHERE is_current")
def current_rows(spark: SparkSession, sf: str) -> DataFrame:
    return projection.current_rows(scd2_apply(spark, sf))


@query(f"{SCD2_BALANCES} SELECT * FROM result")
def load_dimension_scd2(spark: SparkSession, sf: str) -> DataFrame:
    """The same two stages merged into a stored table, the second of them twice."""
    path = scratch_dir(spark, "scd2")
    first, second = _stage_balances(spark, sf)
    tables.scd2_merge(first, path, ["c_custkey"], DAY1)
    tables.scd2_merge(second, path, ["c_custkey"], DAY2)
    tables.scd2_merge(second, path, ["c_custkey"], DAY3)
    stored = tables.table_read(spark, path)
    return stored.select(
        "c_custkey", "c_name", "balance", "is_current",
        F.col("valid_from").cast("timestamp_ntz").alias("valid_from"),
        F.col("valid_to").cast("timestamp_ntz").alias("valid_to"))


@query("""
WITH d AS (SELECT o_custkey, o_orderpriority, o_orderdate FROM orders QUALIFY row_number() OVER
             (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1),
     c AS (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS prev FROM d),
     k AS (SELECT * FROM c WHERE prev IS DISTINCT FROM o_orderpriority)
SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
       lead(o_orderdate) OVER w AS valid_to, lead(o_orderdate) OVER w IS NULL AS is_current
FROM k WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)
""")
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    versions = history.scd2_history(
        orders, ["o_custkey"], ["o_orderpriority"], "o_orderdate", ["o_orderkey"])
    return versions.select("o_custkey", "o_orderpriority", "valid_from", "valid_to", "is_current")


@query(ORACLES["scd2_history"])
def scd2_history_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The same history with most keys over the limit that cuts them into chunks of time."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    versions = history.scd2_history(
        orders, ["o_custkey"], ["o_orderpriority"], "o_orderdate", ["o_orderkey"], hot_rows=4)
    return versions.select("o_custkey", "o_orderpriority", "valid_from", "valid_to", "is_current")


@query(ORACLES["scd2_history"])
def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same history merged from four batches, each of which reaches into the past of the others."""
    path = scratch_dir(spark, "timeline")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    for part in (2, 0, 3, 1):
        batch = orders.filter(F.col("o_orderkey") % 4 == part)
        timelines.merge_changes(batch, path, ["o_custkey"], ["o_orderpriority"], "o_orderdate", ["o_orderkey"])
    stored = timelines.timeline_read(spark, path)
    return stored.select("o_custkey", "o_orderpriority", "valid_from", "valid_to", "is_current")


@query(f"""
WITH s AS (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS balance, c_nationkey AS v, c_mktsegment AS segment
           FROM customer)
SELECT c_custkey, balance, v, CAST(NULL AS VARCHAR) AS segment, v >= 10 AS is_current, TIMESTAMP '{T1}' AS valid_from,
       CASE WHEN v < 10 THEN TIMESTAMP '{T2}' END AS valid_to FROM s
UNION ALL SELECT c_custkey, balance, v, segment, v >= 5, TIMESTAMP '{T2}', CASE WHEN v < 5 THEN TIMESTAMP '2026-01-03 00:00:00' END
FROM s WHERE v < 10
UNION ALL SELECT c_custkey, balance + 1, v, segment, TRUE, TIMESTAMP '2026-01-03 00:00:00', NULL FROM s WHERE v < 5
""")
def scd2_schema_growth(spark: SparkSession, sf: str) -> DataFrame:
    """A stored type 2 table whose second stage brings a new column, with values for ten nations only.

    One column has the name that the table's own folders carry.
    """
    path = scratch_dir(spark, "growth")
    customers = table(spark, sf, "customer").select(
        "c_custkey", cents("c_acctbal").alias("balance"), F.col("c_nationkey").alias("v"),
        F.when(F.col("c_nationkey") < 10, F.col("c_mktsegment")).alias("segment"))
    changed = customers.withColumn("balance", F.col("balance") + F.when(F.col("v") < 5, 1).otherwise(0))
    for rows, as_of in ((customers.drop("segment"), DAY1), (customers, DAY2), (changed, DAY3)):
        tracked = [c for c in rows.columns if c != "c_custkey"]
        tables.scd2_merge(scd.with_hash(rows, tracked), path, ["c_custkey"], as_of, tracked=tracked)
    stored = tables.table_read(spark, path)
    return stored.select(
        "c_custkey", "balance", "v", "segment", "is_current",
        F.col("valid_from").cast("timestamp_ntz").alias("valid_from"),
        F.col("valid_to").cast("timestamp_ntz").alias("valid_to"))


# --- point in time ----------------------------------------------------------------------------

# The priorities of a customer's odd orders as versions, of which none is valid for more than 400 days.
PRIORITY_VERSIONS = """
h AS (SELECT o_custkey, o_orderpriority AS priority, o_orderdate AS valid_from,
        lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS next_from
      FROM (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS prev FROM (
        SELECT * FROM orders WHERE o_orderkey % 2 = 1 QUALIFY row_number() OVER
          (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)) WHERE prev IS DISTINCT FROM o_orderpriority),
v AS (SELECT *, least(coalesce(next_from, valid_from + INTERVAL 400 DAY), valid_from + INTERVAL 400 DAY) AS valid_to FROM h)
"""


def _priority_versions(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(F.col("o_orderkey") % 2 == 1)
    orders = orders.select("o_custkey", F.col("o_orderpriority").alias("priority"), "o_orderdate", "o_orderkey")
    versions = history.scd2_history(orders, ["o_custkey"], ["priority"], "o_orderdate", ["o_orderkey"])
    latest = F.col("valid_from") + F.expr("interval 400 days")
    return versions.withColumn("valid_to", F.least(F.coalesce("valid_to", latest), latest))


@query(f"""
WITH {PRIORITY_VERSIONS}
SELECT o_orderkey, o.o_custkey, CASE WHEN o_orderdate < valid_to THEN priority END AS priority,
       CASE WHEN o_orderdate < valid_to THEN valid_from END AS version_from
FROM orders o ASOF LEFT JOIN v ON o.o_custkey = v.o_custkey AND o.o_orderdate >= v.valid_from
""")
def asof_join(spark: SparkSession, sf: str, hot_rows: int = 2_000_000) -> DataFrame:
    """Every order with the priority that was valid for its customer on its day."""
    versions = _priority_versions(spark, sf).withColumn("version_from", F.col("valid_from"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    found = asof.asof_join(
        orders, versions, ["o_custkey"], "o_orderdate", ["priority", "version_from"], hot_rows=hot_rows)
    return found.drop("o_orderdate")


@query(ORACLES["asof_join"])
def asof_join_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The same with most customers over the limit that cuts them into chunks of time."""
    return asof_join(spark, sf, hot_rows=8)


@query(f"""
WITH {PRIORITY_VERSIONS}
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS quantity,
       CASE WHEN l_shipdate < valid_to THEN sha256(v.o_custkey || 'src') END AS customer_key,
       CASE WHEN l_shipdate < valid_to THEN sha256(sha256(v.o_custkey || 'src') || chr(31) ||
         strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) END AS customer_key_version, 1 AS play_count
FROM (SELECT l.*, o_custkey FROM lineitem l JOIN orders USING (l_orderkey))
     l ASOF LEFT JOIN v ON l.o_custkey = v.o_custkey AND l.l_shipdate >= v.valid_from
""".replace("JOIN orders USING (l_orderkey)", "JOIN orders ON o_orderkey = l_orderkey"))
def asof_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with the version of their customer that was valid on the day they were shipped."""
    versions = _priority_versions(spark, sf).withColumn("customer_key", surrogate_key("o_custkey", source="src"))
    lines = table(spark, sf, "lineitem").withColumn("quantity", F.col("l_quantity").cast("int"))
    lines = lines.join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return facts.asof_fact(
        lines, [facts.Lookup(versions, "o_custkey", "customer_key")], "l_shipdate", ["quantity"], {"play_count": 1},
        keep=["l_orderkey", "l_linenumber", "l_partkey"])


# --- star schema ------------------------------------------------------------------------------


@query("""
SELECT CAST(d AS DATE) AS calendar_date FROM (SELECT unnest(range(min(o_orderdate),
  max(o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)
""")
def date_spine(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.date_spine(table(spark, sf, "orders"), "o_orderdate", "o_orderdate")


@query("""
SELECT CAST(d AS DATE) AS calendar_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(week(d) AS INTEGER) AS week_of_year,
       CAST(quarter(d) AS INTEGER) AS quarter
FROM (SELECT unnest(range(min(l_shipdate), max(l_shipdate) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM lineitem)
""")
def date_dimension(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return dimensions.date_dimension(dimensions.date_spine(lines, "l_shipdate", "l_shipdate"))


@query("""
SELECT l.l_orderkey, l.l_linenumber, p.part_key, s.supplier_key,
       CAST(l.l_quantity AS INTEGER) AS quantity, 20260101 AS date_key, 1 AS play_count
FROM lineitem l
LEFT JOIN (SELECT p_partkey, sha256(p_partkey || 'src') AS part_key FROM part WHERE p_type <> 'PROMO') p
  ON p.p_partkey = l.l_partkey
LEFT JOIN (SELECT s_suppkey, sha256(s_suppkey || 'src') AS supplier_key FROM supplier) s ON s.s_suppkey = l.l_suppkey
""")
def snapshot_fact(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").filter("p_type <> 'PROMO'")
    suppliers = table(spark, sf, "supplier")
    lines = table(spark, sf, "lineitem").withColumn("quantity", F.col("l_quantity").cast("int"))
    return facts.snapshot_fact(
        lines,
        [facts.Lookup(parts.withColumn("part_key", surrogate_key("p_partkey", source="src")),
                      "p_partkey", "part_key", foreign="l_partkey"),
         facts.Lookup(suppliers.withColumn("supplier_key", surrogate_key("s_suppkey", source="src")),
                      "s_suppkey", "supplier_key", foreign="l_suppkey")],
        ["quantity"], {"date_key": 20260101, "play_count": 1}, keep=["l_orderkey", "l_linenumber"])


@query(ORACLES["snapshot_fact"])
def snapshot_fact_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The same fact by shuffled look-ups with hot keys spread over salts."""
    parts = table(spark, sf, "part").filter("p_type <> 'PROMO'")
    lines = table(spark, sf, "lineitem").withColumn("quantity", F.col("l_quantity").cast("int"))
    return facts.snapshot_fact(
        lines,
        [facts.Lookup(parts.withColumn("part_key", surrogate_key("p_partkey", source="src")),
                      "p_partkey", "part_key", foreign="l_partkey"),
         facts.Lookup(table(spark, sf, "supplier").withColumn("supplier_key", surrogate_key("s_suppkey", source="src")),
                      "s_suppkey", "supplier_key", foreign="l_suppkey")],
        ["quantity"], {"date_key": 20260101, "play_count": 1}, keep=["l_orderkey", "l_linenumber"],
        broadcast_rows=0, hot_rows=100)


@query("""
SELECT event_id, user_id, CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) THEN 2 ELSE 1 END
  AS play_count, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key FROM events
""")
def replace_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Write all days, then replace the last one twice; the other days stay."""
    path = scratch_dir(spark, "fact")
    day = F.date_format("ts", "yyyyMMdd").cast("int")
    events = table(spark, sf, "events").select("event_id", "user_id", day.alias("date_key"))
    tables.replace_partition(events.withColumn("play_count", F.lit(1)), path, "date_key")
    last = events.agg(F.max("date_key").alias("date_key"))
    rerun = events.join(F.broadcast(last), "date_key").withColumn("play_count", F.lit(2))
    tables.replace_partition(rerun, path, "date_key")
    tables.replace_partition(rerun, path, "date_key")
    return tables.table_read(spark, path).select("event_id", "user_id", "play_count", "date_key")


@query("""
SELECT sha256(p_partkey || 'src') AS part_key, p_partkey, p_name AS part_name, p_size, TRUE AS is_current,
       CASE WHEN p_type <> 'PROMO' THEN DATE '2026-01-01' ELSE DATE '2026-01-02' END AS valid_day, 'src' AS source_system
FROM part
""")
def load_dimension_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads: the second brings the missing parts and changes to old ones, which are ignored."""
    path = scratch_dir(spark, "insert-only")
    columns = ["part_key", "p_partkey", "part_name", "p_size", "is_current", "valid_from",
               "valid_to", "source_system", "last_updated"]
    parts = table(spark, sf, "part")
    resized = F.when(F.col("p_type") == "PROMO", F.col("p_size")).otherwise(-1)
    loads = ((parts.filter("p_type <> 'PROMO'"), DAY1), (parts.withColumn("p_size", resized), DAY2))
    for rows, as_of in loads:
        staged = dimensions.dimension_insert_only(
            rows, "p_partkey", "part_key", "src", as_of, columns, {"part_name": "p_name"})
        tables.table_insert_new(staged, path, ["p_partkey"])
    stored = tables.table_read(spark, path)
    return stored.select(
        "part_key", "p_partkey", "part_name", "p_size", "is_current",
        F.col("valid_from").cast("date").alias("valid_day"), "source_system")


# --- quality ----------------------------------------------------------------------------------


@query("""
WITH n AS (SELECT nullif(p_brand, 'Brand#1') AS p_brand, nullif(p_size, 7) AS p_size, p_partkey FROM part),
     t AS (SELECT count(*) AS row_count, count(*) - count(p_partkey) AS a, count(*) - count(p_brand) AS b,
                  count(*) - count(p_size) AS c FROM n)
SELECT 'p_partkey' AS column_name, 'bigint' AS data_type, a AS null_count, row_count FROM t
UNION ALL SELECT 'p_brand', 'string', b, row_count FROM t UNION ALL SELECT 'p_size', 'int', c, row_count FROM t
""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(
        "p_partkey", F.nullif("p_brand", F.lit("Brand#1")).alias("p_brand"),
        F.nullif("p_size", F.lit(7)).alias("p_size"))
    return quality.null_profile(parts)


@query("""
SELECT 'customer' AS table_name, 'c_mktsegment' AS column_name, 'string' AS data_type,
       count(*) FILTER (c_mktsegment = 'BUILDING') AS null_count, count(*) AS row_count FROM customer
UNION ALL
SELECT 'orders', 'o_totalprice', 'double', count(*) FILTER (o_totalprice > 200000), count(*) FROM orders
""")
def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("o_totalprice") <= 200000, F.col("o_totalprice"))
    return quality.table_profile({
        "customer": table(spark, sf, "customer").select(F.expr(SEGMENT).alias("c_mktsegment")),
        "orders": table(spark, sf, "orders").select(price.alias("o_totalprice")),
    })


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text", "lang", "source")


DOCUMENT = Contract(
    "documents", "doc_id bigint, text string, lang string, source string", keys=("doc_id",))


@query("SELECT count(*) AS original_count, count(*) AS saved_count, TRUE AS counts_match FROM documents")
def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf)
    path, _ = writers.land_snapshot(documents, scratch_dir(spark, "counts"), "documents", DAY1)
    return quality.reconcile_counts(documents, landing.read_csv_contract(spark, path, DOCUMENT))


@query("""
SELECT c_custkey, 'changed' AS kind, 'balance' AS column_name, CAST(balance AS VARCHAR) AS original,
       CAST(balance + 1 AS VARCHAR) AS saved
FROM (SELECT c_custkey, c_nationkey, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer) WHERE c_nationkey = 3
UNION ALL SELECT c_custkey, 'changed', 'c_name', c_name, NULL FROM customer WHERE c_nationkey = 4
UNION ALL SELECT c_custkey, 'missing', NULL, NULL, NULL FROM customer WHERE c_nationkey = 7
UNION ALL SELECT c_custkey, 'added', NULL, NULL, NULL FROM customer WHERE c_nationkey = 9
""")
def reconcile_content(spark: SparkSession, sf: str) -> DataFrame:
    """Checksums taken while customers are written against a copy with changed, lost and repeated rows."""
    path = scratch_dir(spark, "content")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", cents("c_acctbal").alias("balance"), "c_nationkey")
    taken, observed = reconcile.observed_checksums(customers, ["c_custkey"])
    observed.write.parquet(path)
    copy = spark.read.parquet(path).filter("c_nationkey <> 7").withColumns({
        "balance": F.col("balance") + (F.col("c_nationkey") == 3).cast("int"),
        "c_name": F.when(F.col("c_nationkey") != 4, F.col("c_name"))})
    copy = copy.unionByName(copy.filter("c_nationkey = 9"))
    buckets = reconcile.differing_buckets(
        reconcile.checksums_of(spark, taken), reconcile.bucket_checksums(copy, ["c_custkey"]))
    return reconcile.differing_cells(customers, copy, ["c_custkey"], buckets)


@query("SELECT count(*) AS rows, count(DISTINCT lang) AS languages FROM documents")
def observe_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts taken while the table is written, compared through the stored copy."""
    path = scratch_dir(spark, "observe")
    counted, documents = quality.observe_counts(_documents(spark, sf))
    documents.write.parquet(path)
    stored = spark.read.parquet(path)
    return stored.agg(F.lit(counted.get["rows"]).alias("rows"), F.count_distinct("lang").alias("languages"))


@query("""
SELECT * FROM (SELECT event_id, added, CASE
    WHEN added IS NULL THEN 'null' WHEN added = '' THEN 'empty' WHEN regexp_matches(added, '^(http|www\\.)') THEN 'url'
    WHEN NOT regexp_matches(added, '^[0-9]{4}') THEN 'no_year'
    WHEN NOT regexp_matches(added, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'no_iso_date' END AS reason
  FROM (SELECT event_id, CASE WHEN event_type = 'error' AND value < 5 THEN NULL WHEN event_type = 'error' THEN ''
      WHEN event_type = 'view' THEN 'http://x/' || event_id WHEN event_type = 'click' AND value < 5 THEN event_type
      WHEN event_type = 'click' THEN strftime(ts, '%Y/%m') ELSE strftime(ts, '%Y-%m-%d') END AS added FROM events))
WHERE reason IS NOT NULL
""".replace("\\\\", "\\"))
def bad_values(spark: SparkSession, sf: str) -> DataFrame:
    kind, low = F.col("event_type"), F.col("value") < 5
    added = (
        F.when((kind == "error") & low, F.lit(None).cast("string")).when(kind == "error", "")
        .when(kind == "view", F.concat(F.lit("http://x/"), "event_id")).when((kind == "click") & low, kind)
        .when(kind == "click", F.date_format("ts", "yyyy/MM")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    events = table(spark, sf, "events").select("event_id", added.alias("added"))
    return quality.bad_values(events, "added", ["event_id"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN o_orderdate END AS o_orderdate FROM orders
""")
def sanitize_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return quality.sanitize_timestamps(orders, "1996-01-01")


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN o_orderdate ELSE TIMESTAMP '{T1}' END
  AS o_orderdate, CAST(NULL AS TIMESTAMP) AS valid_to FROM orders
""")
def fill_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    orders = sanitize_timestamps(spark, sf).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    return quality.fill_timestamps(orders, ["o_orderdate"], moment(T1))


@query("""
SELECT * FROM (SELECT CASE WHEN quality = 1 THEN quality END AS quality, CASE WHEN toxic = 1 THEN toxic END AS toxic
  FROM documents LEFT JOIN labels USING (doc_id)) WHERE quality IS NOT NULL OR toxic IS NOT NULL
""")
def drop_empty_rows(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels")
    rows = table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left").select(
        F.when(F.col("quality") == 1, F.col("quality")).alias("quality"),
        F.when(F.col("toxic") == 1, F.col("toxic")).alias("toxic"))
    return quality.drop_empty_rows(rows)


# --- sources and sinks ------------------------------------------------------------------------

PART = Contract(
    "part", "p_partkey bigint, p_name string, p_brand string, p_size int", keys=("p_partkey",))
PAGE = Contract("pages", "page_id bigint, url string, html string", keys=("page_id",))


def _three_formats(spark: SparkSession, sf: str) -> str:
    """Parts landed by size as CSV, JSON and Parquet, in three folders below one."""
    folder = scratch_dir(spark, "landing")
    parts = table(spark, sf, "part").select(*PART.columns)
    parts.filter("p_size <= 15").write.option("header", "true").csv(f"{folder}/a")
    parts.filter("p_size between 16 and 30").write.json(f"{folder}/b")
    parts.filter("p_size > 30").write.parquet(f"{folder}/c")
    return folder


@query("SELECT page_id, url, html FROM pages")
def read_csv_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Whole HTML pages, with their quotes and newlines, through CSV and back."""
    path, _ = writers.land_snapshot(table(spark, sf, "pages"), scratch_dir(spark, "csv"), "pages", DAY1)
    return landing.read_landing(spark, path, PAGE, "csv").drop("source_file")


@query("SELECT page_id, url, html FROM pages")
def read_csv_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages, a CSV file for each split of the scan, read by ranges: quoted newlines may lie anywhere."""
    path = scratch_dir(spark, "csv")
    pages_in = table(spark, sf, "pages").select(*PAGE.columns)
    pages_in.write.options(**landing.CSV_OPTIONS).csv(path)
    return projection.enforce_contract(split_reader(spark, path, PAGE), PAGE)


@query("SELECT doc_id, text, lang, source FROM documents")
def read_landing(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    _documents(spark, sf).write.json(path)
    return landing.read_landing(spark, path, DOCUMENT, "json").drop("source_file")


@query("SELECT doc_id, text, lang, source FROM documents")
def land_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = writers.land_snapshot(_documents(spark, sf), scratch_dir(spark, "land"), "documents", DAY1)
    return landing.read_landing(spark, path, DOCUMENT, "csv").drop("source_file")


@query("""
SELECT CASE WHEN p_size <= 15 THEN 'csv' WHEN p_size <= 30 THEN 'json' ELSE 'parquet' END AS format,
       TRUE AS has_bytes, count(*) AS n_rows FROM part GROUP BY 1
""")
def landing_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = _three_formats(spark, sf)
    suffix = r"\.([a-z]+)$"
    listed = landing.landing_files(spark, folder).groupBy(
        F.regexp_extract("path", suffix, 1).alias("format")
    ).agg((F.sum("length") > 0).alias("has_bytes"))
    read = landing.landing_union(spark, folder, PART).groupBy(
        F.regexp_extract("source_file", suffix, 1).alias("format")
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    return listed.join(read, "format")


@query("""
SELECT p_partkey, p_name, p_brand, p_size,
       CASE WHEN p_size <= 15 THEN 'csv' WHEN p_size <= 30 THEN 'json' ELSE 'parquet' END AS format FROM part
""")
def landing_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = landing.landing_union(spark, _three_formats(spark, sf), PART)
    suffix = F.regexp_extract("source_file", r"\.([a-z]+)$", 1).alias("format")
    return rows.select(*PART.columns, suffix)


@query("SELECT o_orderkey, o_custkey, o_orderstatus AS folder FROM orders")
def with_source_file(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed in one folder per status; each row knows the folder it came from."""
    folder = scratch_dir(spark, "provenance")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").parquet(folder)
    read = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    status = F.regexp_extract("source_file", r"o_orderstatus=([^/]+)/", 1).alias("folder")
    return landing.with_source_file(read).select("o_orderkey", "o_custkey", status)


@query("SELECT p_partkey, p_name, p_brand, p_size FROM part")
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """An older snapshot with other brands is passed over."""
    folder = scratch_dir(spark, "snapshots")
    parts = table(spark, sf, "part").select(*PART.columns)
    writers.stage_clustered(parts, folder, "p_brand", DAY2)
    writers.stage_clustered(parts.withColumn("p_brand", F.lit("old")), folder, "p_brand", DAY1)
    newest = landing.latest_snapshot(spark, folder)
    return landing.read_landing(spark, newest, PART, "parquet").drop("source_file")


@query("""
SELECT l_suppkey, 1 AS n_buckets, TRUE AS in_range, count(*) AS n_rows,
       CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey FROM lineitem GROUP BY 1
""")
def stage_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of a supplier end in one of ten buckets."""
    path, _ = writers.stage_clustered(
        table(spark, sf, "lineitem"), scratch_dir(spark, "staged"), "l_suppkey", DAY1)
    return spark.read.parquet(path).groupBy("l_suppkey").agg(
        F.count_distinct("bucket").cast("int").alias("n_buckets"),
        (F.max("bucket") < 10).alias("in_range"),
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("sum_orderkey"))


@query("SELECT s_suppkey, s_name, s_nationkey + 2 AS s_nationkey FROM supplier")
def table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced twice by plans that read the table itself."""
    path = scratch_dir(spark, "overwrite")
    tables.table_overwrite(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"), path)
    for _ in range(2):
        stored = tables.table_read(spark, path)
        tables.table_overwrite(stored.withColumn("s_nationkey", F.col("s_nationkey") + 1), path)
    return tables.table_read(spark, path)


@query("""
SELECT 'versioned' AS layout, FALSE AS existed, TRUE AS found, s_suppkey FROM supplier
UNION ALL SELECT 'plain', FALSE, TRUE, s_suppkey FROM supplier
UNION ALL SELECT 'partitioned', FALSE, TRUE, s_suppkey FROM supplier
UNION ALL SELECT 'type 2', FALSE, TRUE, s_suppkey FROM supplier
""")
def table_read(spark: SparkSession, sf: str) -> DataFrame:
    """One table in each stored layout: looked for, created, found and read."""
    suppliers = _hashed(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "s_nationkey")
    folder = scratch_dir(spark, "layouts")
    writes = {
        "versioned": lambda path: tables.table_overwrite(suppliers, path),
        "plain": lambda path: tables.table_append(suppliers, path),
        "partitioned": lambda path: tables.replace_partition(suppliers, path, "s_nationkey"),
        "type 2": lambda path: tables.scd2_merge(suppliers, path, ["s_suppkey"], DAY1),
    }
    found = []
    for layout, write in writes.items():
        path = f"{folder}/{layout.replace(' ', '-')}"
        existed = tables.table_exists(spark, path)
        write(path)
        stored = tables.table_read(spark, path)
        found.append(stored.select(
            F.lit(layout).alias("layout"), F.lit(existed).alias("existed"),
            F.lit(tables.table_exists(spark, path)).alias("found"), "s_suppkey"))
    return reduce(DataFrame.unionByName, found)


@query("""
SELECT layout, state, found, (SELECT count(*) FROM supplier) AS suppliers
FROM (VALUES ('versioned'), ('type 2'), ('plain')) l(layout),
     (VALUES ('missing', FALSE), ('torn', FALSE), ('complete', TRUE)) s(state, found)
""")
def table_exists(spark: SparkSession, sf: str) -> DataFrame:
    """A table is found once a write of it is complete; the files of a torn write are none."""
    suppliers = _hashed(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "s_nationkey")
    folder, found = scratch_dir(spark, "exists"), []
    writes = {
        "versioned": ("v=1", tables.table_overwrite), "plain": ("_unfinished", tables.table_append),
        "type 2": ("current/v=1", lambda df, path: tables.scd2_merge(df, path, ["s_suppkey"], DAY1))}
    for layout, (torn, write) in writes.items():
        path = f"{folder}/{layout.replace(' ', '-')}"
        states = [("missing", tables.table_exists(spark, path))]
        suppliers.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/{torn}")
        states.append(("torn", tables.table_exists(spark, path)))
        write(suppliers, path)
        states.append(("complete", tables.table_exists(spark, path)))
        known = [F.struct(F.lit(s).alias("state"), F.lit(f).alias("found")) for s, f in states]
        stored = tables.table_read(spark, path).agg(F.count(F.lit(1)).alias("suppliers"))
        found.append(stored.select(F.lit(layout).alias("layout"), F.inline(F.array(*known)), "suppliers"))
    return reduce(DataFrame.unionByName, found)


@query("SELECT event_id, user_id, event_type FROM events")
def table_append(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "append")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    tables.table_append(events.filter("event_type = 'purchase'"), path)
    tables.table_append(events.filter("event_type <> 'purchase' or event_type is null"), path)
    return tables.table_read(spark, path)


@query("""
SELECT s_suppkey, s_name, CAST(round(s_acctbal * 100) AS BIGINT) AS balance,
       CASE WHEN s_nationkey < 12 THEN DATE '2026-01-01' END AS valid_from_day, TRUE AS open_end FROM supplier
""")
def export_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as documents: some collections have their start filled in, none its open end."""
    suppliers = table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", cents("s_acctbal").alias("balance"),
        F.lit(None).cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(None).cast("timestamp").alias("other"))
    folder = scratch_dir(spark, "documents")
    filled, empty = f"{folder}/filled", f"{folder}/empty"
    writers.export_documents(suppliers.filter("s_nationkey < 12"), filled, DAY1, ["valid_from"])
    writers.export_documents(suppliers.filter("s_nationkey >= 12"), empty, DAY1)
    schema = "s_suppkey bigint, s_name string, balance bigint, valid_from timestamp, valid_to timestamp"
    stored = spark.read.schema(schema).json([filled, empty])
    return stored.select(
        "s_suppkey", "s_name", "balance", F.col("valid_from").cast("date").alias("valid_from_day"),
        F.col("valid_to").isNull().alias("open_end"))


@query("SELECT c_custkey, c_name FROM customer")
def contracts(spark: SparkSession, sf: str) -> DataFrame:
    """An external table declared twice over one folder, read through the catalog."""
    path = scratch_dir(spark, "declared")
    contract = Contract("customer", "c_custkey bigint, c_name string", keys=("c_custkey",))
    table(spark, sf, "customer").select(*contract.columns).write.parquet(path)
    name = f"declared_{path.rsplit('-', 1)[1]}"
    declare_table(spark, contract, path, name)
    return spark.table(declare_table(spark, contract, path, name))


# --- nested pages -----------------------------------------------------------------------------


@query("""
SELECT l_orderkey AS playlist_position, CAST(l_linenumber AS BIGINT) AS page_offset, 0 AS item_position,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS added_at, CAST(l_partkey AS VARCHAR) AS track_id,
       CASE WHEN l_linenumber = 7 THEN 0 ELSE 2 END AS n_artists FROM lineitem
UNION ALL
SELECT l_orderkey, CAST(l_linenumber AS BIGINT), 2, '', 'bare ' || l_partkey, 0 FROM lineitem
""")
def flatten_items(spark: SparkSession, sf: str) -> DataFrame:
    """Pages through JSON text and back; items without a track are left out."""
    path = scratch_dir(spark, "pages")
    pages(spark, sf).write.option("zlib.compress.level", "BEST_SPEED").json(path, compression="gzip")
    return nested.flatten_items(nested.read_pages(spark, path)).select(
        "playlist_position", "page_offset", "item_position", "added_at",
        F.col("track.id").alias("track_id"), F.size("track.artists").alias("n_artists"))


ARTISTS = """
SELECT artist_id, 'artist "' || artist_id || '" of ' || max(l_orderkey) AS artist_name, 'http://artist/' || artist_id AS external_url
FROM (SELECT CAST(unnest([l_suppkey, l_suppkey + 1]) AS VARCHAR) AS artist_id, l_orderkey FROM lineitem WHERE l_linenumber <> 7)
GROUP BY 1
"""
SONGS = """
SELECT CAST(l_partkey AS VARCHAR) AS song_id, 'track ' || l_partkey AS song_name, CAST(l_partkey * 10 AS INTEGER) AS duration_ms,
       'http://track/' || l_partkey AS url, CAST(l_partkey % 101 AS INTEGER) AS popularity,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS song_added,
       CASE WHEN l_returnflag <> 'R' THEN CAST(l_orderkey AS VARCHAR) END AS album_id,
       CASE WHEN l_linenumber <> 7 THEN CAST(l_suppkey AS VARCHAR) END AS artist_id FROM lineitem
UNION ALL SELECT 'bare ' || l_partkey, NULL, NULL, NULL, NULL, '', NULL, NULL FROM lineitem
"""


@query(ARTISTS)
def flatten_artists(spark: SparkSession, sf: str) -> DataFrame:
    items = nested.flatten_items(pages(spark, sf))
    return nested.flatten_artists(items, F.lit(T1), LINK).drop("extraction_date")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS album_id, 'album' || chr(10) || l_orderkey AS name,
       (1950 + l_orderkey % 70) || '-05' AS release_date, CAST(l_orderkey % 20 + 1 AS INTEGER) AS total_tracks,
       'http://album/' || l_orderkey AS url, CAST(l_orderkey % 97 AS VARCHAR) AS artist_id
FROM lineitem WHERE l_returnflag <> 'R'
""")
def flatten_albums(spark: SparkSession, sf: str) -> DataFrame:
    items = nested.flatten_items(pages(spark, sf))
    return nested.flatten_albums(items, F.lit(T1), LINK).drop("extraction_date")


@query(SONGS)
def flatten_songs(spark: SparkSession, sf: str) -> DataFrame:
    items = nested.flatten_items(pages(spark, sf))
    return nested.flatten_songs(items, F.lit(T1), LINK).drop("extraction_date")


@query(f"""
SELECT 'artists' AS entity, count(*) AS entity_count FROM ({ARTISTS})
UNION ALL SELECT 'albums', count(*) FILTER (l_returnflag <> 'R') FROM lineitem
UNION ALL SELECT 'songs', count(*) FROM ({SONGS})
""")
def extract_summary(spark: SparkSession, sf: str) -> DataFrame:
    return nested.entity_counts(nested.flatten_items(pages(spark, sf)))


BRIDGE = """b AS (SELECT track_id, artist_id, row_number() OVER (PARTITION BY track_id ORDER BY artist_id) - 1 AS position,
  count(*) OVER (PARTITION BY track_id) AS n_members FROM (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS track_id,
    CAST(unnest([l_suppkey, l_suppkey + 1]) AS VARCHAR) AS artist_id FROM lineitem WHERE l_linenumber <> 7))"""


@query(f"WITH {BRIDGE} SELECT track_id, artist_id, CAST(position AS INTEGER) AS position, n_members, CAST(1 AS DOUBLE) / n_members AS weight FROM b")
def bridge_table(spark: SparkSession, sf: str) -> DataFrame:
    """The artists of every track, over all of its occurrences."""
    items = nested.flatten_items(pages(spark, sf))
    return bridge.bridge_table(nested.track_artists(items), "track_id", "artist_id")


@query(f"""
WITH {BRIDGE},
m AS (SELECT CAST(l_partkey AS VARCHAR) AS track_id, sum(l_partkey % 101) AS popularity, sum(l_partkey * 10) AS duration_ms
      FROM lineitem GROUP BY 1),
s AS (SELECT artist_id, CASE WHEN artist_id IS NULL THEN popularity ELSE popularity // n_members +
        CASE WHEN position < popularity % n_members THEN 1 ELSE 0 END END AS popularity,
        CASE WHEN artist_id IS NULL THEN duration_ms ELSE duration_ms // n_members +
        CASE WHEN position < duration_ms % n_members THEN 1 ELSE 0 END END AS duration_ms FROM m LEFT JOIN b USING (track_id)
      UNION ALL SELECT NULL, NULL, NULL)
SELECT artist_id, CAST(sum(popularity) AS BIGINT) AS popularity, CAST(sum(duration_ms) AS BIGINT) AS duration_ms,
       rank() OVER (ORDER BY sum(popularity) DESC NULLS LAST) AS place FROM s GROUP BY artist_id
""")
def through_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """Artists ranked by the popularity that their tracks share out among them; all shares add up."""
    items = nested.flatten_items(pages(spark, sf))
    artists = bridge.bridge_table(nested.track_artists(items), "track_id", "artist_id")
    rows = items.select(F.col("track.id").alias("track_id"), F.col("track.popularity").alias("popularity"),
                        F.col("track.duration_ms").alias("duration_ms"))
    totals = bridge.through_bridge(rows, artists, "track_id", "artist_id", ["popularity", "duration_ms"])
    return rankings.ranked(totals, "popularity", "place")


# --- jobs -------------------------------------------------------------------------------------

# A compressed file is read by one task: files of bounded size keep all cores busy to the end.
PAGES_PER_FILE = 250_000


def _extract(
    spark: SparkSession, sf: str, source: str, layout: Layout, as_of: datetime, renamed: bool = False
) -> DataFrame:
    """Extract pages that are written for it, and removed once their items and corrupt pages are stored."""
    with settings(spark, small_scans(spark, SORTED_SCAN_BYTES) | DROP_SHUFFLES):
        writer = pages(spark, sf, renamed).write.options(**writers.GZIP_LEVEL)
        writer.option("maxRecordsPerFile", PAGES_PER_FILE).json(source, compression="gzip")
    metrics = run_extract(spark, source, layout, as_of, LINK)
    delete_folder(spark, source)
    return metrics


def _lake(spark: SparkSession, sf: str, extracts: int, gold: bool = False) -> Layout:
    """A fresh lake after so many extracts; from the second on every seventh artist is renamed."""
    layout = Layout(scratch_dir(spark, "lake"))
    for number, as_of in enumerate((DAY1, DAY2)[:extracts]):
        source = f"{layout.root}/pages/{number}"
        _extract(spark, sf, source, layout, as_of, renamed=number > 0)
        if extracts > 1:
            run_silver(spark, layout, as_of)
        if gold:
            run_gold(spark, layout, as_of, "src")
    return layout


@query(f"""
SELECT 'artists' AS step, metric, value FROM (SELECT count(*) AS value FROM ({ARTISTS})),
  (VALUES ('extracted'), ('landed'), ('staged')) v(metric)
UNION ALL SELECT 'albums', metric, value FROM (SELECT count(*) FILTER (l_returnflag <> 'R') AS value FROM lineitem),
  (VALUES ('extracted'), ('landed'), ('staged')) v(metric)
UNION ALL SELECT 'songs', metric, value FROM (SELECT count(*) AS value FROM ({SONGS})),
  (VALUES ('extracted'), ('landed'), ('staged')) v(metric)
UNION ALL SELECT 'pages', 'read', count(*) FROM lineitem UNION ALL SELECT 'pages', 'rejected', 0
""")
def _run_extract(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(scratch_dir(spark, "lake"))
    return _extract(spark, sf, f"{layout.root}/pages", layout, DAY1).filter("metric <> 'millis'")


TRACKS = f"""(SELECT * FROM ({SONGS}) QUALIFY row_number() OVER (PARTITION BY song_id
  ORDER BY song_added DESC, album_id DESC NULLS LAST, artist_id DESC NULLS LAST) = 1)"""
ALBUMS = "(SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')"
# A renamed artist of the second extract has two versions; the names carry no other change.
ARTIST_VERSIONS = f"""(SELECT artist_id, artist_name || CASE WHEN day = 2 THEN ' (renamed)' ELSE '' END AS artist_name,
  external_url, day = 2 OR CAST(artist_id AS BIGINT) % 7 <> 0 AS is_current, day
  FROM ({ARTISTS}), (VALUES (1), (2)) v(day) WHERE day = 1 OR CAST(artist_id AS BIGINT) % 7 = 0)"""


@query(f"""
SELECT artist_id, artist_name, external_url, is_current, DATE '2025-12-31' + day AS valid_from_day,
       CASE WHEN NOT is_current THEN DATE '2026-01-02' END AS valid_to_day
FROM {ARTIST_VERSIONS}
""")
def _run_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver artists after two extracts and a repeated run."""
    layout = _lake(spark, sf, 2)
    run_silver(spark, layout, DAY3)
    artists = tables.table_read(spark, f"{layout.silver}/artists")
    return artists.select(
        "artist_id", "artist_name", "external_url", "is_current",
        F.col("valid_from").cast("date").alias("valid_from_day"),
        F.col("valid_to").cast("date").alias("valid_to_day"))


@query(f"""
SELECT CAST(l_orderkey AS VARCHAR) AS album_id, 'album' || chr(10) || l_orderkey AS name,
       make_date(1950 + l_orderkey % 70, 5, 1) AS release_day, CAST(l_orderkey % 20 + 1 AS INTEGER) AS total_tracks,
       'http://album/' || l_orderkey AS url, CAST(l_orderkey % 97 AS VARCHAR) AS artist_id, TRUE AS is_current,
       DATE '2026-01-01' AS valid_from_day FROM {ALBUMS}
""")
def silver_albums(spark: SparkSession, sf: str) -> DataFrame:
    """Silver albums after two extracts without a change: their only version is the first."""
    albums = tables.table_read(spark, f"{_lake(spark, sf, 2).silver}/albums")
    return albums.select(
        "album_id", "name", F.col("release_date").cast("date").alias("release_day"), "total_tracks", "url",
        "artist_id", "is_current", F.col("valid_from").cast("date").alias("valid_from_day"))


@query(f"""
SELECT song_id AS track_id, song_name AS name, duration_ms, url, popularity, song_added, album_id, artist_id
FROM {TRACKS}
""")
def silver_tracks(spark: SparkSession, sf: str) -> DataFrame:
    tracks = tables.table_read(spark, f"{_lake(spark, sf, 2).silver}/tracks")
    return tracks.select(
        "track_id", "name", "duration_ms", "url", "popularity", "song_added", "album_id", "artist_id")


@query(f"""
SELECT 'artist' AS kind, sha256(artist_id || 'src') AS durable_key, artist_id AS id, artist_name AS name, is_current,
       DATE '2025-12-31' + day AS valid_from_day, CASE WHEN NOT is_current THEN DATE '2026-01-02' END AS valid_to_day
FROM {ARTIST_VERSIONS}
UNION ALL SELECT 'album', sha256(l_orderkey || 'src'), CAST(l_orderkey AS VARCHAR), 'album' || chr(10) || l_orderkey, TRUE,
       DATE '2026-01-01', NULL FROM {ALBUMS}
UNION ALL SELECT 'track', sha256(song_id || 'src'), song_id, song_name, TRUE, DATE '2026-01-01', NULL FROM {TRACKS}
""")
def gold_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    """The three entity dimensions after two extracts, each loaded into silver and gold."""
    layout = _lake(spark, sf, 2, gold=True)
    stored = []
    for kind in ("artist", "album", "track"):
        rows = tables.table_read(spark, f"{layout.gold}/dim_{kind}s")
        stored.append(rows.select(
            F.lit(kind).alias("kind"), F.col(f"{kind}_key").alias("durable_key"), F.col(f"{kind}_id").alias("id"),
            F.col(f"{kind}_name").alias("name"), "is_current",
            F.col("valid_from").cast("date").alias("valid_from_day"),
            F.col("valid_to").cast("date").alias("valid_to_day")))
    return reduce(DataFrame.unionByName, stored)


@query("""
SELECT o_orderkey, CAST(f AS DATE) AS first_day, CAST(f + INTERVAL 120 MONTH AS DATE) AS last_day
FROM (SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) - 1825 AS f FROM orders)
""")
def _calendar_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """The default calendar around the day of every order."""
    first, last = calendar_bounds("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", first.alias("first_day"), last.alias("last_day"))


@query("""
SELECT 'item' AS kind, CAST(l_orderkey AS VARCHAR) AS playlist_id, CAST(l_linenumber AS BIGINT) AS page_offset,
       unnest([CAST(l_partkey AS VARCHAR), 'bare ' || l_partkey]) AS track_id FROM lineitem WHERE l_linenumber < 6
UNION ALL SELECT 'rejected', NULL, CAST(l_linenumber AS BIGINT), NULL FROM lineitem WHERE l_linenumber >= 6
""")
def corrupt_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages torn at their end or with a misfit deep in an item are kept whole and give no items."""
    layout = Layout(scratch_dir(spark, "lake"))
    text = pages(spark, sf).select("page_offset", F.to_json(F.struct("*")).alias("value"))
    torn = F.expr("substring(value, 1, length(value) - 2)")
    misfit = F.regexp_replace("value", '"popularity":[0-9]+', '"popularity":"high"')
    broken = F.when(F.col("page_offset") == 7, torn).when(F.col("page_offset") == 6, misfit).otherwise(F.col("value"))
    text.select(broken.alias("value")).write.text(f"{layout.root}/pages", compression="gzip")
    run_extract(spark, f"{layout.root}/pages", layout, DAY1, LINK)
    items = spark.read.parquet(f"{layout.raw}/items/*").select(
        F.lit("item").alias("kind"), "playlist_id", "page_offset", F.col("track.id").alias("track_id"))
    offset = F.regexp_extract("corrupt_record", '"page_offset":([0-9]+)', 1).cast("bigint")
    rejected = spark.read.parquet(f"{layout.rejected}/pages/*").select(
        F.lit("rejected").alias("kind"), offset.alias("page_offset"))
    return items.unionByName(rejected, allowMissingColumns=True)


@query("""
SELECT CASE WHEN c_nationkey <> 0 THEN c_custkey END AS c_custkey, c_name,
       CASE WHEN c_nationkey <> 1 THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS balance,
       CASE c_nationkey WHEN 0 THEN 'no key' WHEN 1 THEN 'misfit' ELSE 'none' END AS problem,
       CASE WHEN c_nationkey = 1 THEN 'balance=n/a' END AS misfits FROM customer
""")
def checked_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Landed customers, some without a key and some with a balance that is no number."""
    contract = Contract("customer", "c_custkey bigint, c_name string, balance bigint", keys=("c_custkey",))
    rows = table(spark, sf, "customer").select(
        F.when(F.col("c_nationkey") != 0, F.col("c_custkey")).alias("c_custkey"), "c_name",
        F.when(F.col("c_nationkey") == 1, "n/a").otherwise(cents("c_acctbal").cast("string")).alias("balance"))
    path, _ = writers.land_snapshot(rows, scratch_dir(spark, "checked"), "customer", DAY1)
    return landing.checked_landing(spark, path, contract).select(*contract.columns, "problem", "misfits")


@query(f"""
SELECT sha256(t.song_id || 'src') AS track_key, CASE WHEN a.artist_id IS NOT NULL THEN sha256(t.artist_id || 'src') END AS artist_key,
       CASE WHEN b.l_orderkey IS NOT NULL THEN sha256(t.album_id || 'src') END AS album_key,
       t.popularity, d.date_key, 1 AS play_count
FROM {TRACKS} t LEFT JOIN ({ARTISTS}) a ON a.artist_id = t.artist_id
LEFT JOIN {ALBUMS} b ON CAST(b.l_orderkey AS VARCHAR) = t.album_id,
(VALUES (20260102), (20260103)) d(date_key)
""")
def _run_gold(spark: SparkSession, sf: str) -> DataFrame:
    """The fact after two days, the second of them loaded twice."""
    layout = _lake(spark, sf, 2)
    for as_of in (DAY2, DAY3, DAY3):
        run_gold(spark, layout, as_of, "src")
    fact = tables.table_read(spark, f"{layout.gold}/fact_track_plays")
    return fact.select("track_key", "artist_key", "album_key", "popularity", "date_key", "play_count")


@query(f"""
WITH t AS {TRACKS}, a AS (SELECT * FROM {ARTIST_VERSIONS} WHERE is_current),
q1 AS (SELECT artist_id AS name, CAST(count(*) AS DOUBLE) AS value FROM t GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 3),
q2 AS (SELECT a.artist_name AS name, g.value FROM (SELECT artist_id, avg(popularity) AS value FROM t GROUP BY 1) g
       JOIN a USING (artist_id) ORDER BY g.value DESC, artist_id LIMIT 10),
q3 AS (SELECT substr(song_added, 1, 4) AS name, avg(popularity) AS value FROM t
       WHERE regexp_matches(song_added, '^[0-9]{{4}}-') GROUP BY 1),
q4 AS (SELECT album_id, CAST(coalesce(sum(popularity), 0) AS DOUBLE) AS value FROM t GROUP BY 1
       ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 5)
SELECT 'artists_by_rows' AS query, name, value FROM q1 UNION ALL SELECT 'artists_by_popularity', name, value FROM q2
UNION ALL SELECT 'popularity_by_year', name, value FROM q3
UNION ALL SELECT 'albums_by_popularity', 'album' || chr(10) || album_id, value FROM q4 WHERE album_id IS NOT NULL
""")
def _analysis(spark: SparkSession, sf: str) -> DataFrame:
    """The four ranked queries over a star schema loaded from two extracts."""
    layout = _lake(spark, sf, 2)
    run_gold(spark, layout, DAY2, "src")
    columns = {
        "artists_by_rows": ("artist_id", "count"),
        "artists_by_popularity": ("artist_name", "avg_popularity"),
        "popularity_by_year": ("year_added", "avg_popularity"),
        "albums_by_popularity": ("album_name", "total_popularity"),
    }
    found = analysis(spark, layout)
    return reduce(DataFrame.unionByName, [
        found[name].select(F.lit(name).alias("query"), F.col(label).alias("name"),
                           F.col(value).cast("double").alias("value"))
        for name, (label, value) in columns.items()
    ])


@query(f"""
SELECT 'artists' AS collection, count(*) AS documents FROM ({ARTISTS}) UNION ALL SELECT 'albums', count(*) FROM {ALBUMS}
UNION ALL SELECT 'tracks', count(*) FROM {TRACKS} UNION ALL SELECT 'track_plays', count(*) FROM {TRACKS}
""")
def _run_export(spark: SparkSession, sf: str) -> DataFrame:
    layout = _lake(spark, sf, 1)
    run_silver(spark, layout, DAY1)
    run_gold(spark, layout, DAY1, "src")
    exported = run_export(spark, layout, DAY1)
    counts = {name: spark.read.text(path) for name, path in exported.items() if name != "profile"}
    return quality.extract_summary(counts).toDF("collection", "documents")


@query(f"{SCD2_BALANCES} SELECT * FROM result")
def _stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Two extracts of several files picked up by a restarted stream; rows without a key are set aside."""
    folder = scratch_dir(spark, "stream")
    contract = Contract(
        "customer", "c_custkey bigint, c_name string, balance bigint, extraction_date timestamp",
        keys=("c_custkey",))
    for rows, as_of in zip(_stage_balances(spark, sf), (DAY1, DAY2)):
        stamped = rows.drop("hash_key").withColumn("extraction_date", F.lit(as_of.isoformat()))
        keyless = stamped.withColumn("c_custkey", F.lit(None).cast("bigint"))
        odd = F.col("c_custkey") % 2 == 1
        for part, landed in (("odd", stamped.filter(odd)), ("even", stamped.filter(~odd)), ("keyless", keyless)):
            writers.land_snapshot(landed, f"{folder}/landing", f"customer_{part}", as_of)
        stream_landing(
            spark, f"{folder}/landing", contract, f"{folder}/table", f"{folder}/checkpoint", as_of, files_per_batch=2)
    stored = tables.table_read(spark, f"{folder}/table")
    return stored.select(
        "c_custkey", "c_name", "balance", "is_current",
        F.date_trunc("day", "valid_from").cast("timestamp_ntz").alias("valid_from"),
        F.date_trunc("day", "valid_to").cast("timestamp_ntz").alias("valid_to"))


@query(f"""
WITH s AS (SELECT c_custkey, c_nationkey, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer)
SELECT c_custkey, balance, c_nationkey >= 10 AS is_current, DATE '2026-01-01' AS valid_from_day, 'csv' AS read_as, 1 AS merged_on FROM s
UNION ALL SELECT c_custkey, balance + 1, c_nationkey >= 5, DATE '2026-01-02', 'json', 2 FROM s WHERE c_nationkey < 10
UNION ALL SELECT c_custkey, balance + 2, TRUE, DATE '2026-01-03', 'parquet', 3 FROM s WHERE c_nationkey < 5
""")
def file_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Three extracts in three formats, the files of the earlier ones gone when the next run comes.

    Every version names the run whose ledger entry holds the file that it was read from.
    """
    layout = Layout(scratch_dir(spark, "lake"))
    contract = Contract(
        "customer", "c_custkey bigint, balance bigint, extraction_date timestamp", keys=("c_custkey",))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", cents("c_acctbal").alias("balance"))
    added = F.when(F.col("c_nationkey") < 5, 1).otherwise(0)
    extracts = (
        (customers, "csv"), (customers.withColumn("balance", F.col("balance") + (F.col("c_nationkey") < 10).cast("int")), "json"),
        (customers.withColumn("balance", F.col("balance") + (F.col("c_nationkey") < 10).cast("int") + added), "parquet"))
    for (rows, fmt), as_of in zip(extracts, (DAY1, DAY2, DAY3)):
        landed = rows.select("c_custkey", "balance", F.lit(as_of.isoformat()).alias("extraction_date"))
        writer = landed.write.mode("overwrite").format(fmt)
        writer.options(**(landing.CSV_OPTIONS if fmt == "csv" else {})).save(f"{layout.staged}/customers/{as_of.day}")
        merge_landing(spark, f"{layout.staged}/customers", contract, layout, "customers", as_of)
        # What the ledger knows is not opened again: the run after this one would fail on an empty text.
        spark.createDataFrame([("",)], "value string").write.mode("overwrite").text(f"{layout.staged}/customers/{as_of.day}")
    name = F.regexp_extract("path", "[^/]+$", 0).alias("file")
    runs = ledger_read(spark, f"{layout.ledger}/customers").select(name, F.dayofmonth("merged_at").alias("merged_on"))
    stored = tables.table_read(spark, f"{layout.silver}/customers").withColumn(
        "file", F.regexp_extract("source_file", "[^/]+$", 0))
    return stored.join(runs, "file").select(
        "c_custkey", "balance", "is_current", F.col("valid_from").cast("date").alias("valid_from_day"),
        F.regexp_extract("file", "[a-z]+$", 0).alias("read_as"), "merged_on")


@query("""
WITH cells AS (
    SELECT 'l_orderkey' AS column_name, count(*) AS row_count, count(*) - count(l_orderkey) AS null_count,
           count(DISTINCT l_orderkey) AS distinct_count, min(l_orderkey) AS least, max(l_orderkey) AS greatest FROM lineitem
    UNION ALL SELECT 'l_suppkey', count(*), count(*) - count(l_suppkey), count(DISTINCT l_suppkey), min(l_suppkey),
           max(l_suppkey) FROM lineitem
    UNION ALL SELECT 'shipped', count(*), count_if(l_quantity >= 40), count(DISTINCT CAST(l_shipdate AS DATE)) FILTER (l_quantity < 40),
           min(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) FILTER (l_quantity < 40),
           max(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) FILTER (l_quantity < 40) FROM lineitem)
SELECT column_name, row_count, null_count, distinct_count, least, greatest, TRUE AS distinct_within, TRUE AS median_within,
       'l_returnflag=R' AS read_by_second_run
FROM cells
""")
def mergeable_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of partitions, the last of them added later and read alone, merged and compared with exact figures.

    Estimates have to lie within 5 % of the distinct values and of the middle rank.
    """
    folder = scratch_dir(spark, "profiles")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", F.when(F.col("l_quantity") < 40, F.col("l_shipdate").cast("date")).alias("shipped"),
        "l_returnflag")
    for part in (F.col("l_returnflag") != "R", F.col("l_returnflag") == "R"):
        lines.filter(part).write.mode("append").partitionBy("l_returnflag").parquet(f"{folder}/lines")
        read = refresh_profiles(spark, f"{folder}/lines", "l_returnflag", f"{folder}/profiles")
    found = sketches.profile_estimates(table_profile_estimate(spark, f"{folder}/profiles"), (0.0, 0.5, 1.0)).select(
        "*", *(F.col("quantiles")[i].alias(name) for i, name in enumerate(("least", "median", "greatest"))))
    medians = {r["column_name"]: r["median"] for r in found.select("column_name", "median").collect()}
    kinds = {f.name: f.dataType for f in lines.schema.fields}
    exact = lines.agg(*(
        F.struct(
            F.lit(c).alias("column_name"), F.count_distinct(c).alias("distinct_count"),
            (F.count_if(sketches.measured(c, kinds[c]) <= m) / F.count(c)).alias("at"),
            (F.count_if(sketches.measured(c, kinds[c]) < m) / F.count(c)).alias("below")).alias(c)
        for c, m in medians.items()))
    exact = exact.select(F.inline(F.array(*medians)))
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_count"))
    return found.join(exact, "column_name").select(
        "column_name", "row_count", "null_count", "distinct_count", F.col("least").cast("long").alias("least"),
        F.col("greatest").cast("long").alias("greatest"), (off <= 0.05 * F.col("distinct_count")).alias("distinct_within"),
        ((F.col("below") <= 0.55) & (F.col("at") >= 0.45)).alias("median_within"),
        F.lit(",".join(read)).alias("read_by_second_run"))


@query("""
SELECT o_orderkey, o_custkey, CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS load,
       CASE WHEN o_orderkey % 4 IN (0, 1) THEN TRUE ELSE FALSE END AS came_again
FROM orders WHERE o_orderkey % 4 < 3
""")
def insert_by_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Four overlapping loads into an insert-only table; each key keeps the row of its first load.

    The loads hold the keys of two remainders of four each; the last one is a repetition and adds nothing.
    """
    path = scratch_dir(spark, "appends")
    rest = F.col("o_orderkey") % 4
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    for load, of in enumerate(((0,), (0, 1), (1, 2), (0, 2)), 1):
        insert_filtered(orders.filter(rest.isin(*of)).withColumn("load", F.lit(load)), path, ["o_orderkey"])
    return appends_read(spark, path).withColumn("came_again", rest < 2)


@query("""
SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus <> 'F' AS is_current, DATE '2026-01-01' AS valid_from,
       CASE WHEN o_orderstatus = 'F' THEN DATE '2026-01-02' END AS valid_to
FROM orders WHERE o_orderdate < DATE '1998-01-01'
UNION ALL
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderpriority END, TRUE, DATE '2026-01-02', NULL
FROM orders WHERE o_orderdate >= DATE '1998-01-01' OR o_orderstatus = 'F'
""")
def merge_copartitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads of a type 2 table in buckets: early orders, then all of them with closed ones, then the same again."""
    path, by_order = scratch_dir(spark, "copartitioned"), Buckets(("o_orderkey",), 16)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("priority"), (
        F.col("o_orderstatus") == "F").alias("finished"))
    early = orders.filter(F.col("o_orderdate") < "1998-01-01")
    closed = orders.withColumn("priority", F.when(F.col("finished"), "closed").otherwise(F.col("priority")))
    for staged, day in ((early, DAY1), (closed, DAY2), (closed, DAY3)):
        copartitioned_merge(_hashed(staged.select("o_orderkey", "priority"), "priority"), path, by_order, day)
    return copartitioned_read(spark, path, by_order).select(
        "o_orderkey", "priority", "is_current", F.to_date("valid_from").alias("valid_from"),
        F.to_date("valid_to").alias("valid_to"))


@query("""
SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS load FROM orders
""")
def insert_copartitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Four overlapping loads into an insert-only table in buckets; each key keeps the row of its first load."""
    path, by_order = scratch_dir(spark, "copartitioned"), Buckets(("o_orderkey",), 16)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for load, of in enumerate((("F",), ("F", "O"), ("F", "O", "P"), ("O",)), 1):
        staged = orders.filter(F.col("o_orderstatus").isin(*of)).drop("o_orderstatus")
        copartitioned_insert(staged.withColumn("load", F.lit(load)), path, by_order)
    return copartitioned_read(spark, path, by_order)


@query("""
SELECT l_suppkey, max(l_shipdate) AS extraction_date, count(*) AS seen,
       (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS rejected FROM lineitem
WHERE l_returnflag <> 'R' GROUP BY 1
""")
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the rows lacks its key: they are set apart and counted, the rest is staged."""
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("l_suppkey"),
        F.col("l_shipdate").alias("extraction_date"))
    contract = Contract("lines", "l_suppkey bigint, extraction_date timestamp_ntz", keys=("l_suppkey",))
    complete, rejected = projection.split_null_keys(lines, contract.keys)
    staged = dedup.dedup_latest(complete, contract.keys, ["extraction_date"])
    seen = complete.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("seen"))
    total = rejected.agg(F.count(F.lit(1)).alias("rejected")).first()["rejected"]
    return staged.join(seen, "l_suppkey").withColumn("rejected", F.lit(total))
