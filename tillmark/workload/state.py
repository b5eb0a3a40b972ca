"""Keyed state, incremental reads and change history over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.cleaning import clean_text
from tillmark.operators.history import change_history, snapshot_diff, snapshot_diff_by_digest, status_transitions
from tillmark.operators.incremental import EPOCH, next_mark, rows_since
from tillmark.operators.integrity import MISSING_KEY, reject_rows, split_missing_key
from tillmark.operators.timeline import as_of
from tillmark.operators.versions import insert_if_absent, latest_by_key, upsert
from tillmark.plans import views
from tillmark.session import fresh_dir
from tillmark.sources.keyed_table import KeyedTable
from tillmark.workload import roles, star
from tillmark.workload.registry import query
from tillmark.workload.roles import FACT, read, with_ctes

HALF = "2024-01-16 00:00:00"
KEY = ["user_id", "event_type"]


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").drop("props")


def halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Latest event per user and type in the first and in the second half of the month."""
    rows, cut = events(spark, sf), F.lit(HALF).cast("timestamp_ntz")
    return (
        latest_by_key(rows.where(F.col("ts") < cut), KEY, ["ts", "event_id"]),
        latest_by_key(rows.where(F.col("ts") >= cut), KEY, ["ts", "event_id"]),
    )


# --- keys and rejects -----------------------------------------------------------------------------


def keyless_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Raw orders; urgent ones have a blank key, those of low priority none."""
    key = F.col("o_orderkey").cast("string")
    priority = F.col("o_orderpriority")
    return read(spark, sf, "orders").select(
        F.when(priority == "1-URGENT", "  ").when(priority != "5-LOW", key).alias("order_id"),
        key.alias("row_key"),
        F.col("o_orderstatus").alias("status"),
        F.concat(F.lit("orders-"), F.year("o_orderdate"), F.lit(".csv")).alias("_source_file"),
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')"""
)
def split_missing_pk_ok(spark: SparkSession, sf: str) -> DataFrame:
    return split_missing_key(keyless_orders(spark, sf), ["order_id"])[0].select("order_id", "status")


@query(
    """SELECT 'orders' AS table_name, 'missing_primary_key' AS reason, CAST(NULL AS VARCHAR) AS order_id,
       CAST(o_orderkey AS VARCHAR) AS row_key, o_orderstatus AS status,
       'orders-' || CAST(year(o_orderdate) AS VARCHAR) || '.csv' AS source_file, true AS keeps_null
       FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')"""
)
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected rows as JSON, taken apart again."""
    cleaned = keyless_orders(spark, sf).withColumn("order_id", clean_text(F.col("order_id")))
    _, bad = split_missing_key(cleaned, ["order_id"])
    rows = reject_rows(bad, "orders", MISSING_KEY, F.localtimestamp())
    field = {name: F.get_json_object("row_json", f"$.{name}") for name in ("order_id", "row_key", "status")}
    return rows.select(
        "table_name",
        "reason",
        *[col.alias(name) for name, col in field.items()],
        "source_file",
        F.col("row_json").contains('"order_id":null').alias("keeps_null"),
    )


# --- latest row and upsert ------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
     ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1"""
)
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    return latest_by_key(
        rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    )


@query(
    """SELECT event_id, CAST(ts AS VARCHAR) AS ts, event_type, user_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1"""
)
def dedup_few_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Five keys share the whole table."""
    return latest_by_key(events(spark, sf), ["event_type"], ["ts", "event_id"])


LATEST = """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY {order} ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""


@query(LATEST.format(order=""))
def upsert_newer_wins(spark: SparkSession, sf: str) -> DataFrame:
    first, second = halves(spark, sf)
    return upsert(first, second, KEY, "ts")


@query(LATEST.format(order=""))
def upsert_stale_ignored(spark: SparkSession, sf: str) -> DataFrame:
    """The older half arrives last and must not replace anything."""
    first, second = halves(spark, sf)
    return upsert(second, first, KEY, "ts")


@query(
    """SELECT user_id, event_type, CAST(version AS VARCHAR) AS version, value FROM (
  SELECT user_id, event_type, date_trunc('month', ts) AS version, value, row_number() OVER (
     PARTITION BY user_id, event_type ORDER BY ts >= TIMESTAMP '2024-01-16' DESC, ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""
)
def upsert_tie_takes_incoming(spark: SparkSession, sf: str) -> DataFrame:
    """All versions are equal, so the incoming row wins."""
    first, second = [
        half.select(*KEY, F.date_trunc("month", "ts").alias("version"), "value") for half in halves(spark, sf)
    ]
    return upsert(first, second, KEY, "version")


@query(LATEST.format(order="ts >= TIMESTAMP '2024-01-16',"))
def insert_absent_only(spark: SparkSession, sf: str) -> DataFrame:
    first, second = halves(spark, sf)
    return insert_if_absent(first, second, KEY)


@query(LATEST.format(order=""))
def keyed_table_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three merges into a stored table, the last one stale, with a snapshot in between."""
    first, second = halves(spark, sf)
    path = fresh_dir(spark, "keyed")
    table = KeyedTable(spark, path, tuple(KEY), first.schema)
    for run, rows in enumerate((first, second, first)):
        table.merge(rows, run, version="ts")
        if run == 1:
            table.compact()
    return table.read()


@query(
    with_ctes(*FACT)
    + """SELECT order_item_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(CASE WHEN quantity < 40 THEN 2 * line_amount ELSE line_amount END AS DOUBLE) AS line_amount,
       CAST(_loaded_at AS VARCHAR) AS _loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id
        ORDER BY _loaded_at DESC, unit_price DESC, quantity DESC) AS rn FROM fact_sales) WHERE rn = 1"""
)
def fact_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A second fact build: changed items replace their rows, items no longer usable keep the old one."""
    columns = ["order_item_id", "quantity", "unit_price", "line_amount", "_loaded_at"]
    facts = latest_by_key(
        star.fact(spark, sf).select(*columns), ["order_item_id"], ["_loaded_at", "unit_price", "quantity"]
    )
    again = facts.where("quantity < 40").withColumn(
        "line_amount", (F.col("line_amount") * 2).cast("decimal(18,4)")
    )
    return upsert(facts, again, ["order_item_id"])


# --- high-water marks -----------------------------------------------------------------------------


@query(
    """SELECT user_id, CAST(coalesce(max(ts) FILTER (ts < TIMESTAMP '2024-01-02'), TIMESTAMP '1970-01-01') AS VARCHAR)
       AS mark FROM events GROUP BY 1"""
)
def watermark_or_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """Stored marks per user, the epoch for users without one."""
    rows = events(spark, sf)
    stored = rows.where(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")).groupBy("user_id").agg(
        F.max("ts").alias("mark")
    )
    users = rows.select("user_id").distinct()
    return users.join(stored, "user_id", "left").select(
        "user_id", F.coalesce("mark", F.lit(EPOCH).cast("timestamp_ntz")).alias("mark")
    )


@query(
    "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-16 00:00:00'"
)
def watermark_scan(spark: SparkSession, sf: str) -> DataFrame:
    return rows_since(events(spark, sf), dt.datetime(2024, 1, 16), "ts").select("event_id", "ts", "user_id")


@query(
    """SELECT count(*) AS rows_read, count(*) FILTER (event_type <> 'error') AS rows_kept,
       CAST(max(ts) AS VARCHAR) AS mark FROM events WHERE ts > TIMESTAMP '2024-01-16 00:00:00'"""
)
def watermark_advance(spark: SparkSession, sf: str) -> DataFrame:
    """The mark moves past every row read, kept or rejected."""
    rows = rows_since(events(spark, sf), dt.datetime(2024, 1, 16), "ts")
    return rows.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("event_type") != "error").alias("rows_kept"),
        next_mark("ts").alias("mark"),
    )


@query("SELECT CAST(0 AS BIGINT) AS rows_read, '2100-01-01 00:00:00' AS mark FROM (SELECT max(ts) FROM events)")
def watermark_nothing_new(spark: SparkSession, sf: str) -> DataFrame:
    """Nothing is newer than the mark, so it stays."""
    mark = dt.datetime(2100, 1, 1)
    return rows_since(events(spark, sf), mark, "ts").agg(
        F.count(F.lit(1)).alias("rows_read"), next_mark("ts", mark).alias("mark")
    )


# --- change history -------------------------------------------------------------------------------


@query(
    """WITH seen AS (SELECT l_orderkey, l_shipdate >= TIMESTAMP '1997-01-01' AS late, arg_max(
    {'f': l_returnflag, 's': l_linestatus}, (l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS v
  FROM lineitem GROUP BY ALL)
SELECT l_orderkey,
  CASE WHEN NOT bool_or(NOT late) THEN 'insert' WHEN NOT bool_or(late) THEN 'absent'
       WHEN count(DISTINCT v) = 2 THEN 'update' ELSE 'unchanged' END AS change,
  CASE WHEN count(*) = 2 THEN concat_ws(',', CASE WHEN count(DISTINCT v.f) = 2 THEN 'l_returnflag' END,
    CASE WHEN count(DISTINCT v.s) = 2 THEN 'l_linestatus' END) ELSE '' END AS changed_columns
FROM seen GROUP BY l_orderkey"""
)
def snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The last line of every order before a date and from it on, compared: some orders have but one of them."""
    rows, late = read(spark, sf, "lineitem"), F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")
    version = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    columns = ["l_orderkey", "l_returnflag", "l_linestatus"]
    before = latest_by_key(rows.where(~late), ["l_orderkey"], version).select(*columns)
    after = latest_by_key(rows.where(late), ["l_orderkey"], version).select(*columns)
    return snapshot_diff(before, after, ["l_orderkey"])


@query(
    """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1992-02-01' THEN 'absent'
    WHEN o_orderdate >= TIMESTAMP '1998-07-25' THEN 'update' ELSE 'unchanged' END AS change,
  CASE WHEN o_orderdate < TIMESTAMP '1992-02-01' THEN '' WHEN o_orderdate < TIMESTAMP '1998-07-25' THEN ''
    WHEN o_orderpriority = '1-URGENT' THEN 'o_orderstatus,o_orderpriority' ELSE 'o_orderstatus' END AS changed_columns
FROM orders
UNION ALL SELECT o_orderkey + 1000000000, 'insert', '' FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-25'"""
)
def snapshot_changes_by_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshots of all orders that differ in few: only buckets of keys whose digests differ are joined."""
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    rows = read(spark, sf, "orders")
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("1992-02-01", "1998-07-25"))
    late = F.col("o_orderdate") >= last
    after = rows.where(F.col("o_orderdate") >= first).withColumns(
        {
            "o_orderstatus": F.when(late, F.concat(F.lit("X"), "o_orderstatus")).otherwise(F.col("o_orderstatus")),
            "o_orderpriority": F.when(~late | (F.col("o_orderpriority") != "1-URGENT"), F.col("o_orderpriority")),
        }
    )
    new = rows.where(late).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)
    return snapshot_diff_by_digest(
        rows.select(*columns), after.select(*columns).unionByName(new.select(*columns)), ["o_orderkey"]
    )


ALLOWED = [("signup", "view"), ("view", "click"), ("click", "purchase"), ("click", "view"), ("purchase", "view")]


@query(
    """SELECT user_id, CAST(ts AS VARCHAR) AS changed_at, before AS from_status, event_type AS to_status,
  (before, event_type) IN (('signup', 'view'), ('view', 'click'), ('click', 'purchase'), ('click', 'view'),
                           ('purchase', 'view')) AS allowed
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
WHERE before <> event_type"""
)
def status_changes(spark: SparkSession, sf: str) -> DataFrame:
    return status_transitions(events(spark, sf), ["user_id"], ["ts", "event_id"], "event_type", ALLOWED)


@query(
    """WITH m AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
s AS (SELECT user_id, event_type, ts, event_id FROM m WHERE before IS NULL OR before <> event_type)
SELECT user_id, event_type, CAST(ts AS VARCHAR) AS valid_from,
  CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS VARCHAR) AS valid_to,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current FROM s"""
)
def change_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return change_history(events(spark, sf), ["user_id"], ["ts", "event_id"], ["event_type"])


def list_prices(spark: SparkSession, sf: str) -> DataFrame:
    """The highest price a part was shipped at on a day, as its list price from that day on."""
    return read(spark, sf, "lineitem").groupBy("l_partkey", "l_shipdate").agg(
        F.max(roles.money("l_extendedprice")).alias("list_price")
    )


def sold_items(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", roles.money("l_extendedprice").alias("price")
    ).join(orders, "l_orderkey")


AS_OF = """WITH prices AS (SELECT l_partkey, l_shipdate, max(CAST(l_extendedprice AS DECIMAL(18,4))) AS list_price
  FROM lineitem GROUP BY 1, 2),
sold AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate,
  CAST(l_extendedprice AS DECIMAL(18,4)) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
priced AS (SELECT sold.*, prices.list_price FROM sold ASOF LEFT JOIN prices
  ON sold.l_partkey = prices.l_partkey AND sold.o_orderdate >= prices.l_shipdate)
"""


@query(
    AS_OF
    + """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  CAST(price AS DOUBLE) AS price, CAST(list_price AS DOUBLE) AS list_price FROM priced"""
)
def price_as_of_sale(spark: SparkSession, sf: str) -> DataFrame:
    """Every sold item with the list price current on the day of the order."""
    priced = as_of(
        sold_items(spark, sf),
        "o_orderdate",
        list_prices(spark, sf).withColumnRenamed("l_shipdate", "valid_from"),
        "valid_from",
        ["l_partkey"],
        "list_price",
        "list_price",
    )
    return priced.drop("o_orderdate")


@query(
    with_ctes(*FACT)
    + """, o AS (SELECT order_id, customer_id, sum(line_amount) AS amount FROM fact_sales
  WHERE order_status <> 'cancelled' GROUP BY 1, 2)
SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount FROM o"""
)
def order_totals(spark: SparkSession, sf: str) -> DataFrame:
    return views.fulfilled(star.fact(spark, sf)).groupBy("order_id", "customer_id").agg(
        F.sum("line_amount").alias("amount")
    )
