"""Cleaning rules over text made from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions import calendar
from tillmark.functions.cleaning import (
    clean_text,
    non_negative,
    parse_moment,
    parse_number,
    to_count,
    to_money,
    within,
)
from tillmark.functions.filenames import batch_ts
from tillmark.plans import silver
from tillmark.specs import TABLES
from tillmark.workload.registry import query
from tillmark.workload.roles import read

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def with_comma(column: str) -> Column:
    return F.translate(F.col(column).cast("string"), ".", ",")


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) AS price FROM lineitem"""
)
def clean_decimal_comma(spark: SparkSession, sf: str) -> DataFrame:
    text = with_comma("l_extendedprice")
    return read(spark, sf, "lineitem").select(*LINE, to_money(parse_number(text)).alias("price"))


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(18,4)) AS DOUBLE) END
       AS balance FROM customer"""
)
def clean_unparsable_null(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers with a thousands point and a decimal comma cannot be read; others can."""
    balance = F.col("c_acctbal").cast("string")
    text = F.when(F.col("c_nationkey") == 3, F.concat(F.lit("1."), with_comma("c_acctbal"))).otherwise(balance)
    return read(spark, sf, "customer").select("c_custkey", to_money(parse_number(text)).alias("balance"))


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,4)) AS DOUBLE) END AS balance
       FROM customer"""
)
def clean_negative_null(spark: SparkSession, sf: str) -> DataFrame:
    value = non_negative(parse_number(F.col("c_acctbal").cast("string")))
    return read(spark, sf, "customer").select("c_custkey", to_money(value).alias("balance"))


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_quantity BETWEEN 1 AND 30 THEN CAST(l_quantity AS BIGINT) END AS quantity FROM lineitem"""
)
def clean_bounds_null(spark: SparkSession, sf: str) -> DataFrame:
    value = parse_number(F.col("l_quantity").cast("string"))
    return read(spark, sf, "lineitem").select(*LINE, to_count(within(value, 1, 30)).alias("quantity"))


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS half_quantity,
       CAST(round_even(l_extendedprice, 0) AS BIGINT) AS price FROM lineitem"""
)
def clean_round_int(spark: SparkSession, sf: str) -> DataFrame:
    """Halves round to the even neighbour."""
    half = parse_number((F.col("l_quantity") / 2).cast("string"))
    price = parse_number(F.col("l_extendedprice").cast("string"))
    return read(spark, sf, "lineitem").select(
        *LINE, to_count(half).alias("half_quantity"), to_count(price).alias("price")
    )


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(6,2))
                  * CAST(l_tax AS DECIMAL(6,2)), 4) AS DOUBLE) AS tax FROM lineitem"""
)
def clean_money_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Six digits behind the point become four, half up."""
    exact = (
        F.col("l_extendedprice").cast("decimal(12,2)")
        * F.col("l_discount").cast("decimal(6,2)")
        * F.col("l_tax").cast("decimal(6,2)")
    )
    return read(spark, sf, "lineitem").select(*LINE, to_money(parse_number(exact.cast("string"))).alias("tax"))


@query("SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS order_date FROM orders")
def clean_two_date_formats(spark: SparkSession, sf: str) -> DataFrame:
    """ISO with and without time, and day first, in one column."""
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "dd/MM/yyyy HH:mm:ss"))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )
    return read(spark, sf, "orders").select("o_orderkey", parse_moment(text).alias("order_date"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name FROM customer")
def clean_trim_blank(spark: SparkSession, sf: str) -> DataFrame:
    """Padding of any kind is removed; only padding is NULL."""
    padding = F.lit(" \t ")
    text = F.when(F.col("c_custkey") % 7 == 0, padding).otherwise(F.concat(padding, "c_name", padding))
    return read(spark, sf, "customer").select("c_custkey", clean_text(text).alias("name"))


@query(
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(date_trunc('second', ts) AS VARCHAR) END AS batch_ts
       FROM events"""
)
def batch_ts_from_filename(spark: SparkSession, sf: str) -> DataFrame:
    """File names carry the event's second; those of errors do not have the expected form."""
    stamp = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyyMMdd_HHmmss")).otherwise("latest")
    path = F.concat(F.lit("/drops/orders/orders_"), stamp, F.lit(".csv"))
    return read(spark, sf, "events").select("event_id", batch_ts(path, "orders").alias("batch_ts"))


@query(
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
       CAST(year(o_orderdate) AS BIGINT) AS year, CAST(quarter(o_orderdate) AS BIGINT) AS quarter,
       CAST(month(o_orderdate) AS BIGINT) AS month, monthname(o_orderdate) AS month_name,
       CAST(day(o_orderdate) AS BIGINT) AS day, dayname(o_orderdate) AS day_name,
       isodow(o_orderdate) IN (6, 7) AS is_weekend, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date
       FROM orders"""
)
def calendar_parts(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return read(spark, sf, "orders").select("o_orderkey", *calendar.calendar_columns(day))


@query(
    """SELECT dayname(o_orderdate) AS day_name, count(*) AS orders FROM orders
       WHERE isodow(o_orderdate) IN (6, 7) GROUP BY 1"""
)
def weekend_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").where(calendar.is_weekend(F.col("o_orderdate")))
    return orders.groupBy(F.date_format("o_orderdate", "EEEE").alias("day_name")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CAST(greatest(CASE WHEN l_returnflag <> 'R' THEN l_shipdate END, o_orderdate) AS VARCHAR) AS changed_at
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def later_of_two_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The later of two moments; a missing one is ignored."""
    shipped = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    joined = read(spark, sf, "lineitem").join(
        read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(*LINE, F.greatest(shipped, "o_orderdate").alias("changed_at"))


@query(
    """SELECT c_nationkey, CAST(count(*) FILTER (c_acctbal < -900) AS BIGINT) AS debtors,
       round(CAST(sum(CAST(c_acctbal AS DECIMAL(18,4))) AS DOUBLE)
             / nullif(count(*) FILTER (c_acctbal < -900), 0), 4) AS balance_per_debtor
       FROM (SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal FROM customer) GROUP BY 1"""
)
def safe_divide(spark: SparkSession, sf: str) -> DataFrame:
    """A ratio whose denominator may be zero."""
    debtors = F.count_if(F.col("c_acctbal") < -900)
    total = F.sum(F.col("c_acctbal").cast("decimal(18,4)"))
    return read(spark, sf, "customer").groupBy("c_nationkey").agg(
        debtors.alias("debtors"),
        F.round(total / F.nullif(debtors, F.lit(0)), 4).alias("balance_per_debtor"),
    )


@query("SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS payment_method FROM orders")
def column_projection(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderpriority").alias("payment_method")
    )


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS DOUBLE)
         AS line_amount FROM lineitem"""
)
def line_amount(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.col("l_quantity").cast("bigint") * F.col("l_extendedprice").cast("decimal(18,4)")
    return read(spark, sf, "lineitem").select(*LINE, amount.cast("decimal(18,4)").alias("line_amount"))


def raw_order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as bronze text rows; a line number that occurs again is a later version of the item.

    The ship date is the load time, the other columns complete the version.
    """
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    return read(spark, sf, "lineitem").select(
        F.concat(F.lit("  "), F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), quantity)).otherwise(quantity).alias("quantity"),
        with_comma("l_extendedprice").alias("unit_price"),
        F.format_string("lineitem-%012d", "l_partkey").alias("_source_file"),
        F.col("l_shipdate").alias("_loaded_at"),
        F.col("l_suppkey").alias("_block_start"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("_row_id"),
    )


@query(
    """SELECT order_item_id, order_id, product_id, quantity, unit_price, _source_file, _loaded_at FROM (
  SELECT l_orderkey || '-' || l_linenumber AS order_item_id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) AS unit_price,
         'lineitem-' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS _source_file,
         CAST(l_shipdate AS VARCHAR) AS _loaded_at,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, round(l_extendedprice * 100) DESC) AS rn
  FROM lineitem) WHERE rn = 1"""
)
def silver_order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze text to silver: every cleaning rule, key check and latest version per key."""
    spec = TABLES["order_items"]
    return silver.current_rows(silver.clean(raw_order_items(spark, sf), spec), spec)
