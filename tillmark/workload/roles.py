"""The given tables in the roles of the retail data set, as silver frames and as raw text.

Parts are products, suppliers are stores (fifteen customers each), order status F means cancelled. Every
frame has its SQL twin, a common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What the given codes stand for.
STATUS = {"F": "cancelled", "O": "pending", "P": "completed"}
LOADED = "2002-01-01 00:00:00"
CALENDAR = ("1992-01-01", "2005-12-31")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def money(column: str):
    return F.col(column).cast("decimal(18,4)")


def _loaded():
    return F.lit(LOADED).cast("timestamp_ntz").alias("_loaded_at")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("city"),
        F.lit(None).cast("timestamp_ntz").alias("join_date"),
        F.col("c_mktsegment").alias("segment"),
        F.lit("customer").alias("_source_file"),
        _loaded(),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey")).alias("city"),
        F.lit(None).cast("timestamp_ntz").alias("opened_date"),
        F.lit("supplier").alias("_source_file"),
        _loaded(),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of size 1 have no category."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") > 1, F.col("p_brand")).alias("category_id"),
        money("p_retailprice").alias("unit_price"),
        F.lit("part").alias("_source_file"),
        _loaded(),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = read(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.select(
        F.col("p_brand").alias("category_id"),
        F.upper("p_brand").alias("category_name"),
        F.lit("part").alias("_source_file"),
        _loaded(),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    mapped = F.when(status == "F", STATUS["F"]).when(status == "O", STATUS["O"]).otherwise(STATUS["P"])
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.floor(F.col("o_custkey") / 15).cast("string").alias("store_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("payment_method"),
        mapped.alias("status"),
        F.lit("orders").alias("_source_file"),
        F.col("o_orderdate").alias("_loaded_at"),
    )


def item_id():
    """Line numbers repeat inside an order; with part, supplier and ship date a line is unique."""
    day = F.date_format("l_shipdate", "yyyyMMdd")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per line."""
    return read(spark, sf_dir, "lineitem").select(
        item_id().alias("order_item_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        money("l_extendedprice").alias("unit_price"),
        F.lit("lineitem").alias("_source_file"),
        F.col("l_shipdate").alias("_loaded_at"),
    )


CTE = {
    "customers": f"""customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email, CAST(NULL AS VARCHAR) AS phone,
         'NATION_' || CAST(c_nationkey AS VARCHAR) AS city, CAST(NULL AS TIMESTAMP) AS join_date,
         c_mktsegment AS segment, TIMESTAMP '{LOADED}' AS _loaded_at
  FROM customer)""",
    "stores": f"""stores AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name,
         'NATION_' || CAST(s_nationkey AS VARCHAR) AS city, CAST(NULL AS TIMESTAMP) AS opened_date,
         TIMESTAMP '{LOADED}' AS _loaded_at
  FROM supplier)""",
    "products": f"""products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         CASE WHEN p_size > 1 THEN p_brand END AS category_id,
         CAST(p_retailprice AS DECIMAL(18,4)) AS unit_price, TIMESTAMP '{LOADED}' AS _loaded_at
  FROM part)""",
    "categories": """categories AS (
  SELECT DISTINCT p_brand AS category_id, upper(p_brand) AS category_name FROM part)""",
    "retail_orders": """retail_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_custkey // 15 AS VARCHAR) AS store_id, o_orderdate AS order_date,
         o_orderpriority AS payment_method,
         CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'O' THEN 'pending' ELSE 'completed' END AS status,
         o_orderdate AS _loaded_at
  FROM orders)""",
    "order_items": """order_items AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS order_item_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,4)) AS unit_price,
         l_shipdate AS _loaded_at
  FROM lineitem)""",
    "dim_product": """dim_product AS (
  SELECT p.product_id, p.product_name, p.category_id, c.category_name, p.unit_price, p._loaded_at
  FROM products p LEFT JOIN categories c ON p.category_id = c.category_id)""",
    "fact_sales": """fact_sales AS (
  SELECT i.order_item_id, i.order_id, CAST(strftime(o.order_date, '%Y%m%d') AS BIGINT) AS date_key,
         o.customer_id, i.product_id, o.store_id, o.payment_method, o.status AS order_status,
         i.quantity, i.unit_price, CAST(i.quantity * i.unit_price AS DECIMAL(18,4)) AS line_amount,
         greatest(i._loaded_at, o._loaded_at) AS _loaded_at
  FROM order_items i JOIN retail_orders o ON i.order_id = o.order_id
  WHERE i.quantity IS NOT NULL AND i.unit_price IS NOT NULL AND o.order_date IS NOT NULL
    AND o.customer_id IS NOT NULL AND o.store_id IS NOT NULL)""",
}
FACT = ("retail_orders", "order_items", "fact_sales")


def with_ctes(*names: str) -> str:
    return "WITH " + ",\n".join(CTE[n] for n in names) + "\n"
