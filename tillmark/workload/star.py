"""Star schema, analysis views and report frames over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.calendar import calendar_columns
from tillmark.operators.integrity import reference_violations, flag_broken
from tillmark.plans import gold, report, views
from tillmark.session import fresh_dir
from tillmark.workload import roles
from tillmark.workload.registry import query
from tillmark.workload.roles import CALENDAR, FACT, read, with_ctes


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_sales(roles.order_items(spark, sf), roles.orders(spark, sf))


def dates(spark: SparkSession) -> DataFrame:
    return gold.dim_date(spark, *CALENDAR)


def star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "dim_date": dates(spark),
        "dim_customer": gold.dim_customer(roles.customers(spark, sf)),
        "dim_store": gold.dim_store(roles.stores(spark, sf)),
        "dim_product": gold.dim_product(roles.products(spark, sf), roles.categories(spark, sf)),
        "fact_sales": fact(spark, sf),
    }


# --- dimensions and fact --------------------------------------------------------------------------


@query(
    """
WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
days AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
         FROM span)
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS VARCHAR) AS full_date,
       CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter, CAST(month(d) AS BIGINT) AS month,
       monthname(d) AS month_name, CAST(day(d) AS BIGINT) AS day, dayname(d) AS day_name,
       isodow(d) IN (6, 7) AS is_weekend
FROM days"""
)
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar over the span of the order dates."""
    span = read(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b")
    )
    days = span.select(F.explode(F.sequence("a", "b")).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


@query(
    f"""
WITH days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '{CALENDAR[0]}', TIMESTAMP '{CALENDAR[1]}',
                                                 INTERVAL 1 DAY)) AS DATE) AS d),
sold AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(strftime(days.d, '%Y%m%d') AS BIGINT) AS date_key, isodow(days.d) IN (6, 7) AS is_weekend,
       CAST(coalesce(sold.n, 0) AS BIGINT) AS orders
FROM days LEFT JOIN sold ON days.d = sold.d"""
)
def dim_date_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per calendar day, days without orders included."""
    per_day = roles.orders(spark, sf).groupBy(F.to_date("order_date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    joined = dates(spark).join(per_day, "full_date", "left")
    return joined.select("date_key", "is_weekend", F.coalesce("n", F.lit(0)).alias("orders"))


@query(
    with_ctes("customers")
    + """SELECT customer_id, name, email, phone, city, segment, CAST(join_date AS VARCHAR) AS join_date,
       CAST(_loaded_at AS VARCHAR) AS _loaded_at FROM customers"""
)
def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_customer(roles.customers(spark, sf))


@query(
    with_ctes("stores")
    + """SELECT store_id, store_name, city, CAST(opened_date AS VARCHAR) AS opened_date,
       CAST(_loaded_at AS VARCHAR) AS _loaded_at FROM stores"""
)
def dim_store(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_store(roles.stores(spark, sf))


@query(
    with_ctes("products", "categories", "dim_product")
    + """SELECT product_id, product_name, category_id, category_name, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(_loaded_at AS VARCHAR) AS _loaded_at FROM dim_product"""
)
def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_product(roles.products(spark, sf), roles.categories(spark, sf))


FACT_COLUMNS = """SELECT order_item_id, order_id, date_key, customer_id, product_id, store_id, payment_method,
       order_status, quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_amount AS DOUBLE) AS line_amount,
       CAST(_loaded_at AS VARCHAR) AS _loaded_at FROM fact_sales"""


@query(with_ctes(*FACT) + FACT_COLUMNS)
def fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf)


# Items of quantity 50 lose their quantity, small orders their customer, to exercise the filter.
@query(
    """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, count(*) AS items
FROM (SELECT l_orderkey, CASE WHEN l_quantity < 50 THEN l_quantity END AS q FROM lineitem) i
JOIN (SELECT o_orderkey, CASE WHEN o_totalprice >= 20000 THEN o_custkey END AS c FROM orders) o
  ON l_orderkey = o_orderkey
WHERE q IS NOT NULL AND c IS NOT NULL GROUP BY 1"""
)
def fact_complete_only(spark: SparkSession, sf: str) -> DataFrame:
    """Incomplete items and orders never reach the fact."""
    items = roles.order_items(spark, sf).withColumn(
        "quantity", F.when(F.col("quantity") < 50, F.col("quantity"))
    )
    small = read(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_totalprice").alias("_total")
    )
    heads = (
        roles.orders(spark, sf)
        .join(small, "order_id")
        .withColumn("customer_id", F.when(F.col("_total") >= 20000, F.col("customer_id")))
        .drop("_total")
    )
    return gold.fact_sales(items, heads).groupBy("order_id").agg(F.count(F.lit(1)).alias("items"))


@query(
    with_ctes(*FACT)
    + """SELECT order_status, count(*) AS items, CAST(sum(line_amount) AS DOUBLE) AS amount
FROM fact_sales WHERE order_status <> 'cancelled' GROUP BY order_status"""
)
def exclude_cancelled(spark: SparkSession, sf: str) -> DataFrame:
    return views.fulfilled(fact(spark, sf)).groupBy("order_status").agg(
        F.count(F.lit(1)).alias("items"), F.sum("line_amount").alias("amount")
    )


def _perturbed_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Products of quantity-50 lines are unknown, stores of quantity-49 lines are NULL."""
    return fact(spark, sf).withColumns(
        {
            "product_id": F.when(F.col("quantity") == 50, F.concat(F.lit("X"), "product_id")).otherwise(
                F.col("product_id")
            ),
            "store_id": F.when(F.col("quantity") != 49, F.col("store_id")),
        }
    )


def _references(spark: SparkSession, sf: str) -> dict:
    tables = star(spark, sf)
    # The calendar of this check ends with the century, so later sales break the date reference.
    tables["dim_date"] = gold.dim_date(spark, "1995-01-01", "1999-12-31")
    return gold.fact_references(tables)


PERTURBED = (
    with_ctes(*FACT)
    + """, f AS (SELECT order_item_id, date_key, customer_id,
       CASE WHEN quantity = 50 THEN 'X' || product_id ELSE product_id END AS product_id,
       CASE WHEN quantity <> 49 THEN store_id END AS store_id FROM fact_sales),
v AS (SELECT 'date_key' AS fk, CAST(date_key AS VARCHAR) AS key_value FROM f
      WHERE date_key NOT BETWEEN 19950101 AND 19991231
  UNION ALL SELECT 'product_id', product_id FROM f WHERE product_id NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)
  UNION ALL SELECT 'customer_id', customer_id FROM f
            WHERE customer_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
  UNION ALL SELECT 'store_id', store_id FROM f
            WHERE store_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier))
"""
)


@query(PERTURBED + "SELECT fk, key_value, count(*) AS row_count FROM v GROUP BY 1, 2")
def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    return reference_violations(_perturbed_fact(spark, sf), _references(spark, sf))


@query(
    PERTURBED
    + """SELECT order_item_id, product_id, store_id,
       (date_key NOT BETWEEN 19950101 AND 19991231)
       OR product_id NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part) AS held_back
FROM f"""
)
def fk_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Every fact row, marked by whether a broken reference holds it back."""
    flagged = flag_broken(_perturbed_fact(spark, sf), _references(spark, sf), "held_back")
    return flagged.select("order_item_id", "product_id", "store_id", "held_back")


# --- views ----------------------------------------------------------------------------------------

# Straight from the given tables: a line counts for its order unless that is cancelled ('F').
SOLD = """(
  SELECT orders.*, l_partkey, CAST(l_quantity AS BIGINT) AS units,
         CAST(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS amount
  FROM orders, lineitem WHERE o_orderkey = l_orderkey AND o_orderstatus IN ('O', 'P')) AS sold"""
V_STORE = f"""SELECT CAST(s_suppkey AS VARCHAR) AS store_id, any_value(s_name) AS store_name,
       'NATION_' || CAST(any_value(s_nationkey) AS VARCHAR) AS city, count(DISTINCT o_orderkey) AS order_count,
       CAST(sum(amount) AS DOUBLE) AS revenue
FROM supplier, {SOLD} WHERE s_suppkey = o_custkey // 15 GROUP BY s_suppkey"""
V_PRODUCT = f"""SELECT CAST(p_partkey AS VARCHAR) AS product_id, any_value(p_name) AS product_name,
       any_value(CASE WHEN p_size > 1 THEN upper(p_brand) END) AS category_name,
       CAST(sum(units) AS BIGINT) AS units_sold, CAST(sum(amount) AS DOUBLE) AS revenue
FROM part, {SOLD} WHERE p_partkey = l_partkey GROUP BY p_partkey"""
V_MONTH = f"""SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, any_value(monthname(o_orderdate)) AS month_name,
       CAST(sum(amount) AS DOUBLE) AS revenue, count(DISTINCT o_orderkey) AS order_count
FROM {SOLD} GROUP BY 1, 2"""
V_SEGMENT = f"""SELECT segment, count(*) AS customer_count, CAST(sum(spent) AS DOUBLE) AS revenue,
       round(CAST(sum(spent) AS DOUBLE) / sum(bought), 4) AS avg_order_value
FROM (SELECT c_custkey, c_mktsegment AS segment, sum(amount) AS spent, count(DISTINCT o_orderkey) AS bought
      FROM customer, {SOLD} WHERE c_custkey = o_custkey GROUP BY 1, 2) AS buyers GROUP BY segment"""
V_PAYMENT = f"""SELECT o_orderpriority AS payment_method, count(DISTINCT o_orderkey) AS order_count,
       CAST(sum(amount) AS DOUBLE) AS revenue FROM {SOLD} GROUP BY o_orderpriority"""


@query(V_STORE)
def revenue_by_store(spark: SparkSession, sf: str) -> DataFrame:
    return views.revenue_by_store(fact(spark, sf), roles.stores(spark, sf))


@query(V_PRODUCT)
def top_products(spark: SparkSession, sf: str) -> DataFrame:
    return views.top_products(fact(spark, sf), dim_product(spark, sf))


@query(V_MONTH)
def monthly_sales_trend(spark: SparkSession, sf: str) -> DataFrame:
    return views.monthly_sales_trend(fact(spark, sf), dates(spark))


@query(V_SEGMENT)
def segment_revenue(spark: SparkSession, sf: str) -> DataFrame:
    view = views.customer_segment_revenue(fact(spark, sf), roles.customers(spark, sf))
    return view.withColumn("avg_order_value", F.round("avg_order_value", 4))


@query(V_PAYMENT)
def payment_mix(spark: SparkSession, sf: str) -> DataFrame:
    return views.payment_method_mix(fact(spark, sf))


@query(
    f"""WITH a AS ({V_STORE}), b AS ({V_PRODUCT}), c AS ({V_MONTH}), d AS ({V_SEGMENT}), e AS ({V_PAYMENT})
SELECT 'vw_revenue_by_store' AS view_name, count(*) AS row_count, CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) AS revenue FROM a
UNION ALL SELECT 'vw_top_products', count(*), CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) FROM b
UNION ALL SELECT 'vw_monthly_sales_trend', count(*), CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) FROM c
UNION ALL SELECT 'vw_customer_segment_revenue', count(*), CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) FROM d
UNION ALL SELECT 'vw_payment_method_mix', count(*), CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) FROM e"""
)
def view_registry(spark: SparkSession, sf: str) -> DataFrame:
    """All views registered by name and fetched from the catalog: rows and total revenue of each."""
    views.create_views(star(spark, sf))
    parts = [
        spark.table(name).agg(
            F.lit(name).alias("view_name"), F.count(F.lit(1)).alias("row_count"), F.sum("revenue").alias("revenue")
        )
        for name in views.VIEW_NAMES
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- report ---------------------------------------------------------------------------------------


@query(f"SELECT store_name, revenue FROM ({V_STORE})")
def store_revenue_chart(spark: SparkSession, sf: str) -> DataFrame:
    return report.store_revenue(revenue_by_store(spark, sf))


@query(
    f"SELECT product_id, product_name, revenue FROM ({V_PRODUCT}) ORDER BY revenue DESC, product_id LIMIT 10"
)
def top10_products(spark: SparkSession, sf: str) -> DataFrame:
    return report.best_products(top_products(spark, sf))


@query(
    f"SELECT CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS label, revenue FROM ({V_MONTH})"
)
def month_label(spark: SparkSession, sf: str) -> DataFrame:
    return report.monthly_trend(monthly_sales_trend(spark, sf))


@query(f"SELECT segment, revenue FROM ({V_SEGMENT})")
def segment_revenue_chart(spark: SparkSession, sf: str) -> DataFrame:
    return report.segment_revenue(segment_revenue(spark, sf))


@query(
    f"""SELECT payment_method, revenue, round(100 * revenue / sum(revenue) OVER (), 1) AS share_pct
FROM ({V_PAYMENT})"""
)
def payment_share_pct(spark: SparkSession, sf: str) -> DataFrame:
    return report.payment_share(payment_mix(spark, sf))


@query(
    f"SELECT store_id, store_name, city, CAST(order_count AS BIGINT) AS order_count, revenue FROM ({V_STORE})"
)
def report_export(spark: SparkSession, sf: str) -> DataFrame:
    """All views written as files; the store report read back."""
    paths = report.export_views(views.all_views(star(spark, sf)), fresh_dir(spark, "report"))
    layout = "store_id string, store_name string, city string, order_count bigint, revenue double"
    return spark.read.schema(layout).option("header", True).csv(paths["Revenue by Store"])
