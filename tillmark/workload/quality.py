"""Data-quality detectors over the given tables.

Faults the tables carry are used as they are (negative balances, shipping before ordering, repeated line
numbers); the others are made by changing values under a condition on another column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators import quality as q
from tillmark.workload import roles
from tillmark.workload.cleaning import with_comma
from tillmark.workload.registry import ORACLE, query
from tillmark.workload.roles import FACT, money, read, with_ctes
from tillmark.workload.state import AS_OF, list_prices, sold_items

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_KEY = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def finding(table: str, rule: str, key: str, detail: str, rest: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, CAST({key} AS VARCHAR) AS record_key,\n"
        f"  CAST({detail} AS VARCHAR) AS detail {rest}"
    )


@query(finding("products", "missing_value", "p_partkey", "'category_id'", "FROM part WHERE p_size = 1"))
def dq_missing_value(spark: SparkSession, sf: str) -> DataFrame:
    return q.matching(roles.products(spark, sf), "products", ["product_id"], q.missing_value("category_id"))


@query(finding("customers", "padded_text", "c_custkey", "'name'", "FROM customer WHERE c_nationkey IN (3, 4)"))
def dq_padded_text(spark: SparkSession, sf: str) -> DataFrame:
    name = (
        F.when(F.col("c_nationkey") == 3, F.concat(F.lit("  "), "c_name"))
        .when(F.col("c_nationkey") == 4, F.concat("c_name", F.lit("\t")))
        .otherwise(F.col("c_name"))
    )
    rows = read(spark, sf, "customer").withColumn("name", name)
    return q.matching(rows, "customers", ["c_custkey"], q.padded_text("name"))


@query(
    finding(
        "customers",
        "inconsistent_case",
        "lower(city)",
        "count(DISTINCT city)",
        """FROM (SELECT CASE WHEN c_acctbal < 0 THEN 'nation_' ELSE 'NATION_' END || CAST(c_nationkey AS VARCHAR)
             || CASE WHEN c_acctbal > 9990 THEN ' Nord' ELSE '' END AS city FROM customer)
  GROUP BY lower(city) HAVING count(DISTINCT city) > 1""",
    )
)
def dq_inconsistent_case(spark: SparkSession, sf: str) -> DataFrame:
    word = F.when(F.col("c_acctbal") < 0, "nation_").otherwise("NATION_")
    suffix = F.when(F.col("c_acctbal") > 9990, " Nord").otherwise("")
    rows = read(spark, sf, "customer").select(F.concat(word, "c_nationkey", suffix).alias("city"))
    return q.inconsistent_case(rows, "customers", "city")


@query(
    finding(
        "order_items",
        "duplicate_row",
        "l_orderkey || '|' || l_linenumber",
        "count(*)",
        "FROM lineitem GROUP BY l_orderkey, l_linenumber, l_returnflag, l_linestatus HAVING count(*) > 1",
    )
)
def dq_duplicate_row(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    return q.duplicate_rows(read(spark, sf, "lineitem"), "order_items", columns[:2], columns)


@query(
    finding(
        "order_items",
        "number_format",
        LINE_KEY,
        "CASE WHEN l_quantity = 13 THEN 'unreadable' ELSE 'decimal_comma' END",
        "FROM lineitem WHERE l_quantity = 13 OR l_discount > 0.05",
    )
)
def dq_number_format(spark: SparkSession, sf: str) -> DataFrame:
    price = (
        F.when(F.col("l_quantity") == 13, "n/a")
        .when(F.col("l_discount") > 0.05, with_comma("l_extendedprice"))
        .otherwise(F.col("l_extendedprice").cast("string"))
    )
    rows = read(spark, sf, "lineitem").withColumn("price", price)
    return q.matching(rows, "order_items", LINE, q.number_format("price"))


@query(
    finding("customers", "not_positive", "c_custkey", "'negative'", "FROM customer WHERE c_acctbal < 0")
    + "\nUNION ALL "
    + finding("order_items", "not_positive", LINE_KEY, "'zero'", "FROM lineitem WHERE l_tax = 0")
)
def dq_not_positive(spark: SparkSession, sf: str) -> DataFrame:
    """Balances may be zero but not negative; taxes must be positive."""
    balance, tax = q.not_positive("c_acctbal", zero_ok=True), q.not_positive("l_tax")
    return q.matching(read(spark, sf, "customer"), "customers", ["c_custkey"], balance).unionByName(
        q.matching(read(spark, sf, "lineitem"), "order_items", LINE, tax)
    )


@query(
    finding("order_items", "out_of_bounds", LINE_KEY, "'l_quantity'", "FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45")
)
def dq_out_of_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return q.matching(read(spark, sf, "lineitem"), "order_items", LINE, q.out_of_bounds("l_quantity", 5, 45))


@query(
    finding(
        "orders", "date_format", "o_orderkey", "strftime(o_orderdate, '%d/%m/%Y')",
        "FROM orders WHERE o_orderpriority = '1-URGENT'",
    )
)
def dq_date_format(spark: SparkSession, sf: str) -> DataFrame:
    day = F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    rows = read(spark, sf, "orders").withColumn("day", day)
    return q.matching(rows, "orders", ["o_orderkey"], q.date_format_mix("day"))


@query(
    finding("orders", "unknown_value", "o_orderkey", "o_orderstatus", "FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
)
def dq_unknown_value(spark: SparkSession, sf: str) -> DataFrame:
    return q.matching(read(spark, sf, "orders"), "orders", ["o_orderkey"], q.unknown_value("o_orderstatus", ["O", "F"]))


@query(
    finding("order_items", "orphan_reference", LINE_KEY, "'X' || l_partkey", "FROM lineitem WHERE l_quantity = 50")
)
def dq_orphan_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of quantity 50 refer to parts that do not exist, those of quantity 49 to none."""
    part = F.col("l_partkey").cast("string")
    product = (
        F.when(F.col("l_quantity") == 50, F.concat(F.lit("X"), part)).when(F.col("l_quantity") != 49, part)
    )
    rows = read(spark, sf, "lineitem").withColumn("product_id", product)
    return q.orphan_reference(rows, "order_items", LINE, "product_id", roles.products(spark, sf), "product_id")


@query(
    finding(
        "shipments", "wrong_order", LINE_KEY, "l_shipdate",
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate",
    )
)
def dq_wrong_order(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    rows = read(spark, sf, "lineitem").join(orders, "l_orderkey")
    return q.matching(rows, "shipments", LINE, q.wrong_order(F.col("o_orderdate"), F.col("l_shipdate")))


@query(
    """WITH p AS (SELECT CAST(event_id AS VARCHAR) AS k, date_trunc('minute', ts) AS s,
    date_trunc('minute', ts) + to_seconds(CAST(floor(value * 5) AS BIGINT)) AS e FROM events),
r AS (SELECT *, max(e) OVER (ORDER BY s, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p)
"""
    + finding("promotions", "overlapping_period", "k", "s", "FROM r WHERE reach >= s")
)
def dq_overlapping_period(spark: SparkSession, sf: str) -> DataFrame:
    """Events as periods: from their minute on, for five seconds per unit of value."""
    seconds = F.floor(F.col("value") * 5).cast("bigint")
    start = F.date_trunc("minute", "ts")
    rows = read(spark, sf, "events").select(
        "event_id",
        start.alias("start_date"),
        F.timestamp_add("SECOND", seconds.cast("int"), start).alias("end_date"),
    )
    return q.overlapping_periods(rows, "promotions", ["event_id"], "start_date", "end_date")


PAYMENTS = (
    with_ctes(*FACT)
    + """, t AS (SELECT order_id, sum(line_amount) AS total FROM fact_sales GROUP BY 1)
"""
)


def order_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Payments as they should be: one per order, over the sum of its items."""
    return roles.order_items(spark, sf).groupBy("order_id").agg(
        F.sum((F.col("quantity") * F.col("unit_price")).cast("decimal(18,4)")).alias("total")
    )


@query(
    PAYMENTS
    + finding(
        "payments", "amount_mismatch", "order_id", "CAST(total AS DECIMAL(38,4))",
        "FROM t JOIN retail_orders USING (order_id) WHERE payment_method = '1-URGENT'",
    )
)
def dq_amount_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """Payments of urgent orders are one off the sum of their items."""
    urgent = F.col("payment_method") == "1-URGENT"
    payments = (
        order_totals(spark, sf)
        .join(roles.orders(spark, sf), "order_id")
        .select("order_id", F.when(urgent, F.col("total") - 1).otherwise(F.col("total")).alias("amount"))
    )
    amount = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,4)")
    found = q.amount_mismatch(
        payments, "payments", ["order_id"], "order_id", "amount", roles.order_items(spark, sf), "order_id", amount
    )
    return found


@query(
    PAYMENTS
    + finding(
        "loyalty_points", "points_mismatch", "order_id", "CAST(floor(total / 10000) AS BIGINT)",
        "FROM t JOIN retail_orders USING (order_id) WHERE status = 'cancelled' AND floor(total / 10000) <> 0",
    )
)
def dq_points_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """Cancelled orders earned nothing, the others one point per full ten thousand."""
    earned = F.when(F.col("status") == "cancelled", F.lit(0)).otherwise(F.floor(F.col("total") / 10000))
    points = order_totals(spark, sf).join(roles.orders(spark, sf), "order_id").select("order_id", earned.alias("earned"))
    amount = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,4)")
    return q.points_mismatch(
        points, "loyalty_points", ["order_id"], "order_id", "earned", roles.order_items(spark, sf), "order_id", amount,
        10000,
    )


@query(AS_OF + finding("order_items", "price_drift", LINE_KEY, "list_price", "FROM priced WHERE price <> list_price"))
def dq_price_drift(spark: SparkSession, sf: str) -> DataFrame:
    return q.price_drift(
        sold_items(spark, sf),
        "order_items",
        LINE,
        "l_partkey",
        "price",
        "o_orderdate",
        list_prices(spark, sf).withColumnRenamed("l_shipdate", "valid_from"),
        "list_price",
        "valid_from",
    )


@query(
    finding(
        "product_suppliers", "cost_ratio", LINE_KEY, "CAST(p_retailprice AS DECIMAL(18,4))",
        """FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE NOT CAST(l_extendedprice AS DECIMAL(18,4)) BETWEEN 50 * CAST(p_retailprice AS DECIMAL(18,4))
        AND 80 * CAST(p_retailprice AS DECIMAL(18,4))""",
    )
)
def dq_cost_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """A hundredth of the line price as cost, to lie between half and four fifths of the list price."""
    costs = read(spark, sf, "lineitem").select(
        *LINE, (money("l_extendedprice") / 100).alias("cost_price")
    )
    parts = read(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), money("p_retailprice").alias("unit_price")
    )
    return q.cost_ratio(
        costs, "product_suppliers", LINE, "l_partkey", "cost_price", parts, "unit_price", "0.50", "0.80"
    )


@query(
    "SELECT table_name, rule, count(*) AS findings FROM (\n"
    + "\nUNION ALL ".join(
        [
            finding("order_items", "out_of_bounds", "1", "1", "FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45"),
            finding("order_items", "not_positive", "1", "1", "FROM lineitem WHERE l_tax = 0"),
            finding("order_items", "unknown_value", "1", "1", "FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')"),
            ORACLE["dq_missing_value"],
            ORACLE["dq_unknown_value"],
            ORACLE["dq_orphan_reference"],
        ]
    )
    + ") GROUP BY 1, 2"
)
def dq_findings_per_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Several rules checked in one pass over the lines, joined by other detectors, counted per rule."""
    lines = q.check_rows(
        read(spark, sf, "lineitem"),
        "order_items",
        LINE,
        [q.out_of_bounds("l_quantity", 5, 45), q.not_positive("l_tax"), q.unknown_value("l_returnflag", ["A", "N"])],
    )
    others = [detect(spark, sf) for detect in (dq_missing_value, dq_unknown_value, dq_orphan_reference)]
    return q.findings_per_rule(reduce(DataFrame.unionByName, [lines, *others]))
