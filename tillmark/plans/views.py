"""The five analysis queries over the star schema. Cancelled orders never count as revenue.

Facts are aggregated on their own key before a dimension is joined wherever the dimension's key decides
the group, so the join sees one row per key instead of one per sale.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the status that marks an order as not fulfilled.
CANCELLED = "cancelled"


def fulfilled(fact: DataFrame) -> DataFrame:
    """Sales of orders not cancelled; an unknown (NULL) status is left out too."""
    return fact.where(F.col("order_status") != CANCELLED)


def _revenue_first(df: DataFrame, *tie_break: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_first("revenue"), *tie_break)


def revenue_by_store(fact: DataFrame, stores: DataFrame) -> DataFrame:
    per_store = fulfilled(fact).groupBy("store_id").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("line_amount").alias("revenue")
    )
    joined = stores.select("store_id", "store_name", "city").join(per_store, "store_id")
    return _revenue_first(joined, "store_id")


def top_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_product = fulfilled(fact).groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"), F.sum("line_amount").alias("revenue")
    )
    joined = products.select("product_id", "product_name", "category_name").join(per_product, "product_id")
    return _revenue_first(joined, "product_id")


def monthly_sales_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    # The calendar has a fixed number of days, so it can always be broadcast: no exchange for this join.
    months = F.broadcast(dates.select("date_key", "year", "month", "month_name"))
    return (
        fulfilled(fact)
        .join(months, "date_key")
        .groupBy("year", "month", "month_name")
        .agg(F.sum("line_amount").alias("revenue"), F.count_distinct("order_id").alias("order_count"))
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
    )


def customer_segment_revenue(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Two distinct counts in one group triple their input, so sales are first summed per order and customer."""
    per_order = fulfilled(fact).groupBy("customer_id", "order_id").agg(F.sum("line_amount").alias("amount"))
    per_segment = (
        per_order.join(customers.select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            F.sum("amount").alias("revenue"),
            F.count_distinct("order_id").alias("_orders"),
        )
    )
    # Narrowed so that the quotient keeps 14 digits behind the point.
    ratio = F.col("revenue").cast("decimal(28,4)") / F.nullif(F.col("_orders"), F.lit(0))
    return _revenue_first(per_segment.withColumn("avg_order_value", ratio).drop("_orders"), "segment")


def payment_method_mix(fact: DataFrame) -> DataFrame:
    per_method = fulfilled(fact).groupBy("payment_method").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("line_amount").alias("revenue")
    )
    return _revenue_first(per_method, "payment_method")


def all_views(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The views by name, over {dim_date, dim_customer, dim_store, dim_product, fact_sales}."""
    fact = star["fact_sales"]
    return {
        "vw_revenue_by_store": revenue_by_store(fact, star["dim_store"]),
        "vw_top_products": top_products(fact, star["dim_product"]),
        "vw_monthly_sales_trend": monthly_sales_trend(fact, star["dim_date"]),
        "vw_customer_segment_revenue": customer_segment_revenue(fact, star["dim_customer"]),
        "vw_payment_method_mix": payment_method_mix(fact),
    }


VIEW_NAMES = (
    "vw_revenue_by_store",
    "vw_top_products",
    "vw_monthly_sales_trend",
    "vw_customer_segment_revenue",
    "vw_payment_method_mix",
)


def register(found: Mapping[str, DataFrame]) -> None:
    for name, df in found.items():
        df.createOrReplaceTempView(name)


def create_views(star: Mapping[str, DataFrame]) -> None:
    register(all_views(star))
