"""Report frames on top of the views, and their export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions.calendar import month_label

# Titles of the exported tables, in report order.
TITLES = {
    "vw_revenue_by_store": "Revenue by Store",
    "vw_top_products": "Top Products",
    "vw_monthly_sales_trend": "Monthly Sales Trend",
    "vw_customer_segment_revenue": "Revenue by Customer Segment",
    "vw_payment_method_mix": "Payment Method Mix",
}


def store_revenue(view: DataFrame) -> DataFrame:
    return view.select("store_name", "revenue")


def best_products(view: DataFrame, n: int = 10) -> DataFrame:
    """The n products with the most revenue, weakest first as a horizontal bar chart lists them."""
    ranked = view.orderBy(F.desc_nulls_first("revenue"), "product_id").limit(n)
    return ranked.orderBy(F.asc_nulls_last("revenue"), F.desc("product_id")).select(
        "product_id", "product_name", "revenue"
    )


def monthly_trend(view: DataFrame) -> DataFrame:
    return view.select(month_label(F.col("year"), F.col("month")).alias("label"), "revenue")


def segment_revenue(view: DataFrame) -> DataFrame:
    return view.select("segment", "revenue")


def payment_share(view: DataFrame) -> DataFrame:
    """Share of total revenue in percent with one digit. The view has one row per payment method."""
    total = F.sum("revenue").over(Window.partitionBy())
    share = F.col("revenue") * 100 / F.nullif(total, F.lit(0))
    return view.select("payment_method", "revenue", F.round(share, 1).alias("share_pct"))


def export_views(views: Mapping[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write each view as CSV with a header, one folder per view; an empty view leaves just the header.

    The views have one row per store, product, month, segment or method. Returns title to path.
    """
    written = {}
    for name, title in TITLES.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        views[name].write.mode("overwrite").option("header", True).csv(path)
        written[title] = path
    return written
