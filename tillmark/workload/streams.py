"""Streaming forms of the detectors over the given tables, written as files that arrive in turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.session import fresh_dir
from tillmark.streaming.orphans import late_orphans, report_available
from tillmark.workload.registry import query
from tillmark.workload.roles import read

# Shipments and orders arrive in four rounds; the orders of a span of time come a round after its shipments.
SPANS = ("1990-01-01", "1994-06-01", "1996-09-01", "2010-01-01")


def _within(column: str, number: int) -> Column:
    low, high = (F.lit(d).cast("timestamp_ltz") for d in SPANS[number : number + 2])
    return (F.col(column) >= low) & (F.col(column) < high)


@query(
    """SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_shipdate AS VARCHAR) AS shipped, count(*) AS shipments
FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority <> '1-URGENT'
    AND o_orderdate BETWEEN l_shipdate - INTERVAL 90 DAY AND l_shipdate + INTERVAL 10 DAY) GROUP BY 1, 2"""
)
def orphans_of_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments whose order never comes (urgent ones are left out) or lies out of bounds; orders come after them."""
    base = fresh_dir(spark, "orphans")
    shipped = read(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("order_id"), F.col("l_shipdate").cast("timestamp_ltz").alias("shipped")
    )
    ordered = read(spark, sf, "orders").where("o_orderpriority <> '1-URGENT'").select(
        F.col("o_orderkey").cast("long").alias("order_id"), F.col("o_orderdate").cast("timestamp_ltz").alias("ordered")
    )
    # A row far ahead on both sides moves the watermark past everything else.
    last = spark.range(1).select(F.lit(-1).cast("long").alias("order_id"), F.lit("2200-01-01").cast("timestamp_ltz").alias("at"))
    for number in range(len(SPANS)):
        if number < len(SPANS) - 1:
            shipped.where(_within("shipped", number)).write.mode("append").parquet(f"{base}/shipments")
        else:
            last.toDF("order_id", "shipped").write.mode("append").parquet(f"{base}/shipments")
        orders = ordered.where(_within("ordered", number - 1)) if number else ordered.limit(0)
        if number == len(SPANS) - 1:
            orders = orders.unionByName(last.toDF("order_id", "ordered"))
        orders.write.mode("append").parquet(f"{base}/orders")
        streams = [
            spark.readStream.schema(df.schema).parquet(f"{base}/{name}") for df, name in ((shipped, "shipments"), (ordered, "orders"))
        ]
        found = late_orphans(
            *streams, "order_id", "order_id", "shipped", "ordered", before="90 DAYS", after="10 DAYS", delay="1 DAY"
        )
        report_available(found, f"{base}/found", f"{base}/checkpoint")
    found = spark.read.schema(shipped.schema).parquet(f"{base}/found")
    return found.groupBy("order_id", F.col("shipped").cast("timestamp_ntz").alias("shipped")).agg(
        F.count(F.lit(1)).alias("shipments")
    )
