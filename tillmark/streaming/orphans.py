"""Broken references between streams: a row counts as an orphan only when its parent has not come within a bound.

In a stream a shipment may well arrive before its order. Both sides carry event times with watermarks, and a left outer
stream-stream join keeps a row until no parent can match it any more: the state holds only what lies within the bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def late_orphans(
    children: DataFrame, parents: DataFrame, fk: str, pk: str, time: str, parent_time: str,
    before: str, after: str, delay: str,
) -> DataFrame:
    """The children (a stream) without a parent whose time lies from `before` their own to `after` it.

    `before`, `after` and `delay` are intervals; rows that come later than `delay` behind the newest of their stream may
    be missed. A NULL key refers to nothing and is no orphan. Each orphan comes out once, when the watermark of both
    streams has passed its bound.
    """
    left = children.where(F.col(fk).isNotNull()).withWatermark(time, delay)
    right = parents.select(F.col(pk).alias("_pk"), F.col(parent_time).alias("_parent_time")).withWatermark("_parent_time", delay)
    near = F.expr(f"_parent_time >= {time} - INTERVAL {before} AND _parent_time <= {time} + INTERVAL {after}")
    joined = left.join(right, (F.col(fk) == F.col("_pk")) & near, "left_outer")
    return joined.where(F.col("_pk").isNull()).drop("_pk", "_parent_time")


def report_available(orphans: DataFrame, path: str, checkpoint: str) -> None:
    """Append to a folder the orphans that the arrived rows make certain, then stop."""
    stream: StreamingQuery = (
        orphans.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    stream.awaitTermination()
