"""Connected components of links, by alternating stars.

Each round hangs the larger neighbours of a node on the smallest one around it, then the smaller ones; the links turn
into stars around the smallest node of each component within a number of rounds logarithmic in its size. Rounds are
written to the shared folder, so that plans stay short and a lost executor costs only a read.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.registry import written
from tillmark.session import fresh_dir


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component), for every node that has a link to another.

    links: two columns of longs. Null ends and links of a node to itself are no links; repeated ones count once.
    """
    a, b = links.columns
    path = fresh_dir(links.sparkSession, "components")
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b"))
    )
    edges, seen = written(edges.distinct(), f"{path}/0"), None
    for number in count(1):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy("a").agg(F.min("b").alias("_least"))
        around = around.select("a", F.least("a", "_least").alias("_least"))
        large = both.join(around, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_least").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        below = large.groupBy("a").agg(F.min("b").alias("_least"))
        small = large.join(below, "a")
        small = small.select(F.col("b").alias("a"), F.col("_least").alias("b")).where(F.col("a") != F.col("b"))
        edges = written(small.unionByName(below.toDF("a", "b")).distinct(), f"{path}/{number}")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
