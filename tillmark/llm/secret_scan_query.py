"""Query of the secret scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.registry import query, table
from tillmark.llm.secret_scan import BASE_KINDS, scan_documents


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


@query()
def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    number = [F.size(F.filter("secrets", _is(kind))).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *number,
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
    )
