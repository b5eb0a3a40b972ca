"""Query of the toxicity scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.registry import query, table
from tillmark.llm.toxicity import THRESHOLD, fit, score_documents


def held_out() -> Column:
    """Never null: a row without a doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    scored = score_documents(docs, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"),
    )
