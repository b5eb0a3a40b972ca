"""Query of the document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark.llm.fingerprint import compare_neighbours, corpus_ranks
from tillmark.llm.registry import query, table


@query()
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compare_neighbours(docs, corpus_ranks(docs))
