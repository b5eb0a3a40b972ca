"""Query of the similarity join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark.llm.jaccard import near_duplicates
from tillmark.llm.registry import query, table


@query()
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
