"""Query of the near duplicates by SuperMinHash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark.llm.registry import query, table
from tillmark.llm.superminhash import near_duplicates


@query()
def op11_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
