"""Query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark.llm.decontaminate import find_items
from tillmark.llm.registry import query, table

SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM documents
), item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM benchmark
), item AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS width,
         unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2),
                               lambda i: array_to_string(w[i:i + least(5, len(w)) - 1], ' '))) AS shingle
  FROM item_words WHERE len(w) > 0
), sizes AS (SELECT item_id, count(*) AS n FROM item GROUP BY item_id),
widths AS (SELECT DISTINCT width FROM item),
doc AS (
  SELECT DISTINCT doc_id, width,
         unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' ')))
           AS shingle
  FROM words, widths WHERE len(w) >= width
), shared AS (
  SELECT doc_id, item_id, count(*) AS shared FROM doc JOIN item USING (width, shingle) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n AS item_shingles, shared, shared / CAST(n AS DOUBLE) AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * shared >= 75 * n
"""


@query(SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
