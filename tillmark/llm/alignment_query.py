"""Query of the alignment of two tokenizers."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillmark.llm.alignment import alignments
from tillmark.llm.registry import query, table

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignments(docs, public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))
