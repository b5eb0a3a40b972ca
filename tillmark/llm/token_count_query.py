"""Query of the token counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillmark.llm.registry import query, table
from tillmark.llm.token_count import count_tokens

TOKENIZER = "word_bpe_49k.json"


@query()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path(TOKENIZER))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")
