"""Query of the binary token files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillmark.llm.registry import query, table
from tillmark.llm.token_files import read_digests, write_tokens
from tillmark.session import fresh_dir

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0


@query()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID, null_ids=True)
    return read_digests(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
