"""Query of the packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.packing import pack_documents
from tillmark.llm.registry import query, table

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 2048


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of documents with the digest of their ids."""
    pieces = pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID, CAPACITY)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.element_at("crcs", (F.col("cut") + 1).cast("int")).alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
