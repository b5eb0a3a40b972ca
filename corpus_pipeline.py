"""From raw documents to packed training sequences.

Language identification drops documents without a language, the similarity join keeps one document of each group of
near duplicates, decontamination drops documents that hold benchmark items, the secret scan blacks out secrets, and
packing gives the pieces of the training sequences. Each stage takes (spark, docs, sf_dir); run() writes what a stage
returns to the shared folder and hands the written table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.decontaminate import without_items
from tillmark.llm.jaccard import keep_one
from tillmark.llm.language import UNKNOWN, fit, predict
from tillmark.llm.language_query import held_out
from tillmark.llm.packing_query import packed
from tillmark.llm.registry import prepare, table, written
from tillmark.llm.secret_scan import redact_documents
from tillmark.session import fresh_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; those without text or without any letter have none and go.

    `lang` becomes the language found. The model learns from the labelled documents of the table itself.
    """
    prepare(spark)
    model = fit(docs, ~held_out())
    found = predict(docs, model).where(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest doc_id, of each group of near duplicates."""
    prepare(spark)
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, each row judged by its own text."""
    prepare(spark)
    return without_items(docs, table(spark, sf_dir, "benchmark"), by_row=True)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the values of their secrets replaced."""
    prepare(spark)
    return redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    prepare(spark)
    return packed(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

# Naive Bayes and a tokenizer's merges are beyond SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    path = fresh_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{path}/{number}-{name}")
    return docs
