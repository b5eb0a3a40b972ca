"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams by language give a matrix of log probabilities (buckets x languages), which is broadcast; a batch of
texts is scored by gathering the rows of its n-grams and adding them up text by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.pieces import forget, released

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
# Labelled rows that training reads for each language at most; they are those of smallest hash of doc_id.
SAMPLE_ROWS = 2000
UNKNOWN = "und"
# Code points scored at once.
CHUNK = 1 << 18

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@dataclass
class Model:
    languages: list[str]
    log_probs: np.ndarray  # buckets x languages
    prior: np.ndarray  # of each language


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased texts, each with blanks around it and for anything below the letters; their ends."""
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((codes >= 97) & (codes <= 122)) | (codes >= 192)
    return np.where(letter, codes, np.uint32(32)), np.cumsum([len(p) for p in padded])


def _hashes(codes: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that ends at each place; the first ones of all reach back to the start only."""
    mixed = codes * _FACTORS[0]
    for back in range(1, order):
        mixed[back:] ^= (codes[:-back] + np.uint32(back)) * _FACTORS[back]
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D) + np.uint32(2 * order)
    return (mixed >> np.uint32(7)) & np.uint32(buckets - 1)


def _features(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the buckets of all n-grams inside the texts, and where those of each text start.

    A text of n code points has n + 2 with its blanks, and n + 3 - order n-grams; what crosses into it is left out by
    starting later.
    """
    codes, ends = _codes(texts)
    starts = np.append(0, ends[:-1])
    for order in ORDERS:
        hashed = _hashes(codes, order, buckets)
        inside = np.ones(len(codes), bool)
        for back in range(order - 1):
            inside[starts + back] = False
        kept = np.cumsum(inside)
        firsts = np.append(0, kept[ends[:-1] - 1]) if len(ends) > 1 else np.array([0])
        yield hashed[inside], firsts


def _chunks(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 2
    if start < len(texts):
        yield start, len(texts)


def count_ngrams(texts: list[str], buckets: int = BUCKETS) -> np.ndarray:
    counts = np.zeros(buckets, np.int64)
    for a, b in _chunks(texts):
        for hashed, _ in _features(texts[a:b], buckets):
            counts += np.bincount(hashed, minlength=buckets)
    return counts


def log_scores(texts: list[str], model: Model) -> np.ndarray:
    """Log joint probability of each text and language; texts must not be empty of code points."""
    out = np.empty((len(texts), len(model.languages)))
    limit = max(1 << 12, 4 * CHUNK // max(4, len(model.languages)))
    for a, b in _chunks(texts, limit):
        total = np.tile(model.prior, (b - a, 1))
        for hashed, firsts in _features(texts[a:b], len(model.log_probs)):
            for k in range(len(model.languages)):
                total[:, k] += np.add.reduceat(model.log_probs[:, k][hashed], firsts)
        out[a:b] = total
    return out


def fit(
    docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS, buckets: int = BUCKETS, smoothing: float = 0.5
) -> Model:
    """Learn from rows where `learn` holds and lang is given: `rows` of each language at most, of smallest hash.

    Texts that are null or have no letter teach nothing. The counts are added up by Spark; buckets x languages of them
    come to the driver. Without any labelled row the model knows no language.
    """
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").alias("_lang"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("_hash")
    )
    sizes = {r[0]: r[1] for r in labelled.groupBy("_lang").count().collect()}
    # A row is in if its hash is below the share of rows wanted; the share is all where there are few.
    share = {lang: min(1.0, rows / n) for lang, n in sizes.items()}
    wanted = F.lit(False)
    for lang, part in share.items():
        wanted = wanted | ((F.col("_lang") == lang) & (F.col("_hash") < int(part * (1 << 40))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        totals: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in released(batches):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(text):
                    by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                totals[lang] = totals.get(lang, 0) + count_ngrams(own, buckets)
                texts[lang] = texts.get(lang, 0) + len(own)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            # Bucket -1 counts the texts.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(at) + 1), pa.string()),
                    pa.array(np.append(at, -1), pa.int64()),
                    pa.array(np.append(counts[at], texts[lang]), pa.int64()),
                ],
                ["lang", "bucket", "n"],
            )

    counted = labelled.where(wanted).select("_lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((buckets, len(languages)))
    for k, lang in enumerate(languages):
        own = found[(found["lang"] == lang) & (found["bucket"] >= 0)]
        counts[own["bucket"].to_numpy(np.int64), k] = own["n"].to_numpy(np.float64)
    smoothed = counts + smoothing
    # All labelled rows, not only those sampled, say how frequent a language is.
    prior = np.array([sizes[lang] for lang in languages], float)
    return Model(languages, np.log(smoothed / smoothed.sum(axis=0)), np.log(prior / prior.sum() if len(prior) else prior))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred and score (posterior probability) to every row, from its whole text alone.

    Null texts and those without a letter are `und` with score 0, as is every text if the model knows no language.
    Ties go to the first language by name. Columns of these names are replaced, all others kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        known = shared.value
        for batch in released(batches):
            texts = batch.to_pylist()
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            rows = [i for i, t in enumerate(texts) if t and known.languages and has_letter(t)]
            if rows:
                logs = log_scores([texts[i] for i in rows], known)
                best = logs.argmax(axis=1)
                odds = np.exp(logs - logs.max(axis=1, keepdims=True))
                score[rows] = odds.max(axis=1) / odds.sum(axis=1)
                for i, k in zip(rows, best.tolist()):
                    lang[i] = known.languages[k]
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"]
            )

    guessed = docs.withColumn("_guess", guess(F.col(f"`{text}`")))
    return guessed.withColumns({"lang_pred": F.col("_guess.lang_pred"), "score": F.col("_guess.score")}).drop("_guess")
