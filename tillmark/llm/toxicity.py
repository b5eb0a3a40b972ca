"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability from the words in it, and the document is toxic if
any of its sentences is: the probabilities are combined by noisy-or, 1 - product(1 - p). Only documents are labelled;
the gradient of the combined probability teaches the sentences, which afterwards tell where a document offends.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.pieces import Memory

# Labelled documents that training reads of each class at most; they are those of smallest hash of doc_id.
SAMPLE_ROWS = 1500
BUCKETS = 1 << 18
# First letters of a word that are features of their own, for words that share a stem.
PREFIXES = (3, 4, 5)
# A feature must occur in so many different sentences, and be more frequent in sentences of toxic documents by so many
# standard errors. Copies of a sentence count once: they say nothing new about its words.
LEAST_SENTENCES = 5
LEAST_ERRORS = 3.0
STEPS = 250
PENALTY = 0.03
THRESHOLD = 0.7

_SENTENCE = re.compile(r"[^.!?\n]+")
_EDGES = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "«»“”‘’„…–—¿¡"


def features(token: str) -> list[int]:
    """Buckets of a token's word and of its first letters; none if it has no word."""
    word = token.strip(_EDGES).lower()
    if not word:
        return []
    parts = [word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]
    return [xxhash.xxh32_intdigest(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


@dataclass
class Model:
    weights: dict[int, float]  # by bucket of a feature; absent ones weigh nothing
    bias: float


def _telling(words: np.ndarray, word_sentence: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Features that different sentences of toxic documents hold more often than those of others."""
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    starts = np.flatnonzero(np.diff(word_sentence, prepend=-1))
    _, first = np.unique(np.add.reduceat(mixed * np.uint64(0xBF58476D1CE4E5B9), starts), return_index=True)
    different = np.zeros(len(label), bool)
    different[word_sentence[starts[first]]] = True
    often = np.bincount(words, minlength=BUCKETS) >= LEAST_SENTENCES
    use = different[word_sentence] & often[words]
    pairs = np.unique(word_sentence[use].astype(np.int64) * BUCKETS + words[use])
    toxic = label[pairs // BUCKETS] == 1
    ones = np.bincount(pairs[toxic] % BUCKETS, minlength=BUCKETS)
    zeros = np.bincount(pairs[~toxic] % BUCKETS, minlength=BUCKETS)
    n1, n0 = max(1, (different & (label == 1)).sum()), max(1, (different & (label == 0)).sum())
    rate = (ones + zeros) / (n1 + n0)
    error = np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / n1 + 1 / n0))
    return np.flatnonzero((ones + zeros >= LEAST_SENTENCES) & (ones / n1 - zeros / n0 > LEAST_ERRORS * error))


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, share: np.ndarray) -> Model:
    """Fit feature weights to labelled bags by gradient steps on the log loss of noisy-or, with an L1 penalty.

    docs: for each document the buckets of its features and the number of them in each sentence.
    share: what each document counts for in the loss.
    """
    if not docs or labels.min() == labels.max():
        return Model({}, 12.0 if len(labels) and labels.min() == 1 else -12.0)
    words = np.concatenate([w for w, _ in docs])
    per_sentence = np.concatenate([s for _, s in docs])
    sentence_doc = np.repeat(np.arange(len(docs), dtype=np.int32), [len(s) for _, s in docs])
    word_sentence = np.repeat(np.arange(len(per_sentence), dtype=np.int32), per_sentence)
    kept = _telling(words, word_sentence, labels[sentence_doc])
    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))
    use = place[words] >= 0
    feature, sentence = place[words[use]], word_sentence[use]
    n_sentences, n_docs = len(per_sentence), len(docs)
    weights, bias = np.zeros(len(kept)), math.log(0.5 / max(1.0, n_sentences / n_docs))
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    total = share.sum()
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(sentence, weights[feature], n_sentences)
        p = 0.5 * (1 + np.tanh(z / 2))
        strength = np.bincount(sentence_doc, np.logaddexp(0, z), n_docs)  # -log(1 - P) of a document
        slope = np.where(labels == 1, -1 / np.expm1(np.clip(strength, 1e-9, 500)), 1.0) * share / total
        g = slope[sentence_doc] * p
        gradient = np.append(np.bincount(feature, g[sentence], len(kept)), g.sum())
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        rate = 0.1 * min(1.0, 2 * (1 - step / (STEPS + 1)))
        moved = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias -= moved[-1]
        weights -= moved[:-1]
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - PENALTY * rate)
    used = np.flatnonzero(np.abs(weights) > 0.05)
    return Model(dict(zip(kept[used].tolist(), weights[used].tolist())), float(bias))


def bags(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of a text and the number of them in each sentence."""
    buckets, sizes = [], []
    for match in _SENTENCE.finditer(text):
        own = [b for token in dict.fromkeys(match[0].split()) for b in features(token)]
        if own:
            buckets += own
            sizes.append(len(own))
    return np.array(buckets, np.int32), np.array(sizes, np.int32)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from documents with a label where `learn` holds: `rows` of each class at most, of smallest hash.

    Their words, hashed to buckets, come to the driver, which takes the gradient steps. Where a document has several
    labels, toxic wins. Null labels and texts teach nothing.
    """
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_label"))
        .withColumn("_hash", F.xxhash64("doc_id"))
    )
    sizes = {r[0]: r[1] for r in marked.groupBy("_label").count().collect()}
    samples = [marked.where(F.col("_label") == c).orderBy("_hash", "doc_id").limit(rows) for c in (0, 1)]
    sample = samples[0].unionByName(samples[1]).select("doc_id", "_label")
    # Two times `rows` ids at most.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").where(F.col("text").isNotNull())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bags(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array([w.tobytes() for w, _ in found], pa.binary()),
                    pa.array([s.tobytes() for _, s in found], pa.binary()),
                    pa.array([xxhash.xxh64_intdigest(w.tobytes()) >> 1 for w, _ in found], pa.int64()),
                ],
                ["label", "words", "sizes", "key"],
            )

    found = chosen.select("text", F.col("_label").cast("int")).mapInArrow(
        hashed, "label int, words binary, sizes binary, key long"
    )
    got = sorted(found.collect(), key=lambda r: (r.key, r.label))  # one order, so that one model comes out
    got = [r for r in got if r.sizes]
    bag = [(np.frombuffer(r.words, np.int32), np.frombuffer(r.sizes, np.int32)) for r in got]
    label = np.array([r.label for r in got])
    drawn = np.bincount(label, minlength=2) if len(label) else np.zeros(2)
    # A class that was thinned out counts for all its rows.
    share = np.array([sizes[c] / drawn[c] for c in label.tolist()]) if len(label) else np.zeros(0)
    return train(bag, label, share)


def score_text(text: str, weight_of: dict[str, float], bias: float) -> tuple[float, list[tuple[int, int, float]]]:
    """Probability of a text, and of each sentence that is likelier toxic than not, with its span."""
    strength, offending = 0.0, []
    plain = math.log1p(math.exp(bias))
    get = weight_of.__getitem__
    for match in _SENTENCE.finditer(text):
        tokens = dict.fromkeys(match[0].split())  # a word said twice is no stronger evidence
        z = bias + sum(map(get, tokens))
        if z == bias:
            if tokens:
                strength += plain
            continue
        strength += math.log1p(math.exp(min(z, 500.0)))
        if z >= 0:
            offending.append((*match.span(), 1 / (1 + math.exp(-z))))
    return -math.expm1(-strength), offending


def score_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add score and `offending` (start, end and score of sentences, code points) to every row.

    Null and empty texts, and those without words, have score 0 and no offending sentence. Columns of these names are
    replaced, all others kept; repeated rows are scored alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    @F.arrow_udf("struct<score: double, offending: array<struct<start: long, end: long, score: double>>>")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        weights = Memory(lambda token: sum(known.weights.get(b, 0.0) for b in features(token)), 300_000)
        for batch in batches:
            rated = [score_text(t, weights, known.bias) for t in batch.to_pylist()]
            offending = [[dict(zip(("start", "end", "score"), s)) for s in o] for _, o in rated]
            yield pa.StructArray.from_arrays(
                [pa.array([s for s, _ in rated], pa.float64()), pa.array(offending, pa.list_(span))],
                ["score", "offending"],
            )

    rated = docs.withColumn("_rated", rate(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    return rated.withColumns({"score": F.col("_rated.score"), "offending": F.col("_rated.offending")}).drop("_rated")
