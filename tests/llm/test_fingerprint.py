"""Fingerprints against a window-by-window version."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm import fingerprint as fp
from tillmark.llm import fingerprint_query  # noqa: F401 - registers the query
from tillmark.llm.registry import QUERIES

from .conftest import SF


def plain_levels(data):
    full = int(fp._WEIGHT[64])
    return [
        (full - sum(int(fp._WEIGHT[c]) for c in Counter(data[i : i + 64]).values())) * 999 // full
        for i in range(len(data) - 63)
    ]


def plain_features(data, ranks):
    rank = [int(ranks[x]) for x in plain_levels(data)]
    votes = Counter()
    for i in range(len(rank)):
        best = min(range(i, min(i + 64, len(rank))), key=lambda j: (rank[j], j))
        if rank[best] < fp.LEVELS:
            votes[best] += 1
    return sorted(i for i, n in votes.items() if n >= fp.VOTES)


def some(seed, count=12):
    rng = random.Random(seed)
    return [bytes(rng.choices(b"abc defghij\nklmn", k=rng.choice([0, 3, 63, 64, 65, 200, 700]))) for _ in range(count)]


def test_levels_are_entropies_of_the_windows():
    data = some(1)[-1] + bytes(range(256)) + b"a" * 80
    levels = fp.window_levels(np.frombuffer(data, np.uint8))
    assert levels.tolist() == plain_levels(data)
    exact = [6 - -sum(c / 64 * math.log2(c / 64) for c in Counter(data[i : i + 64]).values()) for i in range(len(levels))]
    assert np.abs((999 - levels) / 999 * 6 - exact).max() < 0.01


def test_features_do_not_depend_on_the_batch():
    texts = some(2, 40)
    counts = fp.level_counts(texts)
    assert counts.tolist() == np.bincount([x for t in texts for x in plain_levels(t)], minlength=fp.LEVELS).tolist()
    ranks = fp.ranks_of(counts)
    together = fp.fingerprints(texts, ranks)
    assert together == [fp.fingerprints([t], ranks)[0] for t in texts]
    for text in texts[:15]:
        starts = fp.select_features(np.frombuffer(text, np.uint8), np.array([len(text)]), ranks)
        assert starts.tolist() == plain_features(text, ranks)


def test_rarer_levels_rank_first():
    counts = np.zeros(fp.LEVELS, int)
    counts[[50, 300, 400, 500]] = [1, 9, 2, 2]
    ranks = fp.ranks_of(counts)
    assert ranks[[400, 500, 300]].tolist() == [0, 1, 2] and ranks[50] == ranks[600] == fp.LEVELS


def test_filters_are_chained_when_full():
    hashes = np.random.default_rng(3).integers(0, 2**63, 300, np.uint64)
    digest = np.frombuffer(fp._filters(np.append(hashes, hashes[:50])), np.uint8).reshape(-1, 257)
    assert digest[:, 0].tolist() == [128, 128, 44]


def test_likeness_follows_what_texts_share():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(900)]
    long, other = (" ".join(rng.choices(words, k=4000)).encode() for _ in range(2))
    half = long[: len(long) // 2] + other[: len(long) // 2]
    a, b, c = fp.fingerprints([long, half, other], fp.ranks_of(fp.level_counts([long, other])))
    assert fp.likeness(a, a) == 1 and fp.likeness(a, c) < 0.1 and 0.35 < fp.likeness(a, b) < 0.75
    assert fp.likeness(a, b) == fp.likeness(b, a)
    short = fp.fingerprints([b"x", b"y", b""], np.full(fp.LEVELS, fp.LEVELS))
    assert fp.likeness(short[0], short[0]) == 1 and fp.likeness(short[0], short[1]) == 0 == fp.likeness(short[0], a)


def check(rows, pairs, ranks):
    """Every row against its text and the next one's."""
    ordered = sorted(pairs, key=lambda p: (p[0] is not None, p[0], p[1] or ""))
    want = []
    for i, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = (text[: len(text) - half] + following[:half]).encode()
        a, b, c = fp.fingerprints([text.encode(), edited, following.encode()], ranks)
        want.append(
            (doc_id, len(text), hashlib.sha256(edited).hexdigest(), base64.b64encode(a).decode())
            + (base64.b64encode(b).decode(), fp.likeness(a, b), fp.likeness(a, c))
        )
    got = [tuple(r) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query(spark, given):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ranks = fp.corpus_ranks(docs)
    counts = sum(fp.level_counts([t.encode()]) for t in given.values())
    assert (ranks == fp.ranks_of(counts)).all()
    check(QUERIES["op4_fingerprints"](spark, SF).collect(), list(given.items()), ranks)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_odd_rows(spark, documents, parts):
    pairs = [(5, "é" * 301), (None, "n"), (2, None), (9, ""), (9, ""), (7, "abc def " * 30_000), (-3, "z" * 90)]
    ranks = fp.ranks_of(np.ones(fp.LEVELS, int))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    docs = documents(pairs=pairs).withColumns({"part": F.lit("clash"), "fingerprint": F.lit(1)})
    check(fp.compare_neighbours(docs, ranks).collect(), pairs, ranks)
    check(fp.compare_neighbours(documents(["alone " * 40]), ranks).collect(), [(0, "alone " * 40)], ranks)
    assert fp.compare_neighbours(documents(), ranks).count() == 0
    spark.conf.set("spark.sql.shuffle.partitions", before)
    plain = fp.fingerprint_documents(docs, ranks).orderBy("doc_id").collect()
    assert len(plain) == len(pairs) and plain[-1].fingerprint == plain[-2].fingerprint
