"""The similarity join against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm import jaccard, jaccard_query  # noqa: F401 - registers the query
from tillmark.llm.components import components
from tillmark.llm.jaccard import keep_one, near_duplicates
from tillmark.llm.registry import QUERIES
from tillmark.llm.shingles import shingle_sets

from .conftest import SF


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_set(text):
    words = plain_words(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(pairs):
    """(doc_id, set size, component) of each row, by comparing all pairs."""
    sets = [plain_set(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(pairs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(pairs)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=130):
    """Copies, near copies, chains of edits, a passage and lines that many share, and short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    some = lambda k: [rng.choice(words) + str(rng.randint(0, 30)) for _ in range(k)]
    passage, base = some(40), some(80)
    texts = []
    for _ in range(n):
        kind = rng.randrange(7)
        if kind == 0:
            text = some(rng.randint(5, 60))
        elif kind == 1:
            text = [*some(rng.randint(0, 12)), *passage, *some(rng.randint(0, 12))]
        elif kind == 2:
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind == 3 and texts:
            text = rng.choice(texts).split()
            if text:
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind == 4 and texts:
            text = rng.choice(texts).upper().split()
        elif kind == 5:
            text = rng.choices(["a", "b", "C"], k=rng.randint(0, 6))
        else:
            text = [*base[: rng.randint(50, 80)], *some(rng.randint(0, 10))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(text))
    return list(enumerate(texts))


def test_sets_are_those_of_the_words():
    texts = ["", None, "a", "A b", "b a", "a b c d", "a b c d e", "A b\tC  d\x0be f", "É é a", "a\x85b c d e f", "x " * 50]
    texts += [t for _, t in corpus(1)]
    got = shingle_sets(texts)
    ids = {}
    for text, own in zip(texts, got):
        want = plain_set(text)
        assert len(own) == len(want) and (np.diff(own.astype(object)) > 0).all()
        for shingle in want:
            ids.setdefault(shingle, set()).add(int(own[0]) if len(own) == 1 else None)
    flat = [x for own in got for x in own.tolist()]
    assert len(set(flat)) == len(set().union(*map(plain_set, texts)))
    assert shingle_sets(["a b"])[0] != shingle_sets(["b a"])[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_finds_all_links(spark, documents, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 3 if seed == 2 else 64)
    pairs = corpus(seed)
    random.Random(seed).shuffle(pairs)
    assert found(near_duplicates(documents(pairs=pairs).repartition(5))) == plain(pairs)


def test_query(spark, given):
    assert found(QUERIES["op10_ngram_jaccard"](spark, SF)) == plain(list(given.items()))


def test_odd_rows(spark, documents):
    text = " ".join(f"w{i}" for i in range(30))
    pairs = [(4, text), (4, text + " x"), (9, text.upper()), (2, "other words"), (4, "other words"), (None, "lone one")]
    pairs += [(11, None), (11, ""), (12, " \n"), (13, "z " * 200_000), (14, "z " * 6), (None, text), (3, "B a"), (5, "a b")]
    docs = documents(pairs=pairs).withColumns({"class": F.lit("clash"), "n": F.lit(None).cast("int")})
    assert found(near_duplicates(docs)) == plain(pairs)
    assert near_duplicates(documents()).count() == 0
    assert found(near_duplicates(documents([None, ""]))) == [(0, 0, 0), (1, 0, 1)]
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 3, 4, 5, 11, 11, 12, 13]


def test_one_row_of_a_component_stays(spark, documents):
    text = " ".join(f"w{i}" for i in range(30))
    pairs = [(None, text)] * 4 + [(None, text + " x"), (None, "only this"), (7, "a b"), (7, "a b"), (7, "c d"), (None, None)]
    pairs += [(None, None), (9, "")]
    kept = keep_one(documents(pairs=pairs).withColumn("_id", F.lit(1)))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(None, min((text, text + " x"), key=lambda t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0]))]
        + [(None, "only this"), (7, "a b"), (7, "c d"), (None, None), (None, None), (9, "")], key=repr)


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    links += [(7, 7), (None, 5), (1, 2), (2, 1)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "x long, y long")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in root} and len(got) == len(root)
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0
