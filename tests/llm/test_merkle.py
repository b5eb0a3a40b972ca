"""The Merkle manifest against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tillmark.llm import merkle_query
from tillmark.llm.merkle import verify

from .conftest import DOCUMENTS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    """All levels of the tree over some digests."""
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i : i + 8]) for i in range(0, len(found[-1]), 8)])
    return found


def path(tree, pos):
    """(left, right) siblings by level."""
    out = []
    for nodes in tree[:-1]:
        start = pos // 8 * 8
        out.append((nodes[start:pos], nodes[pos + 1 : start + 8]))
        pos //= 8
    return out


def plain(rows):
    leaves = {}
    for doc_id, text, lang, source, n in rows:
        make = lambda t: h(*map(field, (doc_id, source, lang, n, t)))  # noqa: E731, B023
        leaf, hit = make(text), doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        changed = make(text and text.translate(LOWER)) if hit else leaf
        leaves.setdefault(lang, []).append((doc_id is not None, doc_id, leaf, changed))
    langs = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        leaves[lang].sort(key=lambda x: x[:3])
        trees[lang] = levels([x[2] for x in leaves[lang]])
    top = levels([trees[lang][-1][0] for lang in langs])
    root, out = top[-1][0] if langs else None, []
    for k, lang in enumerate(langs):
        for pos, (_, doc_id, leaf, changed) in enumerate(leaves[lang]):
            steps = path(trees[lang], pos) + path(top, k)
            folded = changed
            for left, right in steps:
                folded = h(*left, folded, *right)
            proof = h(*[x for left, right in steps for x in (*left, *right)])
            out.append((doc_id, leaf, trees[lang][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check(spark, rows):
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    docs = docs.withColumns({"rank": F.lit("clash"), "item": F.lit(None).cast("int"), "node": F.lit(1), "_row": F.lit(2)})
    assert found(verify(docs, merkle_query.tampered())) == plain(rows)


@pytest.mark.parametrize("hot", [1, 8, 9, 64, 65, 600])
def test_proofs_of_trees_of_all_shapes(spark, hot):
    rng = random.Random(hot)
    word = lambda: rng.choice(["Abc", "x", "É", "wörd", ""])
    rows = [(i, f"{word()} {word()}", "en", word(), i) for i in rng.sample(range(10_000), hot)]
    rows += [(i, "T", lang, "s", 1) for i, lang in enumerate(["z", "de", "de", None, "Z", "é", "", "~", "a", "b"])]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(None, "A", "en", "s", 1), (None, "A", "en", "s", 1), (None, "B", "en", None, None), (3, None, None, None, None)]
    rows += [(3, "x", "en", "s", 1)] * 20 + [(3, "X", "en", "s", 1), (4, "", "en", "s", 0), (6, "Ab " * 300_000, "en", "s", 2)]
    check(spark, rows)
    check(spark, [(5, "Alone", "en", "s", 1)])
    check(spark, [(5, "Alone", None, "s", 1)])
    check(spark, [])


def test_several_tables_of_blocks(spark, monkeypatch):
    from tillmark.llm import merkle

    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BROADCAST_ROWS", 0)
    check(spark, [(i, f"T{i}", "en" if i % 4 else f"l{i % 11}", "s", 1) for i in range(150)])


def test_tampering_shows(spark, documents):
    rows = verify(documents(["One", "two", "Three", "four"]), F.col("doc_id").isin(0, 1)).collect()
    assert {r.doc_id: r.verified for r in rows} == {0: False, 1: True, 2: True, 3: True}
