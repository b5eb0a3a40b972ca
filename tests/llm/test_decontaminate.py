"""Decontamination against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

from tillmark.llm.decontaminate import find_items, item_shingles, signatures, without_items

ITEMS = "item_id long, text string"


def shingles(text, width):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain(docs, items):
    found = set()
    for item_id, text in items:
        width = min(5, len((text or "").split()))
        own = shingles(text, width) if width else set()
        for doc_id, doc in docs:
            shared = len(own & shingles(doc, width)) if own else 0
            if own and 100 * shared >= 75 * len(own):
                found.add((doc_id, item_id, len(own), shared))
    return found


def cases(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(25)]
    docs = []
    for i in range(60):
        text = rng.choices(words, k=rng.randint(0, 300))
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):
                passage[rng.randrange(len(passage))] = "X"
            at = rng.randint(0, len(text))
            text[at:at] = passage
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(text)))
    return docs, items


@pytest.mark.parametrize("block_rows", [500_000, 100])
def test_finds_what_plain_sets_find(spark, documents, block_rows):
    docs, items = cases(block_rows)
    got = find_items(documents(pairs=docs), spark.createDataFrame(items, ITEMS), block_rows=block_rows).collect()
    want = plain(docs, items)
    assert {(r.doc_id, r.item_id, r.item_shingles, r.shared) for r in got} == want and len(got) == len(want) > 10


def test_signatures_are_as_long_as_their_size_partition_needs(spark):
    text = " ".join(f"w{i}" for i in range(36))  # 32 shingles
    got = signatures(item_shingles(spark.createDataFrame([(1, text), (2, text + " z")], ITEMS)), 0.75)
    assert {r._item: r.n for r in got.groupBy("_item").agg(F.count("*").alias("n")).collect()} == {1: 9, 2: 17}


def test_odd_rows(spark, documents):
    item = "one two three four five six"
    docs = documents(pairs=[(1, None), (2, ""), (3, item), (3, "other"), (None, item), (4, "a " * 200_000 + item)])
    docs = docs.withColumns({"_doc": F.lit(1), "shared": F.lit("clash")})
    items = spark.createDataFrame([(9, item), (9, item), (10, None), (11, " "), (None, "one TWO")], ITEMS)
    got = {(r.doc_id, r.item_id) for r in find_items(docs, items).collect()}
    assert got == {(3, 9), (None, 9), (4, 9), (3, None), (None, None), (4, None)}
    kept = without_items(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert find_items(documents(), items).count() == 0
    assert find_items(docs, items.limit(0)).count() == 0
    assert without_items(docs, items.limit(0)).count() == 6


def test_no_python_in_the_plan(spark, documents):
    plan = find_items(documents(["a b c d e f"]), spark.createDataFrame([(1, "a b c d e f")], ITEMS))
    assert not any(x in plan._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))
