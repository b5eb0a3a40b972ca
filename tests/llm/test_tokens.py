"""Token counts, binary token files and packing against the tokenizers library itself."""

import gc
import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillmark.llm import packing, pfor
from tillmark.llm.pieces import BatchEncoder, Kept, as_bytes, balanced
from tillmark.llm import packing_query, token_count_query, token_files_query  # noqa: F401 - registers the queries
from tillmark.llm.registry import QUERIES
from tillmark.llm.token_count import count_tokens, safe_parts
from tillmark.llm.token_files import read_tokens, write_tokens

from .conftest import SF

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "The", "it's", "é", "É", "İ", "ΑΣ", "é", "́", " ", "  ", "\n", "\n\n", "\t", "\r\n", " "]
ODD += ["\x1c", ".", ",", "...", "$$", "'s", "12", "<|endoftext|>", "<|ENDOFTEXT|>", "\0", "日本", "🙂", "​", "K"]


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("budget, merge_only", [(0, True), (20_000, False), (1 << 25, True), (1 << 25, False)])
def test_batches_give_the_ids_of_the_library(path, budget, merge_only, given):
    ids, kept = library(path), Kept(budget)
    own = BatchEncoder(path, merge_only=merge_only, kept=kept)
    random.seed(7)
    texts = ["".join(random.choices(ODD, k=random.randint(0, 9))) for _ in range(4000)] + list(given.values())[:60]
    for start in range(0, len(texts), 700):
        some = texts[start : start + 700]
        want = [ids(t) for t in some]
        assert own.batch(some) == [as_bytes(w) for w in want]
        assert own.counts(some) == [len(w) for w in want]
        assert kept.spent <= budget
    assert own.batch([]) == own.counts([]) == []


def test_special_strings_may_be_plain_text():
    tokenizer = Tokenizer.from_file(BYTE)
    tokenizer.encode_special_tokens = True
    for text in (" a<|endoftext|> b", "<|endoftext|>", "x <|endoftext|>"):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(array("I", BatchEncoder(BYTE, True, kept=Kept(1000)).batch([text])[0])) == want != library(BYTE)(text)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_text_without_spaces_is_not_kept(path):
    kept = Kept(1 << 20)
    text = "x1" * 5_000_000
    assert BatchEncoder(path, kept=kept).counts([text, "a b"])[0] > 0
    assert kept.spent < 2000 and max(map(len, kept.of(next(iter(kept.known))))) < 70


def test_a_batch_is_one_call_of_the_library(monkeypatch):
    calls = []
    own = BatchEncoder(BYTE, merge_only=False, kept=Kept(1 << 20))
    ask = own._library
    monkeypatch.setattr(own, "_library", lambda texts: calls.append(sorted(texts)) or ask(texts))
    own.batch(["one two one, two.\n\nTwo", "one three"])
    own.batch(["two three", "one"])
    # Each part is asked for once: words apart from marks and line breaks, the first word of a text as it is.
    assert calls == [sorted(["one", " two", " one", ",", ".", "\n", "Two", " three"]), ["two"]]


def test_long_texts_are_cut_where_words_end():
    ids = library(WORD)
    text = "".join(random.choices(ODD, k=3000)) + " end"
    parts = list(safe_parts(text, 50))
    assert "".join(parts) == text and len(parts) > 1
    assert [i for p in parts for i in ids(p)] == ids(text)
    assert list(safe_parts("x" * 500, 50)) == ["x" * 500]


def test_batches_are_balanced_by_size():
    assert list(balanced([5, 5, 20, 1, 1], 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(balanced([], 10)) == []


def test_counts(spark, given):
    ids = library(WORD)
    rows = QUERIES["op9_token_counts"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        i: (len(t.encode()), len(ids(t)), len(ids(t)) > 2048) for i, t in given.items()
    }


def test_counts_of_odd_rows(spark, documents):
    long = "word, " * 300_000
    docs = documents(["", None, "one two", "one two", long]).withColumn("n_tokens", F.lit("clash"))
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, WORD).collect())
    assert got[:4] == [(0, 0, 0, False), (1, 0, 0, False), (2, 7, 2, False), (3, 7, 2, False)]
    assert got[4] == (4, len(long), 600_000, True)
    assert count_tokens(documents(), WORD).count() == 0


@settings(max_examples=60, deadline=None)
@cases(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 90), max_size=300), max_size=6), st.data())
def test_packed_blocks_round_trip(docs, data):
    values = np.array([v for d in docs for v in d], np.uint32)
    ends = np.cumsum([len(d) for d in docs])
    segment = pfor.Segment(pfor.encode(np.arange(len(docs)), ends, values, data.draw(st.sampled_from([1, 50, 90, 100]))))
    assert (segment.values() == values).all() and segment.ends.tolist() == ends.tolist()
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert segment.values(a, b).tolist() == values[a:b].tolist()


def test_outliers_are_exceptions():
    values = np.full(1280, 7, np.uint32)
    values[::100] = 50_000
    segment = pfor.Segment(pfor.encode(np.array([1]), np.array([1280]), values))
    assert segment.widths.max() == 0 and len(segment.place) == 13


def test_token_files(spark, given):
    ids, start, want = library(BYTE), 0, {}
    for doc_id in sorted(given):
        own = [*ids(given[doc_id]), 0]
        want[doc_id] = (start, len(own), zlib.crc32(array("I", own).tobytes()))
        start += len(own)
    rows = QUERIES["op6_token_files"](spark, SF).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == want


def test_token_files_of_odd_rows(spark, documents, tmp_path):
    ids = library(BYTE)
    docs = documents(pairs=[(5, "b"), (2, None), (5, "a"), (9, ""), (-1, "x " * 5000), (2, None)])
    write_tokens(docs, f"{tmp_path}/t", BYTE, segment_ids=100)
    got = read_tokens(spark, f"{tmp_path}/t").orderBy("start").collect()
    want = [(-1, "x " * 5000), (2, ""), (2, ""), (5, "a"), (5, "b"), (9, "")]
    assert [(r.doc_id, r.ids) for r in got] == [(i, [*ids(t), 0]) for i, t in want]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    write_tokens(documents(), f"{tmp_path}/none", BYTE)
    assert read_tokens(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(Exception, match="doc_id is null"):
        write_tokens(documents(pairs=[(None, "a")]), f"{tmp_path}/null", BYTE)


def test_token_files_keep_rows_without_an_id(spark, documents, folder, tmp_path):
    ids = library(BYTE)
    nameless = [f"text {i}" for i in range(60)] + ["text 1", None, ""]
    named = [(-(2**63), "least"), (0, "zero"), (3, None), (3, "b")]
    docs = documents(pairs=[*((None, t) for t in nameless), *named])
    got = QUERIES["op6_token_files"](spark, folder(documents=docs)).orderBy("start").collect()
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    crc = lambda text: zlib.crc32(array("I", [*ids(text), 0]).tobytes())
    assert sorted(r.ids_crc32 for r in got[: len(nameless)]) == sorted(map(crc, nameless))
    assert all(r.doc_id is None for r in got[: len(nameless)])
    want = [(-(2**63), "least"), (0, "zero"), (3, ""), (3, "b")]
    assert [(r.doc_id, r.ids_crc32) for r in got[len(nameless) :]] == [(i, crc(t)) for i, t in want]
    write_tokens(docs, f"{tmp_path}/t", BYTE, segment_ids=20, null_ids=True)
    parts = read_tokens(spark, f"{tmp_path}/t").orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in parts] == [(r.doc_id, r.start, r.n_tokens) for r in got]


def check_pieces(rows, sizes, capacity):
    """Every id in one piece; sequences gapless and within capacity. Returns the fill of each sequence."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, size in sizes.items():
        at = 0
        for start, length in sorted(by_doc.get(doc_id, [])):
            assert start == at and length > 0
            at += length
        assert at == size
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return {s: sum(n for _, n in p) for s, p in by_sequence.items()}


def test_packing(spark, given):
    ids = library(WORD)
    own = {i: [*ids(t), 1] for i, t in given.items()}
    rows = QUERIES["op8_packing"](spark, SF).collect()
    fill = check_pieces(rows, {i: len(x) for i, x in own.items()}, 2048)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(array("I", own[r.doc_id][r.start : r.start + r.length]).tobytes())
        assert r.doc_tokens == len(own[r.doc_id])
    assert len(fill) <= -(-sum(map(len, own.values())) // 2048) + 1


def test_packing_of_equal_lengths_and_odd_rows(spark):
    sizes = {i: n for i, n in enumerate([5] * 40 + [3] * 17 + [0, 10, 20, 31] + [7] * 9)}
    tokens = spark.createDataFrame(list(sizes.items()), "doc_id long, doc_tokens long")
    tokens = tokens.withColumns({"length": F.lit("clash"), "note": F.lit(None).cast("string")})
    rows = packing.pack(tokens, 10).collect()
    fill = check_pieces(rows, sizes, 10)
    assert sum(10 - n for n in fill.values()) < 10
    assert packing.pack(tokens.limit(0), 10).count() == 0


@settings(max_examples=100, deadline=None)
@cases(st.dictionaries(st.integers(1, 30), st.integers(1, 50), min_size=1, max_size=12))
def test_windows_use_every_length_once_and_fill_closest(counts):
    left = dict(counts)
    for times, chosen in packing.plan_windows(counts, 30):
        total = sum(n * k for n, k in chosen.items())
        assert times > 0 and total <= 30
        best = {0}
        top = max(n for n in left if left[n])
        for n, c in left.items():
            for _ in range(min(c - (n == top), 30 // n)):
                best |= {s + n for s in best if s + n + top <= 30}
        assert total == top + max(best)
        for n, k in chosen.items():
            left[n] -= times * k
            assert left[n] >= 0
    assert not any(left.values())


def test_sequences_hold_the_ids(spark, documents):
    ids = library(WORD)
    texts = ["a b c d e f g", "hello", None, "x " * 40]
    pieces = packing.pack_documents(documents(texts), WORD, 1, 16)
    got = sorted(i for r in packing.sequences(pieces).collect() for i in array("I", bytes(r.ids)))
    assert got == sorted(i for t in texts for i in [*ids(t), 1])


def test_learning_new_pieces_is_not_interrupted_by_the_garbage_collector():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(3, 9))) + rng.choice(["", ",", "!?", "'s"]) for _ in range(30_000)]
    texts = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own, passes = BatchEncoder(public_tokenizers.path(name), kept=Kept(1 << 30)), []
        pieces = {p for t in texts for p in own.cut(t)}
        gc.collect()
        note = lambda phase, info: passes.append(phase)
        gc.callbacks.append(note)
        try:
            own._learn(own.kept.of(own.name), pieces)
        finally:
            gc.callbacks.remove(note)
        assert len(passes) <= 2 and gc.isenabled()
        assert own.batch(texts) == own._library(texts)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_word_is_kept_once_whatever_marks_and_line_breaks_stand_by_it(path):
    kept = Kept(1 << 20)
    own = BatchEncoder(path, kept=kept)
    texts = ["x word word, word. word?!\nword", "x word!\n\nword, word"]
    assert own.batch(texts) == own._library(texts)
    space = " " if path == BYTE else ""
    pieces = {"x", space + "word", ",", ".", "?!", "!"} | ({"\n", "word"} if path == BYTE else {""})
    assert set(kept.of(own.name)) == pieces


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("plain_specials", [True, False])
def test_cuts_in_bytes_are_those_of_the_library(path, plain_specials):
    white = list(map(chr, (32, 10, 9, 13, 11, 28, 127, 0x85, 0xA0, 0x1680, 0x180E, 0x2003, 0x200B, 0x2028, 0x202F, 0x3000)))
    solid = ["a", "Ab", "é", "É", "ÿ", "×", "÷", "e\u0301", "1", ".", ",", "'", "'s", "“", "—", "ま", "語", "🙂", "<|endoftext|>", "\0"]
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain_specials
    own = BatchEncoder(path, plain_specials, kept=Kept(1 << 24))
    rng = random.Random(11)
    texts = ["".join(rng.choices(white[: rng.choice([2, 16])] + solid, k=rng.randint(0, 8))) for _ in range(6000)]
    texts += [a + w + v + b for a in ("", "a", "É,") for w in white for v in white for b in ("", "b", "<|endoftext|>")]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert own.batch(texts) == [as_bytes(w) for w in want]
    assert own.counts(texts) == [len(w) for w in want]
