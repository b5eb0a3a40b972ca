"""Token alignment against a plain version, token by token."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillmark.llm import alignment, alignment_query  # noqa: F401 - registers the query
from tillmark.llm.alignment import Pieces, alignments, common_ends, heavy_from
from tillmark.llm.pieces import Kept, byte_letters
from tillmark.llm.registry import QUERIES

from .conftest import SF
from .test_tokens import ODD

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(rows):
    one, two = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    one.encode_special_tokens = True
    letters = {c: b for b, c in byte_letters().items()}

    def bytes_b(i):
        piece = two.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for _, text in rows:
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids
        b = two.encode(text or "")
        spelled_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in a]
        spelled_b = [bytes_b(i) for i in b]
        want = (" " + (text or "")).encode()
        groups = []
        if text and b"".join(spelled_a) == want and b"".join(spelled_b) == want:
            x, y, end_a, end_b, own = 0, 0, 0, 0, ([], [])
            while x < len(a) or y < len(b):
                if end_a <= end_b:
                    end_a += len(spelled_a[x])
                    own[0].append(a[x])
                    x += 1
                else:
                    end_b += len(spelled_b[y])
                    own[1].append(b[y])
                    y += 1
                if end_a == end_b:
                    groups.append(own)
                    own = ([], [])
        links = Counter((i, j) for g in groups for i in g[0] for j in g[1])
        counts.update(links.keys())
        found.append((groups, links))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, _), (groups, links) in zip(rows, found):
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        out.append((
            doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), links.total(),
            sum(n for p, n in links.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query(spark, given):
    assert found(QUERIES["op13_token_alignment"](spark, SF)) == plain(list(given.items()))


@pytest.mark.parametrize("heavy", [0, 40, 1 << 19])
def test_odd_rows(spark, documents, heavy, monkeypatch):
    monkeypatch.setattr(alignment, "LISTED", 3)
    random.seed(heavy)
    rows = [(i, "".join(random.choices([*ODD, "▁", " ▁", "ﬁ", "\xad"], k=random.randint(0, 9)))) for i in range(300)]
    rows += [(1, None), (None, "one two"), (None, "one two"), (1, "one two"), (5, ""), (6, "▁"), (7, "ab" * 5000), (8, " " * 999)]
    docs = documents(pairs=rows).repartition(4).withColumns({"row": F.lit("clash"), "pair": F.lit(1), "n_a": F.lit(None)})
    assert found(alignments(docs, BYTE, PIECE, heavy=heavy)) == plain(rows)


def test_empty_table(spark, documents):
    assert found(alignments(documents(), BYTE, PIECE)) == []
    assert found(alignments(documents([None, ""]), BYTE, PIECE)) == plain([(0, None), (1, "")])


@pytest.mark.parametrize("budget", [0, 20_000, 1 << 25])
def test_texts_are_cut_where_no_piece_goes_across(budget):
    side = Pieces(PIECE)
    side.kept = Kept(budget)
    random.seed(3)
    texts = ["".join(random.choices([*ODD, " the", " word", "\nnew", "▁"], k=random.randint(1, 60))) for _ in range(600)]
    texts += ["x" * 500, "a b " * 300, " lead" * 40, "a\t b", "a \tb", "a ", "", " ", "a\xa0 b"]
    for start in range(0, len(texts), 200):
        some = texts[start : start + 200]
        assert [ids.tolist() for ids in side.ids(some)] == [side.model.encode(t) for t in some]
        assert side.kept.spent <= budget


def test_heavy_pairs_are_bounded(spark):
    counts = spark.createDataFrame([(i, h) for i, h in enumerate([1, 1, 1, 2, 3, 4, 9])], "pair long, held long")
    assert [heavy_from(counts, most) for most in (0, 1, 2, 4, 5, 6, 7)] == [1 << 62, 8, 4, 2, 2, 2, 1]


def test_common_ends_of_whole_batches():
    rng = np.random.default_rng(2)
    for _ in range(50):
        last = int(rng.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rng.random(last) < 0.4), last) for _ in range(2))
        common = sorted(set(a.tolist()) & set(b.tolist()))
        i, j = common_ends(a, b)
        assert a[i - 1].tolist() == b[j - 1].tolist() == common
        assert i.tolist() == [a.tolist().index(e) + 1 for e in common]


def test_texts_stand_one_behind_the_other():
    """The ends of all texts of a batch are looked up together, and no text takes part in another's groups."""
    aligner, calls = alignment.Aligner(BYTE, PIECE), []
    texts = ["one two, three", "", "ﬁ", "Four\nfive", "one two, three", "  six"]
    ask = alignment.common_ends
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(alignment, "common_ends", lambda *ends: calls.append(1) or ask(*ends))
        figures, digests, doc, pairs, times = aligner.documents(texts)
    assert len(calls) == 1
    alone = [aligner.documents([t]) for t in texts]
    assert figures.tolist() == [f[0].tolist() for f, *_ in alone]
    assert digests == [d[0] for _, d, *_ in alone]
    for k, (_, _, _, own, held) in enumerate(alone):
        assert pairs[doc == k].tolist() == own.tolist() and times[doc == k].tolist() == held.tolist()
