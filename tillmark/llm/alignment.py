"""Alignment of two tokenizers over the bytes of a text, and what the corpus says about each pair of linked tokens.

Both tokenizers cut the same bytes. A dictionary for each leads from the byte where a token ends to its index (an array
over the bytes of a batch, in which texts stand one behind the other); the ends in both dictionaries, in order, slice the two
id lists into groups, and every token of one side is linked with every token of the other side of its group.

What is written of a document are its figures and, packed, the different id pairs of its links with how often each
occurs; each batch also gives the pairs it holds with the number of its documents, so that few rows are summed over the
corpus. The sums come back to the documents in two ways. The most frequent pairs, at most `HEAVY`, are sent to all tasks
as sorted arrays. All others are rare, so that joining them by pair has no hot key.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.pieces import Kept, balanced, byte_letters, encoder, gathered, numbered, solid, together
from tillmark.llm.registry import written
from tillmark.session import fresh_dir

# Pairs whose sums are sent to all tasks: 17 bytes each.
HEAVY = 1 << 19
# Characters of the texts that are aligned at once.
BATCH_CHARS = 1 << 20
# Bytes of sentencepiece's parts that a worker keeps.
KEPT_PIECES = 64 << 20
# Links of a group that are listed one by one at most; in a larger group ids are counted first.
LISTED = 4096
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
ROWS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary, "
    "pair long, held long"
)


class Side:
    """One tokenizer: its ids for texts, and the bytes of each id."""

    def __init__(self, spelled: list[bytes], close: str):
        self.spelled = spelled
        # Whether ids of as many bytes as the text can only be its own.
        self.lossless = False
        self.sizes = np.array([len(s) for s in spelled], np.int64)
        # The decimal text of each id inside a group, and at the end of this side of a group.
        self.decimal = [f"{i}{mark}".encode() for i in range(len(spelled)) for mark in (",", close)]

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where those of each text end."""
        raise NotImplementedError

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        ids, ends = self.flat(texts)
        return np.split(ids, ends[:-1]) if texts else []

    def gives(self, ids: np.ndarray, ends: np.ndarray, whole: list[bytes]) -> np.ndarray:
        """Of which texts the bytes of the ids are these."""
        at = np.append(0, np.append(0, np.cumsum(self.sizes[ids]))[ends])
        same = np.diff(at) == np.fromiter(map(len, whole), np.int64, len(whole))
        if not self.lossless:
            given = b"".join(map(self.spelled.__getitem__, ids.tolist()))
            same &= np.array([given[a:b] == w for (a, b), w in zip(pairwise(at.tolist()), whole)], bool)
        return same


class ByteLevel(Side):
    """A byte-level tokenizer file of the tokenizers library; a space is put before the text."""

    def __init__(self, path: str):
        self.path = path
        letters = {c: b for b, c in byte_letters().items()}
        tokenizer = encoder(path, plain_specials=True).tokenizer
        tokens = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        super().__init__([bytes(letters[c] for c in t) if set(t) <= letters.keys() else t.encode() for t in tokens], "|")
        # Without a normalizer it cuts and merges the very bytes of the text.
        self.lossless = encoder(path, plain_specials=True).kind == "byte"

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return encoder(self.path, plain_specials=True).flat([" " + t for t in texts])


class Pieces(Side):
    """A sentencepiece model, which puts a space before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        count = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(count)]
        spelled = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        super().__init__(spelled, ";")
        self.kept = Kept(KEPT_PIECES)
        # A text may be cut before a single space only if no piece goes on behind one.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A text is cut at its single spaces, which no piece goes across; each new part is encoded once."""
        data, ends, first = together(texts)
        cuts, gone = first.copy(), np.zeros(len(data), bool)
        if self.cuts:
            full = solid(data)
            # The model puts a space before each part. Nothing white stands around such a space, nor the text's bounds.
            gone[1:-1] = (data[1:-1] == ord(" ")) & full[:-2] & full[2:] & ~first[1:-1] & ~first[2:]
            for k in [k for k, text in enumerate(texts) if "▁" in text]:
                gone[ends[k - 1] if k else 0 : ends[k]] = False
            cuts |= gone
        parts, numbers, sizes = numbered(data, ends, cuts, gone)
        parts = parts.to_numpy(zero_copy_only=False).tolist()
        known = self.kept.of("pieces")
        new = [p for p in parts if p not in known]
        known.update((p, array("i", ids).tobytes()) for p, ids in zip(new, self.model.encode(new, num_threads=1)))
        self.kept.entered("pieces", new)
        coded = list(map(known.__getitem__, parts))
        self.kept.settle()
        return gathered(coded, "<i4", numbers, sizes)


@lru_cache(maxsize=4)
def sides(byte_level: str, pieces: str) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, once per Python process; their files are read by path as the libraries do."""
    return ByteLevel(byte_level), Pieces(pieces)


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side lie before every byte where tokens of both end. `a` and `b` are the ends, ascending."""
    last = int(max(a[-1], b[-1]))
    at_a, at_b = np.zeros(last + 1, np.int64), np.zeros(last + 1, np.int64)
    at_a[a], at_b[b] = np.arange(1, len(a) + 1), np.arange(1, len(b) + 1)
    common = np.flatnonzero((at_a > 0) & (at_b > 0))
    return at_a[common], at_b[common]


def expanded(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, shift: int) -> tuple[np.ndarray, ...]:
    """Links of all groups: group, pair (a << shift | b) and how often it is meant; a pair may come several times."""
    from_a, from_b = np.append(0, i[:-1]), np.append(0, j[:-1])
    size_a, size_b = i - from_a, j - from_b
    links = size_a * size_b
    small = np.flatnonzero(links <= LISTED)
    each = links[small]
    within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    wide = np.repeat(size_b[small], each)
    own_a = a[np.repeat(from_a[small], each) + within // wide]
    own_b = b[np.repeat(from_b[small], each) + within % wide]
    groups, pairs, times = [np.repeat(small, each)], [own_a << shift | own_b], [np.ones(len(within), np.int64)]
    for g in np.flatnonzero(links > LISTED).tolist():
        ids_a, held_a = np.unique(a[from_a[g] : i[g]], return_counts=True)
        ids_b, held_b = np.unique(b[from_b[g] : j[g]], return_counts=True)
        pairs.append((ids_a[:, None] << shift | ids_b[None, :]).ravel())
        times.append((held_a[:, None] * held_b[None, :]).ravel())
        groups.append(np.full(len(pairs[-1]), g))
    return np.concatenate(groups), np.concatenate(pairs), np.concatenate(times)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, with the sum of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[first], np.add.reduceat(values[order], first)


class Aligner:
    def __init__(self, byte_level: str, pieces: str):
        self.a, self.b = sides(byte_level, pieces)
        self.shift = len(self.b.spelled).bit_length()
        # Padded with zero bytes, which none of them has.
        self.decimal = np.array(self.a.decimal + self.b.decimal)

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text n_a, n_b, n_groups, n_links and the hash of its groups; and of all: the document, pair and times
        of its different links."""
        figures, digests = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
        asked = [k for k, t in enumerate(texts) if t]
        some = [texts[k] for k in asked]
        a, ends_a = self.a.flat(some)
        b, ends_b = self.b.flat(some)
        whole = [(" " + t).encode("utf-8") for t in some]
        same = self.a.gives(a, ends_a, whole) & self.b.gives(b, ends_b, whole)
        right = list(compress(asked, same.tolist()))
        if not right:
            none = np.empty(0, np.int64)
            return figures, digests, none, none, none
        n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        a, b = a[np.repeat(same, n_a)].astype(np.int64), b[np.repeat(same, n_b)].astype(np.int64)
        # Where each text ends in the tokens of both sides.
        last_a, last_b = np.cumsum(n_a[same]), np.cumsum(n_b[same])
        # Both sides have the same bytes of each text, so that a text's end is common to both.
        i, j = common_ends(np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b]))
        of_text = np.searchsorted(last_a, i)
        group, pairs, times = expanded(a, b, i, j, self.shift)
        links = np.bincount(of_text[group], times, len(right))
        figures[right] = np.stack(
            [np.diff(last_a, prepend=0), np.diff(last_b, prepend=0), np.bincount(of_text, minlength=len(right)), links], 1
        )
        keys, times = _summed(of_text[group] << 40 | pairs, times)
        spelled, ends = self._spelled(a, b, i, j, last_a + last_b)
        for k, start, end in zip(right, [0, *ends], ends):
            # The last mark stands behind the last group.
            digests[k] = hashlib.sha256(spelled[start : end - 1]).hexdigest()
        return figures, digests, np.array(right)[keys >> 40], keys & (1 << 40) - 1, times

    def _spelled(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, last: np.ndarray) -> tuple[bytes, list[int]]:
        """The tokens of each group, those of A then those of B, each with the mark behind it; and where those up to each
        `last` token end."""
        groups = np.arange(len(i))
        group_a, group_b = np.repeat(groups, np.diff(i, prepend=0)), np.repeat(groups, np.diff(j, prepend=0))
        codes_a, codes_b = 2 * a, 2 * b
        codes_a[i - 1] += 1
        codes_b[j - 1] += 1
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.append(0, j)[group_a]] = codes_a
        out[np.arange(len(b)) + i[group_b]] = codes_b + len(self.a.decimal)
        wide = self.decimal[out]
        letters = wide.view(np.uint8)
        ends = np.cumsum(np.strings.str_len(wide))
        return letters[letters != 0].tobytes(), ends[last - 1].tolist()


def _documents(byte_level: str, pieces: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_level, pieces)
        for batch in batches:
            doc_ids, every = batch.column(0), batch.column(1).to_pylist()
            for start, end in balanced(list(map(len, every)), BATCH_CHARS):
                figures, digests, doc, pairs, times = aligner.documents(every[start:end])
                ends = np.searchsorted(doc, np.arange(1, end - start)).tolist()
                packed = [[x.astype("<i8").tobytes() for x in np.split(column, ends)] for column in (pairs, times)]
                nothing = [None] * (end - start)
                yield _batch(doc_ids.slice(start, end - start), *figures.T, digests, *packed, nothing, nothing)
                if len(pairs):
                    pairs, documents = np.unique(pairs, return_counts=True)
                    yield _batch(*[[None] * len(pairs)] * 8, pairs, documents)

    return align


def _batch(*columns) -> pa.RecordBatch:
    types = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary()] + [pa.int64()] * 2
    names = ["doc_id", *FIGURES, "groups_sha256", "pairs", "times", "pair", "held"]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names)


def aligned(docs: DataFrame, byte_level: str, pieces: str, path: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents with their figures and pairs, and how many documents of each batch hold a pair; written below `path`."""
    named = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = named.mapInArrow(_documents(byte_level, pieces), ROWS).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, path, compression="zstd")
    documents = rows.where(F.col("pair").isNull()).drop("pair", "held")
    return documents, rows.where(F.col("pair").isNotNull()).select("pair", "held")


def pair_counts(held: DataFrame, shift: int, path: str) -> DataFrame:
    """pair, held (documents of the corpus) and best (no pair of its first id is held by more); written below `path`."""
    summed = written(held.groupBy("pair").agg(F.sum("held").alias("held")), f"{path}/sums")
    summed = summed.withColumn("_a", F.shiftright("pair", shift))
    # One row for each id of the vocabulary at most.
    most = summed.groupBy("_a").agg(F.max("held").alias("_most"))
    found = summed.join(F.broadcast(most), "_a").select("pair", "held", (F.col("held") == F.col("_most")).alias("best"))
    return written(found, f"{path}/counts")


def heavy_from(counts: DataFrame, most: int) -> int:
    """The smallest power of two that so many pairs at most are held by at least."""
    powers = counts.groupBy(F.floor(F.log2("held")).cast("int").alias("power")).count().collect()  # 62 rows at most
    number, total = 62, 0
    for power, count in sorted(map(tuple, powers), reverse=True):
        if total + count > most:
            break
        number, total = power, total + count
    else:
        number = 0
    return 1 << number


def _scored(keys: np.ndarray, held: np.ndarray, best: np.ndarray):
    """Sums over the heavy pairs of documents, and their other pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_best, count_sum, light, light_times = [], [], [], []
            for packed, counts in zip(batch.column("pairs"), batch.column("times")):
                pairs, times = (np.frombuffer(x.as_py(), "<u8").view(np.int64) for x in (packed, counts))
                at = np.searchsorted(keys, pairs)
                at[at == len(keys)] = 0
                known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
                own = times * known
                n_best.append(int((own * best[at]).sum()) if len(keys) else 0)
                count_sum.append(int((own * held[at]).sum()) if len(keys) else 0)
                light.append(pairs[~known])
                light_times.append(times[~known])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (light, light_times)]
            kept = [batch.column(c) for c in ("row", "doc_id", *FIGURES, "groups_sha256")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), *lists],
                ["row", "doc_id", *FIGURES, "groups_sha256", "n_best", "count_sum", "light", "times"],
            )

    return work


def alignments(docs: DataFrame, byte_level: str, pieces: str, text: str = "text", heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    A is the byte-level tokenizer over a space and the text, B the sentencepiece model over the text. Null and empty
    texts, and texts whose bytes one side doesn't give back, have no tokens: zeros and an empty groups_sha256. Every row
    is a document, whatever rows share its doc_id or have none. Special strings are plain text. An empty table gives no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    path = fresh_dir(spark, "alignment")
    documents, held = aligned(docs, byte_level, pieces, f"{path}/documents", text)
    shift = len(sides(byte_level, pieces)[1].spelled).bit_length()
    counts = pair_counts(held, shift, path)
    least = heavy_from(counts, heavy)
    # `heavy` rows at most, however large the corpus.
    top = counts.where(F.col("held") >= least).toArrow().sort_by("pair")
    arrays = [top.column(c).to_numpy() for c in ("pair", "held", "best")]
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    schema += "n_best long, count_sum long, light array<long>, times array<long>"
    scored = documents.mapInArrow(_scored(*arrays), schema)
    names = ["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"]
    if least == 1:
        return scored.select(*names)
    scored = written(scored, f"{path}/scored")
    rest = scored.select("row", F.explode(F.arrays_zip("light", "times")).alias("_p")).select(
        "row", F.col("_p.light").alias("pair"), F.col("_p.times").alias("_times")
    )
    rare = counts.where(F.col("held") < least)
    sums = rest.join(rare, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("_times")).otherwise(0)).alias("_best"),
        F.sum(F.col("_times") * F.col("held")).alias("_sum"),
    )
    whole = scored.join(sums, "row", "left")
    added = {"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}
    return whole.withColumns(added).select(*names)
