"""Improbable-feature digests of documents.

Every window of 64 bytes has an entropy. How rare that entropy is, over all windows of all documents, ranks the window.
In each run of 64 neighbouring windows the rarest one wins a vote, and windows with enough votes are the features of
the document: they depend on the bytes around them only, so an edit elsewhere leaves them alone. Features go into Bloom
filters, a new one chained behind when the last is full. Two digests are compared filter by filter by the bits they
share beyond what chance would give.

The work on bytes is vectorised: counts inside all windows come from 63 shifted comparisons of the whole batch, the
winner of a run from a minimum doubled six times.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillmark.llm.registry import partitions, written
from tillmark.session import fresh_dir

WINDOW = 64
# Entropies are told apart in so many steps, from none to six bits.
LEVELS = 1000
# Windows below this level repeat a few bytes only and make no features.
LEAST_LEVEL = 100
VOTES = 16
FILTER_BITS = 2048
# Bits set by one feature, and features that fill a filter.
HASHES = 5
FILTER_FEATURES = 128
# Filters with fewer features are compared only where a digest has no fuller one.
LEAST_FEATURES = 16
# Bytes that are worked on at once; longer texts are longer batches of their own.
BATCH = 1 << 17

_COUNTS = np.arange(WINDOW + 2)
# n * log2(n), in units of 2**-24, so that sums are exact and the same in any batch.
_WEIGHT = np.round(np.where(_COUNTS > 0, _COUNTS * np.log2(np.maximum(_COUNTS, 1)), 0) * (1 << 24)).astype(np.int64)


def window_levels(data: np.ndarray) -> np.ndarray:
    """Entropy level of the window that starts at each byte of `data`; the last 63 bytes have none."""
    n = len(data)
    if n < WINDOW:
        return np.empty(0, np.int32)
    before = np.zeros(n, np.uint8)  # equal bytes among the 63 before
    after = np.zeros(n, np.uint8)
    for shift in range(1, WINDOW):
        same = (data[shift:] == data[:-shift]).view(np.uint8)
        before[shift:] += same
        after[:-shift] += same
    enters = _WEIGHT[before + 1] - _WEIGHT[before]  # into the 63 before it
    leaves = _WEIGHT[after + 1] - _WEIGHT[after]  # with the 63 after it still there
    total = np.cumsum(enters)
    # A window's sum of n log n: what entered up to its end, less what left before its start.
    gone = np.concatenate([[0], np.cumsum(leaves[: n - WINDOW])])
    summed = total[WINDOW - 1 :] - gone
    full = int(_WEIGHT[WINDOW])
    return ((full - summed) * (LEVELS - 1) // full).astype(np.int32)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, np.cumsum([len(t) for t in texts])


def _inside(ends: np.ndarray, windows: int) -> np.ndarray:
    """Which windows of joined texts lie in one text: those that don't start in the last 63 bytes of any."""
    inside = np.ones(windows, bool)
    for end in ends[:-1].tolist():
        inside[max(0, end - WINDOW + 1) : end] = False
    return inside


def level_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows of the texts have each entropy level."""
    data, ends = _joined(texts)
    levels = window_levels(data)
    return np.bincount(levels[_inside(ends, len(levels))], minlength=LEVELS) if len(levels) else np.zeros(LEVELS, int)


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, the rarest first; levels too low or never seen come last, as LEVELS."""
    ranks = np.full(LEVELS, LEVELS, np.int64)
    usable = np.flatnonzero((counts > 0) & (np.arange(LEVELS) >= LEAST_LEVEL))
    ranks[usable[np.lexsort((usable, counts[usable]))]] = np.arange(len(usable))
    return ranks


def select_features(data: np.ndarray, ends: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Starts of the windows that are features, over joined texts."""
    levels = window_levels(data)
    if not len(levels):
        return np.empty(0, np.int64)
    size = len(levels)
    bits = int(size).bit_length()
    inside = _inside(ends, size)
    rank = np.where(inside, ranks[levels], LEVELS)
    best = rank << bits | np.arange(size)  # the leftmost of equals wins
    width = 1
    while width < WINDOW and width < size:
        best[:-width] = np.minimum(best[:-width], best[width:])
        width *= 2
    # A run votes if it starts inside a text, and never for a window outside: those rank last.
    winner = best & ((1 << bits) - 1)
    votes = np.bincount(winner[inside & (best >> bits < LEVELS)], minlength=size)
    return np.flatnonzero(votes >= VOTES)


def _mixed(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows at `starts`."""
    words = data[starts[:, None] + np.arange(WINDOW)].view("<u8")
    value = np.full(len(starts), 0x243F6A8885A308D3, np.uint64)
    for k in range(WINDOW // 8):
        value ^= words[:, k]
        value *= np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(29))


def _filters(hashes: np.ndarray) -> bytes:
    """Chained filters of the features of one text, each with its number of features in front."""
    _, first = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(first)]  # a feature that repeats says nothing more
    count = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((count, FILTER_BITS), np.uint8)
    owner = np.arange(len(hashes)) // FILTER_FEATURES
    mask = np.uint64(FILTER_BITS - 1)
    for k in range(HASHES):
        bits[owner, (hashes >> np.uint64(11 * k)) & mask] = 1
    packed = np.packbits(bits, axis=1)
    each = np.bincount(owner, minlength=count).astype(np.uint8) if count else np.empty(0, np.uint8)
    return np.hstack([each[:, None], packed]).tobytes() if count else b""


def fingerprints(texts: list[bytes], ranks: np.ndarray) -> list[bytes]:
    """The digest of each text; one without a feature has the SHA-256 of its bytes behind a zero, so only equal texts
    are alike."""
    out: list[bytes] = []
    for group in _groups(texts):
        data, ends = _joined(group)
        starts = select_features(data, ends, ranks)
        hashes = _mixed(data, starts) if len(starts) else np.empty(0, np.uint64)
        cuts = np.searchsorted(starts, np.append(0, ends))
        for i, text in enumerate(group):
            own = hashes[cuts[i] : cuts[i + 1]]
            out.append(_filters(own) if len(own) else b"\0" + hashlib.sha256(text).digest())
    return out


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > BATCH:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: for each filter of the digest with fewer, its best match in the other, averaged.

    A match is the overlap of set bits beyond what filters so full share by chance, as a part of the most they could
    share. Digests without features are alike only if they are equal.
    """
    if a == b:
        return 1.0
    if a[:1] == b"\0" or b[:1] == b"\0" or not a or not b:
        return 0.0
    row = 1 + FILTER_BITS // 8
    x = np.frombuffer(a, np.uint8).reshape(-1, row)
    y = np.frombuffer(b, np.uint8).reshape(-1, row)
    if (len(x), a) > (len(y), b):
        x, y = y, x
    if len(x) > 1:
        x = x[x[:, 0] >= LEAST_FEATURES]
    bits_y = np.unpackbits(y[:, 1:], axis=1).astype(np.float32)
    full_y = bits_y.sum(axis=1)
    scores = []
    for start in range(0, len(x), 256):  # a block of filters at a time
        bits_x = np.unpackbits(x[start : start + 256, 1:], axis=1).astype(np.float32)
        full_x = bits_x.sum(axis=1)
        shared = bits_x @ bits_y.T
        chance = full_x[:, None] * full_y[None, :] / FILTER_BITS
        most = np.minimum(full_x[:, None], full_y[None, :])
        scores.append(np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(axis=1))
    return float(np.concatenate(scores).mean())


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8")


def corpus_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Ranks of the entropy levels, from the windows of all texts. LEVELS sums come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            for group in _groups([_bytes(t) for t in batch.column(0).to_pylist()]):
                total += level_counts(group)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["level", "n"])

    counted = docs.select(f"`{text}`").mapInArrow(count, "level long, n long")
    counts = np.zeros(LEVELS, np.int64)
    for r in counted.groupBy("level").agg(F.sum("n").alias("n")).collect():
        counts[r.level] = r.n
    return ranks_of(counts)


def fingerprint_documents(docs: DataFrame, ranks: np.ndarray, text: str = "text") -> DataFrame:
    """Add `fingerprint` (base64) to every row; null texts as empty ones. Other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf("string")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = fingerprints([_bytes(t) for t in batch.to_pylist()], shared.value)
            yield pa.array([base64.b64encode(f).decode() for f in found], pa.string())

    return docs.withColumn("fingerprint", digest(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


NEIGHBOURS = (
    "part int, place int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, text string"
)
_FIELDS = [
    ("part", pa.int32()),
    ("place", pa.int32()),
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
    ("text", pa.string()),
]
# Rows of a part: its first document once more, with its text; the documents; its last one, still without a next.
_HEAD, _ROW, _TAIL = 0, 1, 2


def _compared(rows: list[tuple[int, str, bytes]], nexts: list[tuple[str, bytes]], ranks: np.ndarray) -> list[tuple]:
    """Results of documents (doc_id, text, digest) with the text and digest of each one's next."""
    edited = []
    for (_, text, _), (following, _) in zip(rows, nexts):
        half = len(text) // 2
        edited.append(_bytes(text[: len(text) - half] + following[:half]))
    digests = fingerprints(edited, ranks)
    return [
        (
            doc_id,
            len(text),
            hashlib.sha256(changed).hexdigest(),
            base64.b64encode(own).decode(),
            base64.b64encode(other).decode(),
            likeness(own, other),
            likeness(own, following),
        )
        for (doc_id, text, own), (_, following), changed, other in zip(rows, nexts, edited, digests)
    ]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)], [name for name, _ in _FIELDS]
    )


def compare_neighbours(docs: DataFrame, ranks: np.ndarray, text: str = "text") -> DataFrame:
    """Fingerprint every document and its edited text, and compare it with both its edited text and the next document.

    The edited text has the last floor(n/2) of n code points replaced by the first as many (or all) of the next
    document's, in ascending order of doc_id (then of text); the last one's next is the first. Null texts are empty.
    Rows without a doc_id come first. A lone document is its own next. An empty table gives no rows. Other columns are
    not read.

    The texts are dealt out once, by ranges of doc_id. Inside a range each document is followed by its next; only the
    last of each range waits for the first of the range behind it, and these few are joined afterwards.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    path = fresh_dir(spark, "fingerprints")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, head = TaskContext.get().partitionId(), None, True
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            digests = fingerprints([_bytes(t) for t in texts], shared.value)
            rows = list(zip(ids, texts, digests))
            if head and rows:
                first = rows[0]
                coded = base64.b64encode(first[2]).decode()
                yield _batch([(part, _HEAD, first[0], None, None, coded, None, None, None, first[1])])
                head = False
            if held is not None:
                rows.insert(0, held)
            if not rows:
                continue
            held = rows.pop()
            nexts = [(t, d) for _, t, d in [*rows[1:], held]]
            done = _compared(rows, nexts, shared.value)
            if done:
                yield _batch([(part, _ROW, *r, None) for r in done])
        if held is not None:
            coded = base64.b64encode(held[2]).decode()
            yield _batch([(part, _TAIL, held[0], None, None, coded, None, None, None, held[1])])

    named = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    ordered = named.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    rows = written(ordered.mapInArrow(within, NEIGHBOURS), path, compression="zstd")
    # One head for each part: its number of partitions, never more.
    parts = rows.where(F.col("place") == _HEAD).select("part")
    order = Window.orderBy("part")
    lowest = F.first("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = parts.select("part", F.coalesce(F.lead("part").over(order), lowest).alias("_following"))
    heads = rows.where(F.col("place") == _HEAD).select(
        F.col("part").alias("_following"), F.col("text").alias("_next"), F.col("fingerprint").alias("_next_digest")
    )
    ends = rows.where(F.col("place") == _TAIL).join(following, "part").join(heads, "_following")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, digests, nexts, others = [c.to_pylist() for c in batch.columns]
            if not ids:
                continue
            own = list(zip(ids, texts, map(base64.b64decode, digests)))
            done = _compared(own, list(zip(nexts, map(base64.b64decode, others))), shared.value)
            yield _batch([(0, _ROW, *r, None) for r in done])

    ended = ends.select("doc_id", "text", "fingerprint", "_next", "_next_digest").mapInArrow(across, NEIGHBOURS)
    return rows.where(F.col("place") == _ROW).unionByName(ended).drop("part", "place", "text")
