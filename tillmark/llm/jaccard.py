"""Exact similarity join of documents on word shingles, with skipping by relations between sets.

Documents of equal sets form a class, and classes are joined. Shingles are ordered by how few documents hold them. Two
sets of Jaccard similarity 3/4 or more share a shingle in the first n - ceil(3n/4) + 1 of each (its prefix), so only
lists of shingles that prefixes share are looked at:

- Shingles that no other document holds come first in that order and need no list. Most documents have enough of them
  to fill their prefix and are done.
- Index-level skipping: lists are divided into blocks of sizes, and an entry is left out of a block whose sets its
  position in its own set rules out. Blocks that cannot link never meet.
- Answer-level skipping: each class of a block is compared with one leader. What the others have in common with each
  other follows from their differences to a set that stands for the block (stars.py): the overlap of two sets is that
  of their differences, corrected by their sizes. Most links need no common difference and are derived from weights
  alone; for the others, only classes that share enough differences, rarest first, are compared.

So a group of copies costs a few comparisons a member, not one a pair. How many documents hold a shingle is counted
over all documents: map tasks send sorted blocks of hash prefixes to ranges of the hash, and shingles frequent inside a
block are summed before they are sent.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.components import components
from tillmark.llm.pieces import forget, release, released
from tillmark.llm.registry import partitions, written, written_by
from tillmark.llm.shingles import shingle_sets
from tillmark.llm.stars import star_links
from tillmark.session import fresh_dir

# A shingle in more documents of a batch than this is sent as a sum.
FREQUENT = 64
# Similarity from which two documents link: P / Q.
P, Q = 3, 4
# Class ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
# Two 32-bit counts in front of each block.
_HEAD = 8


def _head(a: int, b: int) -> bytes:
    return struct.pack("<II", a, b)


def _counts(block: bytes) -> tuple[int, int]:
    return struct.unpack_from("<II", block)


def class_of(own: np.ndarray) -> int:
    """Id of a set: a 64-bit hash of its sorted shingles, as a signed number."""
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def describe(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, the class of the set (null without words) and a hash of the text, of every row."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in released(batches):
            found = shingle_sets(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array([class_of(s) if len(s) else None for s in found], pa.int64()),
                    batch.column(2),
                ],
                ["doc_id", "n_shingles", "class", "text_hash"],
            )

    own = F.col(f"`{text}`")
    named = docs.select(F.col("doc_id").cast("long"), own.alias("text"), F.xxhash64(own).alias("text_hash"))
    return named.mapInArrow(sets, "doc_id long, n_shingles long, class long, text_hash long")


def _planes(values: np.ndarray) -> bytes:
    """Bytes of 32-bit numbers, all first bytes, then all second ones and so on: sorted numbers compress better so."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes, at: int, count: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, 4 * count, at).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


class Ranges:
    """Equal ranges of the leading bits of a hash; inside a range a shingle is a 32-bit number."""

    def __init__(self, count: int):
        self.count = count
        self.bits = 32 + count.bit_length() - 1
        self.starts = np.array([-(-(r << self.bits) // count) for r in range(count)], np.uint64)

    def lead(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.bits)

    def split(self, leads: np.ndarray) -> np.ndarray:
        """Where each range starts among sorted leads, and the end."""
        return np.append(np.searchsorted(leads, self.starts), len(leads))


def _requests(ranges: Ranges):
    """Map side: of each batch, the shingles that go to each range, and what stays with the batch (range -1)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        part, number = TaskContext.get().partitionId(), 0
        for batch in released(batches):
            sets = [s for s in shingle_sets(batch.column(0).to_pylist()) if len(s)]
            for start in range(0, len(sets), 1 << 16):  # documents are numbered in 16 bits
                group = sets[start : start + (1 << 16)]
                sizes = np.array([len(s) for s in group], np.uint32)
                lead = ranges.lead(np.concatenate(group))
                order = np.argsort(lead, kind="stable")
                lead = lead[order]
                doc = np.repeat(np.arange(len(group), dtype=np.uint16), sizes)[order]
                first = np.flatnonzero(np.diff(lead, prepend=lead[:1] ^ np.uint64(1)))
                held = np.diff(np.append(first, len(lead)))
                often = held > FREQUENT
                kept = np.repeat(~often, held)
                stay = np.flatnonzero(~kept)
                rows = [
                    (
                        -1,
                        _head(len(group), len(stay))
                        + sizes.tobytes()
                        + np.array([class_of(s) for s in group], np.int64).tobytes()
                        + doc[stay].tobytes()
                        + lead[stay].tobytes(),
                    )
                ]
                top, counts = lead[first[often]], held[often].astype(np.uint32)
                lead, doc = lead[kept], doc[kept]
                at, top_at = ranges.split(lead), ranges.split(top)
                for r in range(ranges.count):
                    a, b, c, d = at[r], at[r + 1], top_at[r], top_at[r + 1]
                    if b > a or d > c:
                        base = ranges.starts[r]
                        rows.append(
                            (
                                r,
                                _head(b - a, d - c)
                                + _planes(lead[a:b] - base)
                                + doc[a:b].tobytes()
                                + _planes(top[c:d] - base)
                                + counts[c:d].tobytes(),
                            )
                        )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r for r, _ in rows], pa.int32()),
                        pa.array([part << 32 | number] * len(rows), pa.int64()),
                        pa.array([x for _, x in rows], pa.binary()),
                    ],
                    ["range", "batch", "block"],
                )
                number += 1

    return send


def _answer(blocks: list[bytes]) -> list[bytes]:
    """Reduce side of a range: for each block what of it several documents hold, and how many do."""
    heads = [_counts(b) for b in blocks]
    leads, weights, docs = [], [], []
    for block, (pairs, tops) in zip(blocks, heads):
        at = _HEAD
        leads.append(_from_planes(block, at, pairs))
        docs.append(np.frombuffer(block, "<u2", pairs, at + 4 * pairs))
        at += 6 * pairs
        leads.append(_from_planes(block, at, tops))
        weights += [np.ones(pairs, np.int64), np.frombuffer(block, "<u4", tops, at + 4 * tops).astype(np.int64)]
    every = np.concatenate(leads)
    order = np.argsort(every, kind="stable")
    first = np.flatnonzero(np.diff(every[order].astype(np.int64), prepend=-1))
    total = np.add.reduceat(np.concatenate(weights)[order], first) if len(first) else np.empty(0, np.int64)
    spread = np.empty(len(every), np.int64)
    spread[order] = np.repeat(total, np.diff(np.append(first, len(every))))
    spread = np.minimum(spread, 65_535).astype(np.uint16)
    answers, at = [], 0
    for (pairs, tops), doc, own, top in zip(heads, docs, leads[::2], leads[1::2]):
        count = spread[at : at + pairs]
        many = np.flatnonzero(count > 1)
        top_count = spread[at + pairs : at + pairs + tops]
        at += pairs + tops
        answers.append(
            _head(len(many), tops)
            + _planes(own[many])
            + doc[many].tobytes()
            + count[many].tobytes()
            + top.tobytes()
            + top_count.tobytes()
        )
    return answers


def _count_range(table: pa.Table) -> pa.Table:
    """Answers of one range; what stays with the batches passes through."""
    number = table.column("range")[0].as_py()
    if number >= 0:
        blocks = pa.array(_answer(table.column("block").to_pylist()), pa.binary())
        release()
        table = table.set_column(table.schema.get_field_index("block"), "block", blocks)
    return table.select(["range", "batch", "block"])


def _prefixes(ranges: Ranges):
    """Per batch: the shared part of the prefix of each document that has one, in the order of all shingles."""

    def order(table: pa.Table) -> pa.Table:
        leads, docs, counts, tops, top_counts = [], [], [], [], []
        sizes = classes = stay_doc = stay_lead = None
        for r, block in zip(table.column("range").to_pylist(), table.column("block").to_pylist()):
            a, b = _counts(block)
            at = _HEAD
            if r < 0:
                sizes = np.frombuffer(block, "<u4", a, at).astype(np.int64)
                classes = np.frombuffer(block, "<i8", a, at + 4 * a)
                at += 12 * a
                stay_doc, stay_lead = np.frombuffer(block, "<u2", b, at), np.frombuffer(block, "<u8", b, at + 2 * b)
                continue
            base = ranges.starts[r]
            leads.append(_from_planes(block, at, a).astype(np.uint64) + base)
            docs.append(np.frombuffer(block, "<u2", a, at + 4 * a))
            counts.append(np.frombuffer(block, "<u2", a, at + 6 * a))
            at += 8 * a
            tops.append(np.frombuffer(block, "<u4", b, at).astype(np.uint64) + base)
            top_counts.append(np.frombuffer(block, "<u2", b, at + 4 * b))
        if len(stay_lead):
            top, top_count = np.concatenate(tops), np.concatenate(top_counts)
            by = np.argsort(top)
            leads.append(stay_lead)
            docs.append(stay_doc)
            counts.append(top_count[by][np.searchsorted(top[by], stay_lead)])
        none = np.empty(0, np.uint16)
        lead = np.concatenate([np.empty(0, np.uint64), *leads])
        doc, count = np.concatenate([none, *docs]), np.concatenate([none, *counts])
        by = np.lexsort((lead, count, doc))
        lead = lead[by]
        shared = np.bincount(doc, minlength=len(sizes))
        alone = sizes - shared
        wanted = sizes - -(-3 * sizes // 4) + 1 - alone
        ends = np.cumsum(shared)
        rows = np.flatnonzero((wanted > 0) & (shared > 0))
        parts = [lead[ends[i] - shared[i] : ends[i] - shared[i] + wanted[i]].astype(np.int64) for i in rows.tolist()]
        return pa.table(
            {
                "class": pa.array(classes[rows], pa.int64()),
                "n": pa.array(sizes[rows], pa.int64()),
                "alone": pa.array(alone[rows], pa.int64()),
                "shingles": pa.array(parts, pa.list_(pa.int64())),
            }
        )

    return order


def prefixes(docs: DataFrame, text: str = "text") -> DataFrame:
    """class, n, alone, shingles: of each class that may have a link, the shingles of its prefix that other documents
    hold too, rarest first; `alone` others of its own come before them."""
    ranges = Ranges(4 * partitions(docs.sparkSession))
    sent = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(
        _requests(ranges), "range int, batch long, block binary"
    )
    # What stays with the batches is spread over the tasks too.
    key = F.when(F.col("range") >= 0, F.col("range")).otherwise(-1 - F.pmod(F.xxhash64("batch"), F.lit(ranges.count)))
    counted = sent.withColumn("_key", key.cast("int")).groupBy("_key").applyInArrow(
        _count_range, "range int, batch long, block binary"
    )
    found = counted.groupBy("batch").applyInArrow(
        _prefixes(ranges), "class long, n long, alone long, shingles array<long>"
    )
    # Copies have equal prefixes.
    return found.groupBy("class").agg(
        F.first("n").alias("n"), F.first("alone").alias("alone"), F.first("shingles").alias("shingles")
    )


def sets_of(docs: DataFrame, classes: DataFrame, described: DataFrame, text: str = "text") -> DataFrame:
    """class and set (sorted 64-bit hashes, binary) of the wanted classes, from one document of each."""
    wanted = described.join(classes, "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    ids = wanted.select(F.col("doc_id").alias("_wanted")).distinct()
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            found = [s for s in shingle_sets(batch.column(0).to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([class_of(s) for s in found], pa.int64()),
                    pa.array([s.astype("<u8").tobytes() for s in found], pa.binary()),
                ],
                ["class", "set"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col(f"`{text}`").alias("text"))
    chosen = own.join(ids, F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi").select("text")
    found = chosen.mapInArrow(sets, "class long, set binary")
    return found.repartition(partitions(docs.sparkSession), "class").dropDuplicates(["class"])


def blocks(index: DataFrame) -> DataFrame:
    """shingle, block and class: the lists of the prefixes' shingles, in blocks of sizes that may link.

    Sizes fall into classes, each from 4/3 of the one before on. Sets that link are of one class or of neighbouring
    ones, so an entry goes to the block of its own class and to the next, where it meets larger sets. There its place
    decides: with i of its n elements passed, and partners of `least` elements or more, it is skipped unless
    7 (n - i) >= 3 (n + least). Blocks whose sizes or places rule a link out thus never meet.
    """
    entries = index.select("class", "n", "alone", F.posexplode("shingles").alias("_i", "shingle"))
    entries = entries.withColumns({"place": F.col("alone") + F.col("_i"), "_class": _size_class(F.col("n"))})
    both = entries.withColumn("block", F.explode(F.array(F.col("_class"), F.col("_class") + 1)))
    least = F.pow(F.lit(4 / 3), F.col("block"))
    # A hair below, for the rounding of logarithms and powers.
    reached = 7 * (F.col("n") - F.col("place")) >= 3 * (F.col("n") + least) * (1 - 1e-9)
    return both.where((F.col("block") == F.col("_class")) | reached).select("shingle", "block", "class")


def _size_class(n: Column) -> Column:
    """The largest c with (4/3)^c <= n, or one less or more where rounding decides; equal sizes have equal classes."""
    return F.floor(F.log(n) / F.log(F.lit(4 / 3)) + 1e-9).cast("int")


def link_classes(docs: DataFrame, described: DataFrame, text: str = "text") -> DataFrame:
    """Roots of classes (node, root) that have a link to another class."""
    path = fresh_dir(docs.sparkSession, "jaccard")
    index = written(prefixes(docs, text), f"{path}/prefixes")
    entries = blocks(index)
    lists = entries.groupBy("shingle", "block").agg(F.min("class").alias("leader"), F.max("class").alias("_last"))
    lists = lists.where(F.col("leader") != F.col("_last")).drop("_last")
    stars = entries.join(lists, ["shingle", "block"]).where(F.col("class") != F.col("leader"))
    stars = written(stars.select("leader", "class").distinct(), f"{path}/stars")
    ends = stars.select("class").unionByName(stars.select(F.col("leader").alias("class"))).distinct()
    sets = written_by(sets_of(docs, ends, described, text), "class", f"{path}/sets", compression="none")
    return components(star_links(stars, sets, P, Q, path))


def _resolved(docs: DataFrame, text: str) -> DataFrame:
    """What near_duplicates returns, with text_hash and _root, which tells components apart (null without words)."""
    path = fresh_dir(docs.sparkSession, "near-duplicates")
    described = written(describe(docs, text), f"{path}/described")
    roots = link_classes(docs, described, text)
    rooted = described.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "doc_id", "n_shingles", "text_hash", F.coalesce("root", "class").alias("_root")
    )
    least = rooted.where(F.col("_root").isNotNull()).groupBy("_root").agg(F.min("doc_id").alias("_least"))
    return rooted.join(least, "_root", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"),
        "text_hash",
        "_root",
    )


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id that links lead to) of every row.

    Two documents link when 100 * intersection >= 75 * union of their sets of five-word shingles; with fewer words, all
    of them are one shingle. Null texts and texts without words have no shingle, no link, and are their own component.
    Rows that share a doc_id are documents of their own. Rows without a doc_id link like others; a component of such
    rows alone has none. An empty table gives no rows; other columns are not read.
    """
    return _resolved(docs, text).drop("text_hash", "_root")


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """One document of each component: that of smallest doc_id, those without one last, then by a hash of the text.

    Documents without words all stay. Of rows alike in doc_id and text one stays, whichever sorts first by a hash of
    the other columns. All columns stay.
    """
    found = _resolved(docs, text).where(F.col("_root").isNotNull())
    found = written(found, f"{fresh_dir(docs.sparkSession, 'keep-one')}/rows")
    key = F.struct(F.col("doc_id").isNull().alias("_last"), "doc_id", "text_hash")
    first = found.groupBy("_root").agg(F.min(key).alias("_first")).select("_root", "_first.doc_id", "_first.text_hash")
    rows = found.groupBy("_root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_rows"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("_root", "doc_id", "text_hash")]
    others = rows.alias("r").join(first.alias("f"), same, "left_anti")
    dropped = others.select(F.col("doc_id").alias("_keep_for"), F.col("text_hash").alias("_keep_of"))
    again = rows.where("_rows > 1").select(F.col("doc_id").alias("_keep_for"), F.col("text_hash").alias("_keep_of"))
    marked = docs.withColumns({"_keep_id": F.col("doc_id").cast("long"), "_keep_hash": F.xxhash64(F.col(f"`{text}`"))})
    match = F.col("_keep_id").eqNullSafe(F.col("_keep_for")) & (F.col("_keep_hash") == F.col("_keep_of"))
    kept = marked.join(dropped, match, "left_anti")
    repeated = kept.join(again, match, "left_semi")
    alike = Window.partitionBy("_keep_id", "_keep_hash").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    repeated = repeated.withColumn("_keep_rank", F.row_number().over(alike)).where("_keep_rank = 1")
    return kept.join(again, match, "left_anti").select(*docs.columns).unionByName(repeated.select(*docs.columns))
