"""Near duplicates by SuperMinHash signatures, banding, verification on the full sets and union-find by stars.

A SuperMinHash signature has one value for each of m components: an element d meets component k at rank j of a random
permutation of its own, with the value j + r, r uniform in [0, 1), and a component keeps its least value. An element
takes every rank once, so the components of a signature depend on one another, and estimates vary less than with
independent minima. With m prime the permutations are the affine maps of the integers modulo m: any two ranks of an
element are distributed as under a uniformly random permutation, and no permutation has to be stored.

Ranks are gone through in turn, for all elements of a batch of documents at once. Once every component of a document
has a value, later ranks can only be larger: its signature is complete and its elements leave the batch. That takes
about m ln m steps a document beyond its first rank.

Bands of eight components are hashed to buckets. Two sets of similarity 0.8 share none of 64 buckets with probability
8e-6, far less above it. Classes of equal sets that share a bucket meet in the star of its smallest class, where all
links are found and confirmed on the full sets (stars.py): no bucket is capped, and no pairs of a bucket are formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.components import components
from tillmark.llm.pieces import forget, released
from tillmark.llm.registry import written, written_by
from tillmark.llm.shingles import shingle_sets
from tillmark.llm.stars import star_links
from tillmark.session import fresh_dir

WORDS = 2
# Similarity from which two documents link: P / Q.
P, Q = 4, 5
BANDS, ROWS = 64, 8
# The smallest prime that holds all bands.
COMPONENTS = 521
# Elements and documents whose signatures are worked on at once.
ELEMENTS, DOCUMENTS = 1 << 18, 256
# Documents that are broadcast by id at most; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

_STEP = 0x9E3779B97F4A7C15
# A value is its rank above 54 bits of its fraction.
_FRACTION = 54
_TESTED_EVERY = 4


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def signatures(sets: list[np.ndarray], m: int = COMPONENTS) -> np.ndarray:
    """One row of m (a prime) values for each set; that of an empty set is all ones."""
    values = np.full(len(sets) * m, np.iinfo(np.uint64).max, np.uint64)
    element = np.concatenate([np.empty(0, np.uint64), *sets])
    first = np.repeat(np.arange(len(sets)) * m, [len(s) for s in sets])
    component = (_mix(element ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(m)).astype(np.int64)
    stride = (_mix(element ^ np.uint64(0x14057B7EF767814F)) % np.uint64(m - 1)).astype(np.int64) + 1
    for rank in range(m):
        fraction = _mix(element + np.uint64(rank * _STEP & (1 << 64) - 1)) >> np.uint64(64 - _FRACTION)
        np.minimum.at(values, first + component, fraction | np.uint64(rank << _FRACTION))
        if rank % _TESTED_EVERY == 0:
            docs, place = np.unique(first, return_inverse=True)
            full = values.reshape(-1, m)[docs // m].max(axis=1) < np.uint64(rank + 1 << _FRACTION)
            live = ~full[place]
            element, first, component, stride = element[live], first[live], component[live], stride[live]
        if not len(element):
            break
        component += stride
        component[component >= m] -= m
    return values.reshape(-1, m)


def estimate(x: np.ndarray, y: np.ndarray) -> float:
    """The similarity of two sets by their signatures."""
    return float(np.mean(x == y))


def bands(rows: np.ndarray) -> np.ndarray:
    """The bucket of each band of each signature."""
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * np.uint64(_STEP), (len(rows), BANDS))
    for k in range(ROWS):
        keys = _mix(keys * np.uint64(31) + rows[:, k : BANDS * ROWS : ROWS])
    return keys.view(np.int64)


def _groups(sets: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    group, size = [], 0
    for own in sets:
        if group and (len(group) == DOCUMENTS or size + len(own) > ELEMENTS):
            yield group
            group, size = [], 0
        group.append(own)
        size += len(own)
    if group:
        yield group


def digest(own: np.ndarray) -> bytes | None:
    """128 bits that stand for a set; none for the empty set."""
    return xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None


def describe(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, the digest of the set and the buckets of its bands (null without words), of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in released(batches):
            found = shingle_sets(batch.column(1).to_pylist(), WORDS)
            digests = [digest(s) for s in found]
            # Copies in a batch share one signature.
            distinct = {d: s for d, s in zip(digests, found) if d}
            keys = [bands(signatures(group)) for group in _groups(list(distinct.values()))]
            keys = dict(zip(distinct, np.concatenate(keys))) if keys else {}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([keys.get(d) for d in digests], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "buckets"],
            )

    named = docs.select(F.col("doc_id").cast("long"), F.col(f"`{text}`").alias("text"))
    found = named.mapInArrow(work, "doc_id long, n_shingles long, digest binary, buckets array<long>")
    return found.withColumn("row", F.monotonically_increasing_id())


def sets_of(docs: DataFrame, classes: DataFrame, text: str = "text") -> DataFrame:
    """class and set (sorted 64-bit hashes, binary) of classes (class, digest, doc_id of one of its documents)."""
    ids = classes.select(F.col("doc_id").alias("_wanted")).distinct()
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            found = [s for s in shingle_sets(batch.column(0).to_pylist(), WORDS) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest(s) for s in found], pa.binary()),
                    pa.array([s.astype("<u8").tobytes() for s in found], pa.binary()),
                ],
                ["digest", "set"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col(f"`{text}`").alias("text"))
    chosen = own.join(ids, F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi").select("text")
    found = chosen.mapInArrow(work, "digest binary, set binary").dropDuplicates(["digest"])
    return found.join(classes.select("class", "digest"), "digest").select("class", "set")


def link_classes(docs: DataFrame, described: DataFrame, text: str = "text") -> DataFrame:
    """Roots of classes (node, root) that have a link to another class. A class is named by its smallest row."""
    path = fresh_dir(docs.sparkSession, "superminhash")
    classes = described.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("row").alias("class"), F.min("doc_id").alias("doc_id"), F.first("buckets").alias("buckets")
    )
    classes = written(classes, f"{path}/classes")
    entries = classes.select("class", F.explode("buckets").alias("bucket"))
    # One exchange of the entries; a class of copies has one in each bucket.
    led = entries.withColumn("leader", F.min("class").over(Window.partitionBy("bucket")))
    stars = led.where(F.col("class") != F.col("leader")).select("leader", "class").distinct()
    stars = written(stars, f"{path}/stars")
    ends = stars.select("class").unionByName(stars.select(F.col("leader").alias("class"))).distinct()
    wanted = classes.select("class", "digest", "doc_id").join(ends, "class", "left_semi")
    sets = written_by(sets_of(docs, wanted, text), "class", f"{path}/sets", compression="none")
    return components(star_links(stars, sets, P, Q, path))


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links lead to) and kept of every row.

    Two documents link when 100 * intersection >= 80 * union of their sets of two-word shingles; with fewer words, all
    of them are one shingle. Null texts and texts without words have no shingle, no link, and are their own component.
    Rows that share a doc_id are documents of their own. Rows without a doc_id link like others; a component of such
    rows alone has no component_id. `kept` is true where doc_id equals component_id, and false without a doc_id. An
    empty table gives no rows; other columns are not read.
    """
    path = fresh_dir(docs.sparkSession, "superminhash-rows")
    described = written(describe(docs, text), f"{path}/described")
    roots = link_classes(docs, described, text)
    named = described.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("row").alias("node"))
    named = named.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("_root"))
    rows = described.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    least = rows.where(F.col("_root").isNotNull()).groupBy("_root").agg(F.min("doc_id").alias("_least"))
    found = rows.join(least, "_root", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("_least"))
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
