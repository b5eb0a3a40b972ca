"""Benchmark decontamination: short test items found inside long documents.

Items and documents are sets of word shingles, ordered by a 64-bit hash (a min-wise order). A document that holds the
share `least` of an item's n shingles misses at most n - ceil(least * n) of them, so it holds one of the item's
n - ceil(least * n) + 1 smallest. Items are partitioned by size, each partition with the signature length that its
largest size needs; documents are probed with all their shingles against the signatures. Containment, unlike Jaccard
similarity, doesn't thin out with the length of the document, and no true pair is lost. Candidates are then verified
on the shingles themselves, as text.

All of it is built-in functions. The signatures are broadcast in blocks of a fixed number of rows; a benchmark of more
rows takes more blocks, not larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.registry import written
from tillmark.session import fresh_dir

WORDS = 5
LEAST = 0.75
# Rows of signatures, shingles or candidate ids that are broadcast at once.
BLOCK_ROWS = 500_000
_SPACE = r"[ \t\n\x0B\f\r]+"


def words_of(text: Column) -> Column:
    """Lower-cased words between white space."""
    return F.filter(F.split(F.lower(text), _SPACE), lambda w: w != "")


def _shingles(words: Column, width: int) -> Column:
    """All runs of `width` words, as text."""
    return F.when(
        F.size(words) >= width,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.array_join(F.slice(words, i, width), " ")
        ),
    ).otherwise(F.array().cast("array<string>"))


def _hashes(word_hashes: Column, width: int) -> Column:
    """A hash of each run of `width` words, from the hashes of the words."""
    return F.when(
        F.size(word_hashes) >= width,
        F.transform(
            F.slice(word_hashes, 1, F.size(word_hashes) - width + 1),
            lambda h, i: F.xxhash64(h, *[F.get(word_hashes, i + k) for k in range(1, width)]),
        ),
    ).otherwise(F.array().cast("array<long>"))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def item_shingles(items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WORDS) -> DataFrame:
    """_item, _width, _n (shingles of the item), _shingle, _hash. Items of fewer words are one shingle of all."""
    words = items.select(F.col(f"`{item_id}`").alias("_item"), words_of(F.col(f"`{text}`")).alias("_words"))
    words = words.where(F.size("_words") > 0).withColumn("_width", F.least(F.lit(width), F.size("_words")))
    shingled = F.coalesce(*[F.when(F.col("_width") == w, _shingles(F.col("_words"), w)) for w in range(1, width + 1)])
    hashed = F.coalesce(
        *[F.when(F.col("_width") == w, _hashes(_word_hashes(F.col("_words")), w)) for w in range(1, width + 1)]
    )
    each = words.select("_item", "_width", F.explode(F.arrays_zip(shingled.alias("s"), hashed.alias("h"))).alias("_e"))
    each = each.select("_item", "_width", F.col("_e.s").alias("_shingle"), F.col("_e.h").alias("_hash")).distinct()
    sizes = each.groupBy("_item").agg(F.count(F.lit(1)).alias("_n"))
    return each.join(sizes, each["_item"].eqNullSafe(sizes["_item"])).drop(sizes["_item"])


def signatures(shingles: DataFrame, least: float) -> DataFrame:
    """Of each item the smallest hashes, as many as its size partition needs: that of the sizes up to a power of two."""
    top = F.pow(F.lit(2.0), F.ceil(F.log2("_n")))
    length = top - F.ceil(F.lit(least) * top - 1e-9) + 1
    listed = shingles.groupBy("_item", "_width", "_n").agg(F.array_sort(F.collect_set("_hash")).alias("_hashes"))
    return listed.select(
        "_item", "_width", F.explode(F.slice(F.col("_hashes"), F.lit(1), length.cast("int"))).alias("_hash")
    )


def find_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    width: int = WORDS,
    least: float = LEAST,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of a document and an item of whose shingles it holds the share `least` or more.

    Columns: doc_id, item_id, item_shingles, shared, containment. Null and empty texts, and items without words, match
    nothing; an item of fewer than `width` words is matched as one run of all its words. Rows that share a doc_id (or
    an item_id) are read as one; null ids count as one id. Either table may be empty. Other columns are not read.
    """
    spark = docs.sparkSession
    path = fresh_dir(spark, "decontaminate")
    shingles = written(item_shingles(items, item_id, width=width), f"{path}/items")
    found = shingles.agg(F.count(F.lit(1)), F.collect_set("_width")).first()  # at most `width` widths
    widths = sorted(found[1])
    blocks = max(1, -(-found[0] // block_rows))
    own = docs.select(F.col(f"`{doc_id}`").alias("_doc"), F.col(f"`{text}`").alias("_text"))
    block = F.pmod(F.xxhash64("_item"), F.lit(blocks))
    probes = signatures(shingles, least)

    def pairs_of(number: int) -> DataFrame:
        probe = F.broadcast(probes.where(block == number))
        hashed = own.select("_doc", _word_hashes(words_of(F.col("_text"))).alias("_words"))
        parts = [
            hashed.select("_doc", F.lit(w).alias("_width"), F.explode(_hashes(F.col("_words"), w)).alias("_hash"))
            for w in widths
        ]
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part)
        return union.join(probe, ["_width", "_hash"]).select("_doc", "_item")

    columns = [F.col("_doc").alias("doc_id"), F.col("_item").alias("item_id"), "item_shingles", "shared", "containment"]
    if not widths:  # no item has a word
        empty = own.join(shingles.limit(0), F.lit(False)).limit(0)
        return empty.select(
            F.col("_doc").alias("doc_id"),
            F.col("_item").alias("item_id"),
            F.lit(0).cast("long").alias("item_shingles"),
            F.lit(0).cast("long").alias("shared"),
            F.lit(0.0).alias("containment"),
        )
    candidates = pairs_of(0)
    for number in range(1, blocks):
        candidates = candidates.unionByName(pairs_of(number))
    candidates = written(candidates.distinct(), f"{path}/candidates")
    # Verification reads the candidates' documents only; their ids are broadcast where they are few.
    suspects = candidates.select(F.col("_doc").alias("_suspect")).distinct()
    if suspects.count() <= block_rows:
        suspects = F.broadcast(suspects)
    texts = own.join(suspects, F.col("_doc").eqNullSafe(F.col("_suspect")), "left_semi")
    pairs = candidates.join(
        shingles.select(F.col("_item").alias("_of"), "_width", "_n", "_shingle"),
        F.col("_item").eqNullSafe(F.col("_of")),
    ).drop("_of")
    held = texts.select("_doc", words_of(F.col("_text")).alias("_words"))
    parts = [
        held.select("_doc", F.lit(w).alias("_width"), F.explode(_shingles(F.col("_words"), w)).alias("_shingle"))
        for w in widths
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    # Only shingles that some candidate item has are worth shuffling.
    listed = shingles.select("_width", "_shingle").distinct()
    if found[0] <= block_rows:
        listed = F.broadcast(listed)
    union = union.join(listed, ["_width", "_shingle"], "left_semi").distinct()
    wanted = pairs.withColumnRenamed("_doc", "_wanted")
    shared = (
        union.join(
            wanted.withColumnRenamed("_width", "_w").withColumnRenamed("_shingle", "_s"),
            F.col("_doc").eqNullSafe(F.col("_wanted"))
            & (F.col("_width") == F.col("_w"))
            & (F.col("_shingle") == F.col("_s")),
        )
        .groupBy("_doc", "_item", "_n")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    scored = shared.withColumns(
        {"item_shingles": F.col("_n"), "containment": F.col("shared") / F.col("_n").cast("double")}
    )
    return scored.where(F.col("containment") >= least - 1e-12).select(*columns)


def without_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    by_row: bool = False,
    **options,
) -> DataFrame:
    """The documents that hold no item; all columns and repeated rows stay.

    Rows that share a doc_id, null included, are read as one document and go together. With `by_row` each row is judged
    by its own text alone: rows are told apart by doc_id and a 64-bit hash of the text.
    """
    if not by_row:
        dirty = find_items(docs, items, doc_id, text, **options).select(F.col("doc_id").alias("_dirty")).distinct()
        return docs.join(dirty, docs[doc_id].eqNullSafe(F.col("_dirty")), "left_anti")
    row = F.struct(docs[doc_id].alias("id"), F.xxhash64(docs[text]).alias("hash"))
    rows = docs.select(row.alias("row"), docs[text].alias("text"))
    dirty = find_items(rows, items, "row", "text", **options).select(F.col("doc_id").alias("_dirty")).distinct()
    return docs.join(dirty, row.eqNullSafe(F.col("_dirty")), "left_anti")
