"""Merkle manifest of a table: a tree of hashes for each group of rows, one over the groups, and a proof for each row.

Rows are ranked inside their group, and a rank's octal digits name the runs of eight that a node belongs to. Blocks of
512 nodes are rolled up by grouping their digits away, lowest first: each grouping nests the structs of a run in their
parent, with the parent's hash. The hash on top of a block is a node of the next table of blocks, 512 times smaller, until
each group has one. From the top down, the path above a block is grouped together with it, and transforming its nested
structs and exploding them emits every node below with its whole path: no step joins nodes with siblings or parents, and
no task holds more than a block of a tree.

All of it is DataFrame functions. Digests are lower-case hex texts, as they enter the hashes above them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.registry import partitions, written
from tillmark.session import fresh_dir

# Nodes of a run, as a power of two, and runs above one another in a block.
DIGIT, DEPTH = 3, 3
# Rows of offsets that are broadcast at most: one for each group in each partition.
BROADCAST_ROWS = 200_000
_LARGEST = 20  # 8 ** 20 rows in a group

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon and its text; a hyphen for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return hashed(*map(field, values))


def _levels(total: Column) -> Column:
    """How many levels a tree over so many nodes has above them."""
    return sum(((total > (1 << DIGIT * k)).cast("int") for k in range(_LARGEST)), F.lit(0))


def ranked(rows: DataFrame, path: str) -> DataFrame:
    """rows (group, order, digest, item) with the rank of each in its group by order, digest, and the tree's levels.

    Rows are dealt by ranges of the whole order, a last column of which tells equal rows apart; a row's place in its
    range, and the sizes of groups in the ranges before, give its rank. A group that fills many ranges costs no more.
    """
    spark = rows.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in ("group", "order", "digest", "_row")]
    dealt = written(rows.withColumn("_row", F.monotonically_increasing_id()), f"{path}/rows")
    dealt = dealt.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    placed = written(dealt.drop("order", "_row").withColumn("_at", F.monotonically_increasing_id()), f"{path}/placed")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    sizes = placed.groupBy("group", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("group").alias("_group"), F.col("_range").alias("_in"),
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
        _levels(F.sum("_size").over(Window.partitionBy("group"))).alias("levels"),
    )
    offsets = written(offsets, f"{path}/offsets")
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    found = placed.join(offsets, F.col("group").eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_in")))
    return found.select("group", "levels", (F.col("_at") + F.col("_offset")).alias("rank"), "digest", "item")


def _fold(nodes: DataFrame, done: int, path: str) -> DataFrame:
    """group, levels, block, node: the nested struct of each block, `done` levels of the tree being below."""
    digits = [f"_d{k}" for k in range(DEPTH)]
    rows = nodes.select(
        "group", "levels", F.shiftright("rank", DIGIT * DEPTH).alias("block"),
        *[F.shiftright("rank", DIGIT * k).bitwiseAND((1 << DIGIT) - 1).alias(d) for k, d in enumerate(digits)],
        F.struct("digest", "item").alias("node"),
    ).repartition("group", "block")
    for k, digit in enumerate(digits):
        rows = rows.groupBy("group", "levels", "block", *digits[k + 1 :]).agg(
            F.sort_array(F.collect_list(F.struct(digit, "node"))).alias("_run")
        )
        rows = rows.withColumn("_run", F.transform("_run", lambda x: x["node"]))
        joined = F.concat_ws("", F.transform("_run", lambda x: x["digest"]))
        # Above its last level a tree has one node, which stays.
        digest = F.when(F.col("levels") > done + k, F.sha2(joined, 256)).otherwise(F.element_at("_run", 1)["digest"])
        rows = rows.withColumn("node", F.struct(digest.alias("digest"), F.col("_run").alias("run"))).drop("_run")
    return written(rows, path)


def _below(node: Column, depth: int, done: int, levels: Column, above: Column) -> Column:
    """All nodes at the bottom of a nested struct: item, digest, and the path of (left, right) siblings, lowest first."""
    run = node["run"]
    digests = F.transform(run, lambda x: x["digest"])

    def one(child: Column, i: Column) -> Column:
        left = F.concat_ws("", F.slice(digests, F.lit(1), i))
        right = F.concat_ws("", F.slice(digests, i + 2, F.size(digests)))
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        path = F.when(levels > done + depth - 1, F.concat(step, above)).otherwise(above)
        if depth == 1:
            return F.struct(child["item"].alias("item"), child["digest"].alias("digest"), path.alias("path"))
        return _below(child, depth - 1, done, levels, path)

    found = F.transform(run, one)
    return found if depth == 1 else F.flatten(found)


def _emit(blocks: DataFrame, above: DataFrame, done: int) -> DataFrame:
    """The nodes of all blocks with their paths to the root. above: group, block, path, subroot, root of each block."""
    blank = [F.lit(None).cast(above.schema[c].dataType).alias(c) for c in ("path", "subroot", "root")]
    none = F.lit(None)
    both = blocks.select("group", "block", "levels", "node", *blank).unionByName(
        above.select("group", "block", "path", "subroot", "root", none.cast("int").alias("levels"),
                     none.cast(blocks.schema["node"].dataType).alias("node"))
    )
    held = [F.first(c, ignorenulls=True).alias(c) for c in ("levels", "node", "path", "subroot", "root")]
    merged = both.groupBy("group", "block").agg(*held)
    found = F.explode(_below(F.col("node"), DEPTH, done, F.col("levels"), F.col("path")))
    return merged.select("group", "subroot", "root", found.alias("_n")).select("group", "subroot", "root", "_n.*")


class Trees:
    """The trees of all groups, as tables of blocks, each 512 times smaller than the one below.

    rows: group, order, digest, item (a struct that comes back with each proof).
    """

    def __init__(self, rows: DataFrame, path: str):
        nodes = ranked(rows, path)
        self.tables = [_fold(nodes, 0, f"{path}/blocks-0")]
        deepest = self.tables[0].agg(F.max("levels")).first()[0] or 0
        while DEPTH * len(self.tables) < deepest:
            nodes = self.tables[-1].select(
                "group", "levels", F.col("block").alias("rank"), F.col("node.digest").alias("digest"),
                F.struct("block").alias("item"),
            )
            done = DEPTH * len(self.tables)
            self.tables.append(_fold(nodes, done, f"{path}/blocks-{len(self.tables)}"))

    def tops(self) -> DataFrame:
        """group and digest: the root of each tree."""
        return self.tables[-1].select("group", F.col("node.digest").alias("digest"))

    def proofs(self, above: DataFrame) -> DataFrame:
        """Every row: group, item, digest, path, subroot, root. above: group, path, subroot, root of each tree."""
        above = above.withColumn("block", F.lit(0).cast("long"))
        for number in range(len(self.tables) - 1, -1, -1):
            found = _emit(self.tables[number], above, DEPTH * number)
            if number:
                above = found.select("group", F.col("item.block").alias("block"), "path", "subroot", "root")
        return found


def no_path() -> Column:
    return F.array().cast("array<struct<left: string, right: string>>")


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and its siblings lead to."""
    return F.aggregate(path, digest, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256))


def proof_hash(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda x: F.concat(x["left"], x["right"]))), 256)


def manifest(leaves: DataFrame) -> DataFrame:
    """group, item, digest, path, subroot, root of every leaf.

    leaves: group, order (any types that sort, nulls first), digest and item (a struct). Leaves of equal order are taken
    by digest. A group of one leaf has that as its subroot; one group alone has its subroot as root. A path holds one
    (left, right) of concatenated siblings for each level up to the root. No leaves, no rows.
    """
    path = fresh_dir(leaves.sparkSession, "merkle")
    trees = Trees(leaves, f"{path}/rows")
    groups = trees.tops().select(
        F.lit(0).alias("group"), F.col("group").alias("order"), "digest", F.struct("group").alias("item")
    )
    top = Trees(groups, f"{path}/groups")
    root = top.tops().select("group", no_path().alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    above = top.proofs(root).select(F.col("item.group").alias("group"), "path", F.col("digest").alias("subroot"), "root")
    return trees.proofs(written(above, f"{path}/above"))


def verify(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of documents.

    A leaf covers doc_id, source, lang, n_chars and text, null or not; groups are languages (null is one). Where
    `tampered` holds, the root is folded from the row with its text's A-Z lower-cased; else from the row as it is. Rows
    without a doc_id come first in their language, rows that share one by their hash; rows alike in all five columns
    are leaves of their own. Where `tampered` is null, the row counts as untouched. Other columns are not read.
    """
    kept = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.when(tampered, leaf_hash(*kept, F.translate("text", UPPER, LOWER)))
    leaves = docs.select(
        F.col("lang").alias("group"), F.col("doc_id").alias("order"), leaf_hash(*kept, F.col("text")).alias("digest"),
        F.struct("doc_id", changed.alias("changed")).alias("item"),
    )
    folded = fold(F.coalesce("item.changed", "digest"), F.col("path"))
    return manifest(leaves).select(
        "item.doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
