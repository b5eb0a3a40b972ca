"""Links among the sets around a leader, from their differences to a common centre instead of all their pairs.

Take sets x, y and any centre of n elements. x lacks d(x) elements of the centre and has a(x) others, and s of these
differences are common to x and y. Then |x & y| = n - d(x) - d(y) + s, and with weight w = q d + p a the Jaccard
similarity reaches p/q exactly if

    w(x) + w(y) <= (q - p) n + (p + q) s.

The centre of a star holds what more than half of its members hold, so that differences are few and rare. The member of
least weight then links, without any common difference, to every member that has such a link at all; whatever else may
link must share differences, more of them the heavier the two are. Such pairs are found by lists of differences, rarest
first, of which a member enters only as many as it needs. Lists of one group, or of members that the lightest one links
to, are not opened. No step forms the pairs of a star, and the result is that of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.components import components
from tillmark.llm.pieces import released
from tillmark.llm.registry import written

# Members of one star that meet its set in one task; larger stars are dealt over several.
MEMBERS = 2_000
# Large stars whose numbers of parts are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def _bytes(values: np.ndarray) -> bytes:
    return values.astype("<u8").tobytes()


def beside(pairs: DataFrame, heads: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (leader, class, ...) with `_head`, the set of the leader in heads (leader, set), and `_own`, that of the class."""
    counts = pairs.groupBy("leader").agg(F.floor(F.count(F.lit(1)) / MEMBERS).cast("int").alias("_more"))
    large = counts.where(F.col("_more") > 0)
    # One row for each MEMBERS pairs at most.
    if large.count() <= BROADCAST_ROWS:
        large = F.broadcast(large)
    dealt = pairs.join(large, "leader", "left").withColumn(
        "_part", F.pmod(F.xxhash64("class"), F.coalesce("_more", F.lit(0)) + 1).cast("int")
    )
    copies = heads.join(counts, "leader").select(
        "leader", F.col("set").alias("_head"), F.explode(F.sequence(F.lit(0), "_more")).alias("_part")
    )
    own = sets.select("class", F.col("set").alias("_own"))
    return dealt.drop("_more").join(own, "class").join(copies, ["leader", "_part"]).drop("_part")


def _overlap(left: pa.Array, right: pa.Array) -> pa.Array:
    shared, total = [], []
    for x, y in zip(left, right):
        both = np.sort(np.concatenate([_numbers(x.as_py()), _numbers(y.as_py())]), kind="stable")
        same = int(np.count_nonzero(both[1:] == both[:-1]))
        shared.append(same)
        total.append(len(both) - same)
    return pa.StructArray.from_arrays([pa.array(shared, pa.int64()), pa.array(total, pa.int64())], ["shared", "total"])


def linked_pairs(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """Those of pairs (leader, class) whose sets reach the similarity p/q."""
    heads = sets.select(F.col("class").alias("leader"), "set")
    overlap = F.arrow_udf(_overlap, "struct<shared: long, total: long>")
    both = beside(pairs, heads, sets).withColumn("_o", overlap("_own", "_head"))
    return both.where(F.col("_o.shared") * q >= F.col("_o.total") * p).select(*pairs.columns)


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """leader and each element in which the class differs from it."""
    for batch in released(batches):
        leaders, elements = [], []
        for leader, own, head in zip(batch.column(0), batch.column(1), batch.column(2)):
            found = np.setxor1d(_numbers(own.as_py()), _numbers(head.as_py()), assume_unique=True)
            leaders.append(np.full(len(found), leader.as_py(), np.int64))
            elements.append(found.view(np.int64))
        if leaders:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(leaders)), pa.array(np.concatenate(elements))], ["leader", "element"]
            )


def _flipped(head: pa.Array, flips: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(head, flips):
        turned = np.array(y.as_py() or [], np.int64).view(np.uint64)
        out.append(_bytes(np.setxor1d(_numbers(x.as_py()), turned, assume_unique=True)))
    return pa.array(out, pa.binary())


def _against(own: pa.Array, centre: pa.Array) -> pa.Array:
    n, lacks, adds, elements = [], [], [], []
    for x, y in zip(own, centre):
        x, y = _numbers(x.as_py()), _numbers(y.as_py())
        found = np.setxor1d(x, y, assume_unique=True)
        more = len(found) - (len(y) - len(x))
        n.append(len(y))
        lacks.append(len(found) - more // 2)
        adds.append(more // 2)
        elements.append(found.view(np.int64))
    fields = [pa.array(v, pa.int64()) for v in (n, lacks, adds)] + [pa.array(elements, pa.list_(pa.int64()))]
    return pa.StructArray.from_arrays(fields, ["n", "lacks", "adds", "elements"])


def centres(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """leader and set: what more than half of the star's members (the leader among them) hold."""
    heads = sets.select(F.col("class").alias("leader"), "set")
    both = beside(stars.select("leader", "class"), heads, sets)
    found = both.select("leader", "_own", "_head").mapInArrow(_differences, "leader long, element long")
    held = found.groupBy("leader", "element").agg(F.count(F.lit(1)).alias("_held")).where(F.col("_held") > 1)
    members = stars.groupBy("leader").agg((F.count(F.lit(1)) + 1).alias("_members"))
    often = held.join(members, "leader").where(2 * F.col("_held") > F.col("_members"))
    flips = often.groupBy("leader").agg(F.collect_list("element").alias("_flips"))
    flipped = F.arrow_udf(_flipped, "binary")
    return heads.join(members, "leader").join(flips, "leader", "left").select("leader", flipped("set", "_flips").alias("set"))


def _up(top: Column, by: int) -> Column:
    """top / by, rounded up."""
    return F.ceil(top / F.lit(by))


def star_links(stars: DataFrame, sets: DataFrame, p: int, q: int, path: str) -> DataFrame:
    """Links a, b that connect whatever two members of a star (or a member and its leader) of similarity p/q connect.

    stars: leader and class (longs, distinct pairs, the two differ); sets: class and set (its sorted 64-bit elements,
    binary) of all of them. Intermediate tables go below `path`.
    """
    direct = written(linked_pairs(stars, sets, p, q), f"{path}/direct")
    links = direct.select(F.col("class").alias("a"), F.col("leader").alias("b"))
    groups = written(components(links), f"{path}/groups")
    own = groups.select(F.col("node").alias("class"), F.col("root").alias("group"))
    grouped = stars.join(own, "class", "left").withColumn("group", F.coalesce("group", "class"))
    ends = grouped.groupBy("leader").agg(F.min("group").alias("_low"), F.max("group").alias("_high"))
    lead = own.select(F.col("class").alias("leader"), F.col("group").alias("_lead"))
    ends = ends.join(lead, "leader", "left").withColumn("_lead", F.coalesce("_lead", "leader"))
    # The leader has been compared with every member: a star stays open if these are of several groups.
    ends = ends.where(F.col("_low") != F.col("_high"))
    opened = written(grouped.join(ends.select("leader", "_lead"), "leader"), f"{path}/open")
    if opened.isEmpty():
        return links
    middle = written(centres(opened, sets), f"{path}/centres", compression="none")
    everyone = opened.select("leader", "class", "group").unionByName(
        opened.groupBy("leader").agg(F.first("_lead").alias("group")).withColumn("class", F.col("leader"))
    )
    against = F.arrow_udf(_against, "struct<n: long, lacks: long, adds: long, elements: array<long>>")
    placed = beside(everyone, middle, sets).withColumn("_v", against("_own", "_head"))
    placed = placed.select(
        "leader", "class", "group", (F.col("_v.n") * (q - p)).alias("bound"),
        (F.col("_v.lacks") * q + F.col("_v.adds") * p).alias("weight"), F.col("_v.elements").alias("elements"),
    )
    placed = written(placed, f"{path}/placed")
    light = placed.groupBy("leader").agg(F.min(F.struct("weight", "class", "group")).alias("_l"))
    light = light.select(
        "leader", F.col("_l.weight").alias("least"), F.col("_l.class").alias("light"), F.col("_l.group").alias("_group")
    )
    inside = F.col("weight") + F.col("least") <= F.col("bound")
    placed = placed.join(light, "leader").withColumn("outer", ~inside)
    sure = placed.where(inside & (F.col("class") != F.col("light")) & (F.col("group") != F.col("_group")))
    links = links.unionByName(sure.select(F.col("class").alias("a"), F.col("light").alias("b")))
    # The leader has been compared with every member.
    rows = placed.where(F.col("class") != F.col("leader")).select(
        "leader", "class", "weight", "bound", "least", "outer", F.size("elements").cast("long").alias("size"),
        F.when(F.col("outer"), F.col("group")).otherwise(F.col("_group")).alias("group"),
        F.explode("elements").alias("element"),
    )
    lists = rows.groupBy("leader", "element").agg(
        F.count(F.lit(1)).alias("held"), F.min("group").alias("_a"), F.max("group").alias("_b"), F.max("outer").alias("_o")
    )
    lists = lists.where((F.col("_a") != F.col("_b")) & F.col("_o")).select("leader", "element", "held")
    kept = written(rows.join(lists, ["leader", "element"]), f"{path}/lists")
    member = Window.partitionBy("leader", "class")
    rank = F.row_number().over(member.orderBy("held", "element")) - 1
    # Elements of lists that aren't opened come first: they take places, but no two that matter share one.
    kept = kept.withColumn("place", F.col("size") - F.count(F.lit(1)).over(member) + rank)
    asks = F.greatest(
        F.lit(1), _up(F.col("weight") + F.col("least") - F.col("bound"), p + q), _up(F.col("weight") - F.col("bound"), q)
    )
    gives = F.floor((F.col("weight") - F.col("least")) / F.lit(p + q)) + 1
    kept = kept.withColumns({"left": F.col("size") - F.col("place"), "asks": asks, "gives": gives})
    names = ["class", "weight", "left", "group"]
    probe = kept.where(F.col("outer") & (F.col("left") >= F.col("asks"))).select(
        "leader", "element", "bound", *[F.col(c).alias(f"x_{c}") for c in names]
    )
    index = kept.where(F.col("left") >= F.col("gives")).select("leader", "element", *[F.col(c).alias(f"y_{c}") for c in names])
    need = _up(F.col("x_weight") + F.col("y_weight") - F.col("bound"), p + q)
    met = probe.join(index, ["leader", "element"]).where(
        (F.col("x_group") != F.col("y_group")) & (F.least("x_left", "y_left") >= need)
    )
    met = met.select(F.least("x_class", "y_class").alias("leader"), F.greatest("x_class", "y_class").alias("class"))
    rest = written(linked_pairs(written(met.distinct(), f"{path}/met"), sets, p, q), f"{path}/rest")
    return links.unionByName(rest.select(F.col("class").alias("a"), F.col("leader").alias("b")))
