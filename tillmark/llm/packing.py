"""Packing of documents into sequences of bounded length by minimum bin slack.

A document longer than a sequence is cut into full sequences and a remainder. Only the number of remainders of each
length matters for what follows, so the plan is made from that table of at most `capacity` rows, whatever the number of
documents: a bitset of reachable sums picks the multiset of lengths that fills a sequence closest to its capacity, the
counts are backtracked from the sums, and the pattern is used as often as the remaining counts allow. The documents
then take their places in the patterns by their rank among remainders of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillmark.llm.pieces import balanced, encoder, released
from tillmark.llm.registry import partitions, written
from tillmark.session import fresh_dir

# Characters of the texts that are encoded at once, whatever their number.
BATCH_CHARS = 1 << 21

TOKENS = "doc_id long, doc_tokens long, crcs array<long>, ids binary"


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, text: str = "text") -> DataFrame:
    """doc_id, doc_tokens, the crc32 of the ids of each cut of `capacity` ids, and all ids (unsigned 32-bit, binary)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in released(batches):
            texts, coded = batch.column(1).to_pylist(), []
            for start, stop in balanced(list(map(len, texts)), BATCH_CHARS):
                coded += [ids + end for ids in encode.batch(texts[start:stop])]
            crcs = [[zlib.crc32(c[i : i + step]) for i in range(0, len(c), step)] for c in coded]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(c) // 4 for c in coded], pa.int64()),
                    pa.array(crcs, pa.list_(pa.int64())),
                    pa.array(coded, pa.binary()),
                ],
                ["doc_id", "doc_tokens", "crcs", "ids"],
            )

    named = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return named.mapInArrow(encode, TOKENS)


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, the longest one among it, whose sum comes closest to the capacity.

    reach[i] has bit s set if the first i lengths, each used at most as often as it is there, can add up to s.
    """
    lengths = sorted(counts, reverse=True)
    longest = lengths[0]
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    fitting = [(n, counts[n] - (n == longest)) for n in lengths if n <= room and counts[n] > (n == longest)]
    reach = [1]
    used = []
    for n, most in fitting:
        sums, left, step = reach[-1], min(most, room // n), 1
        while left:  # binary splitting of the bounded count
            take = min(step, left)
            sums |= (sums << (take * n)) & mask
            left -= take
            step *= 2
        reach.append(sums)
        used.append((n, most))
        if sums >> room & 1:
            break
    rest = reach[-1].bit_length() - 1
    chosen = {longest: 1}
    for i in range(len(used) - 1, -1, -1):
        n = used[i][0]
        k = 0
        while not reach[i] >> rest & 1:  # the fewest of this length with which the others can make up the rest
            rest -= n
            k += 1
        if k:
            chosen[n] = chosen.get(n, 0) + k
    return chosen


def plan_windows(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(how often, lengths of a window): every length is used up exactly.

    Each pattern is repeated until one of its lengths runs short, so there are few patterns, not one per window.
    """
    left = {n: c for n, c in counts.items() if n > 0 and c > 0}
    patterns = []
    while left:
        chosen = fill_window(left, capacity)
        times = min(left[n] // k for n, k in chosen.items())
        patterns.append((times, chosen))
        for n, k in chosen.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return patterns


def slots(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Where the remainders of a length go, in runs of ranks: (length, first rank, per window, windows, first window,
    offset of the first in a window)."""
    ranks: dict[int, int] = {}
    out = []
    window = 0
    for times, chosen in patterns:
        offset = 0
        for n in sorted(chosen, reverse=True):
            k = chosen[n]
            out.append((n, ranks.get(n, 0), k, times, window, offset))
            ranks[n] = ranks.get(n, 0) + times * k
            offset += n * k
        window += times
    return out


def pack(tokens: DataFrame, capacity: int = 2048) -> DataFrame:
    """Pieces of documents with their places: `tokens` has doc_id and doc_tokens; its other columns are kept.

    Returns a row per piece: start and length (of the document's ids), sequence_id, offset, cut (number of the piece);
    columns of these names are replaced.
    Documents without tokens have no piece. Repeated rows are documents of their own. Rows of equal doc_id are told
    apart by a number of their own, so a null doc_id does no harm. Sequences are filled from offset 0 without gaps.
    `tokens` is read several times: hand over a written table.
    """
    spark = tokens.sparkSession
    path = fresh_dir(spark, "packing")
    buckets = partitions(spark)
    sized = (
        tokens.select("doc_id", "doc_tokens")
        .where("doc_tokens > 0")
        .select("doc_id", "doc_tokens", (F.col("doc_tokens") % capacity).cast("int").alias("_rest"))
        .withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "doc_tokens"), F.lit(buckets)))
    )
    # Ranks: inside (length, bucket), after what earlier buckets of the length hold. A frequent length is thus dealt
    # to as many tasks as there are buckets.
    groups = sized.groupBy("_rest", "_bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.floor(F.col("doc_tokens") / capacity)).alias("_full")
    )
    groups = written(groups, f"{path}/groups")
    counts = {r[0]: r[1] for r in groups.where("_rest > 0").groupBy("_rest").agg(F.sum("_n")).collect()}
    patterns = plan_windows(counts, capacity)
    windows = sum(times for times, _ in patterns)
    # The plan: at most a few rows for each length below the capacity.
    runs = spark.createDataFrame(
        slots(patterns) or [(0, 0, 1, 0, 0, 0)],
        "_rest int, _first long, _each long, _times long, _window long, _offset long",
    )
    within = Window.partitionBy("_rest").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    total = groups.groupBy("_rest").agg(F.sum("_full").alias("_all_full"))
    full_before = Window.orderBy("_rest").rowsBetween(Window.unboundedPreceding, -1)  # at most `capacity` rows
    total = total.select("_rest", F.coalesce(F.sum("_all_full").over(full_before), F.lit(0)).alias("_base"))
    offsets = groups.join(F.broadcast(total), "_rest").select(
        "_rest",
        "_bucket",
        F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_rank0"),
        (F.coalesce(F.sum("_full").over(within), F.lit(0)) + F.col("_base") + windows).alias("_full0"),
    )
    local = Window.partitionBy("_rest", "_bucket").orderBy("doc_id", "doc_tokens")
    ranked = (
        tokens.where("doc_tokens > 0")
        .withColumn("_rest", (F.col("doc_tokens") % capacity).cast("int"))
        .withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "doc_tokens"), F.lit(buckets)))
        .withColumn("_cuts", F.floor(F.col("doc_tokens") / capacity))
        .withColumn("_local", F.row_number().over(local) - 1)
        .withColumn(
            "_before",
            F.coalesce(F.sum("_cuts").over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .join(offsets, ["_rest", "_bucket"])
        .withColumn("_rank", F.col("_rank0") + F.col("_local"))
        .withColumn("_sequence", F.col("_full0") + F.col("_before"))
        .drop("_rank0", "_full0", "_local", "_before", "_bucket")
    )
    # The run of ranks that a remainder lies in: the last one that starts at its rank or before.
    starts = runs.groupBy("_rest").agg(
        F.sort_array(F.collect_list(F.struct("_first", "_each", "_times", "_window", "_offset"))).alias("_runs")
    )
    placed = ranked.join(F.broadcast(starts), "_rest", "left").withColumn(
        "_run", F.element_at(F.filter("_runs", lambda r: r["_first"] <= F.col("_rank")), -1)
    )
    index = F.col("_rank") - F.col("_run._first")
    remainder = F.when(
        F.col("_rest") > 0,
        F.array(
            F.struct(
                F.col("_cuts").cast("long").alias("cut"),
                F.col("_rest").cast("long").alias("length"),
                (F.col("_run._window") + F.floor(index / F.col("_run._each"))).cast("long").alias("sequence_id"),
                (F.col("_run._offset") + index % F.col("_run._each") * F.col("_rest")).cast("long").alias("offset"),
            )
        ),
    ).otherwise(F.array())
    full = F.when(
        F.col("_cuts") > 0,
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("_cuts") - 1),
            lambda i: F.struct(
                i.alias("cut"),
                F.lit(capacity).cast("long").alias("length"),
                (F.col("_sequence") + i).cast("long").alias("sequence_id"),
                F.lit(0).cast("long").alias("offset"),
            ),
        ),
    ).otherwise(F.array())
    kept = [c for c in tokens.columns if c not in ("cut", "start", "length", "sequence_id", "offset")]
    pieces = placed.select(*[f"`{c}`" for c in kept], F.explode(F.concat(full, remainder)).alias("_piece"))
    return pieces.select(
        *[f"`{c}`" for c in kept],
        F.col("_piece.cut").alias("cut"),
        (F.col("_piece.cut") * capacity).alias("start"),
        F.col("_piece.length").alias("length"),
        F.col("_piece.sequence_id").alias("sequence_id"),
        F.col("_piece.offset").alias("offset"),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id and its ids (unsigned 32-bit, binary), of pieces that carry the ids of their documents."""
    own = F.substring(F.col("ids"), (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    return (
        pieces.select("sequence_id", "offset", own.alias("_ids"))
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "_ids"))).alias("_pieces"))
        .select("sequence_id", F.aggregate("_pieces", F.lit(b""), lambda a, p: F.concat(a, p["_ids"])).alias("ids"))
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, text: str = "text"
) -> DataFrame:
    """Encode, append end_id and pack every document; null and empty texts have the end id alone.

    The encoded documents are written once to the shared folder and read from there by all that follows.
    """
    tokens = written(
        encode_documents(docs, tokenizer, end_id, capacity, text),
        fresh_dir(docs.sparkSession, "packing-tokens"),
        compression="zstd",
    )
    return pack(tokens, capacity)
