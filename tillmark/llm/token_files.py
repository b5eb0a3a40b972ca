"""Token ids of documents in binary segments, in ascending order of doc_id.

Segments are the format of pfor.py. A folder holds them as rows of Parquet files, one binary value a segment, so that
Spark's own committer writes them: executors share no local disk, and a repeated task leaves nothing twice.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillmark.llm import pfor
from tillmark.llm.pieces import balanced, encoder
from tillmark.llm.registry import partitions

# A segment is closed when it holds so many ids; one document is never divided between segments.
SEGMENT_IDS = 1 << 20
# Characters of the texts that are encoded at once, whatever their number.
BATCH_CHARS = 1 << 21
SEGMENTS = "part int, segment long, first_doc long, part_start long, n_ids long, image binary"


def _segments(tokenizer: str, end_id: int, percentile: float, segment_ids: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        number = start = held = 0
        ids, ends, chunks = [], [], []

        def close() -> pa.RecordBatch:
            nonlocal number, start, held
            values = np.frombuffer(b"".join(chunks), "<u4")
            nulls = np.array([i is None for i in ids])
            known = np.array([0 if i is None else i for i in ids], np.int64)
            image = pfor.encode(known, np.array(ends, np.uint64), values, percentile, nulls)
            columns = [[part], [number], [ids[0]], [start], [held], [image]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["part", "segment", "first_doc", "part_start", "n_ids", "image"]
            number, start, held = number + 1, start + held, 0
            ids.clear(), ends.clear(), chunks.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in balanced(list(map(len, texts)), BATCH_CHARS):
                for doc_id, coded in zip(doc_ids[a:b], encode.batch(texts[a:b])):
                    ids.append(doc_id)
                    chunks += [coded, end]
                    held += len(coded) // 4 + 1
                    ends.append(held)
                    if held >= segment_ids:
                        yield close()
        if ids:
            yield close()

    return write


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    text: str = "text",
    percentile: float = 90,
    segment_ids: int = SEGMENT_IDS,
    null_ids: bool = False,
) -> None:
    """Encode every whole text, append end_id, and write the ids in ascending order of doc_id.

    Null and empty texts have the end id alone. Rows of equal doc_id are all written, by text. With `null_ids` rows
    without a doc_id come first, by a hash of the text, then by text; otherwise they are refused with an error. An empty
    table gives an empty folder. Other columns are not read.
    """
    doc_id = F.col("doc_id").cast("long")
    if not null_ids:
        doc_id = F.coalesce(doc_id, F.raise_error(F.lit("doc_id is null")).cast("long"))
    named = docs.select(doc_id.alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # Rows without a doc_id may be many: the hash divides them between parts, which stay in order.
    named = named.withColumn("_deal", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    ranged = named.repartitionByRange(partitions(docs.sparkSession), "doc_id", "_deal")
    ordered = ranged.sortWithinPartitions("doc_id", "_deal", "text").drop("_deal")
    segments = ordered.mapInArrow(_segments(tokenizer, end_id, percentile, segment_ids), SEGMENTS)
    segments.write.option("compression", "uncompressed").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with `start`: ids of all documents before the segment.

    Sums of whole parts are added up in one place: one row for each part of the writing job, never more. Parts of rows
    without a doc_id have no first one and come first, in the order of their numbers.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    sums = segments.groupBy("part").agg(F.sum("n_ids").alias("_ids"), F.min("first_doc").alias("_first"))
    before = Window.orderBy("_first", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    return segments.join(F.broadcast(starts), "part").withColumn("start", F.col("_before") + F.col("part_start")).drop("_before")


def map_documents(segments: DataFrame, of_ids: Callable[[np.ndarray], object], kind: pa.DataType, sql: str) -> DataFrame:
    """doc_id, start, n_tokens and value, which of_ids makes of each document's ids (unsigned 32-bit)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                segment = pfor.Segment(image)
                values = segment.values()
                ends = segment.ends.astype(np.int64)
                starts = np.append(0, ends[:-1])
                made = [of_ids(values[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segment.doc_ids, mask=segment.nulls),
                        pa.array(starts + start),
                        pa.array(ends - starts),
                        pa.array(made, kind),
                    ],
                    ["doc_id", "start", "n_tokens", "value"],
                )

    return segments.select("start", "image").mapInArrow(read, f"doc_id long, start long, n_tokens long, value {sql}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the ids themselves, from the files."""
    return map_documents(
        read_segments(spark, path), lambda ids: ids.tolist(), pa.list_(pa.int64()), "array<long>"
    ).withColumnRenamed("value", "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids as little-endian 32-bit integers, from the files."""
    return map_documents(
        read_segments(spark, path), lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "long"
    ).withColumnRenamed("value", "ids_crc32")
