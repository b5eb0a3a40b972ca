"""Bronze ingest as a stream: the file source's checkpoint remembers which drops were seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillmark.plans.bronze import FILES_PER_BATCH, Bronze
from tillmark.session import configure_stored
from tillmark.sources.csv_drops import drop_pattern, listed
from tillmark.sources.folders import any_match

# The file source needs its layout stated; only the path is ever read.
_FILE_LAYOUT = "path string, modificationTime timestamp_ltz, length bigint, content binary"


def start_ingest(
    spark: SparkSession, raw_dir: str, root: str, table: str, files_per_batch: int = FILES_PER_BATCH
) -> StreamingQuery | None:
    """Load every drop not seen yet, then stop. None when the table has no drops at all.

    A micro-batch that is replayed finds its files in the load log and loads nothing twice.
    """
    configure_stored(spark)
    pattern = drop_pattern(raw_dir, table)
    if not any_match(spark, pattern):
        return None
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_LAYOUT)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(pattern)
    )

    def load(batch: DataFrame, _: int) -> None:
        Bronze(batch.sparkSession, root).load_listing(batch, table, files_per_batch)

    return (
        listed(files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{root}/checkpoints/ingest/{table}")
        .trigger(availableNow=True)
        .start()
    )


def ingest_available(spark: SparkSession, raw_dir: str, root: str, table: str) -> None:
    stream = start_ingest(spark, raw_dir, root, table)
    if stream is not None:
        stream.awaitTermination()
