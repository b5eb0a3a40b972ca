"""Silver as a stream: the load log is the source, a logged batch is what arrives.

A micro-batch only says how far the log has come; what is folded in is everything between the last silver mark and
there. The mark is written last, with the number of the last batch it covers, so a micro-batch that is replayed, comes
late or was cut off between its merge and its mark folds each row in exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillmark.plans.bronze import LOAD_LOG, Bronze
from tillmark.plans.silver import Silver
from tillmark.session import configure_stored
from tillmark.sources.folders import any_match

# Logged batches in one micro-batch at most.
LOGS_PER_BATCH = 100


def fold(batch: DataFrame, root: str, table: str) -> None:
    """Fold in what was logged up to the newest entry of this micro-batch."""
    newest = batch.agg(F.max("_batch_id")).first()[0]
    if newest is not None:
        Silver(batch.sparkSession, root).transform(table, upto=newest)


def start_transform(spark: SparkSession, root: str, table: str, logs_per_batch: int = LOGS_PER_BATCH) -> StreamingQuery | None:
    """Bring silver up to the load log, then stop. None when nothing was ever logged."""
    configure_stored(spark)
    path = Bronze(spark, root).log_path(table)
    if not any_match(spark, path):
        return None
    log = spark.readStream.schema(LOAD_LOG).option("maxFilesPerTrigger", logs_per_batch).parquet(path)
    return (
        log.writeStream.foreachBatch(lambda batch, _: fold(batch, root, table))
        .option("checkpointLocation", f"{root}/checkpoints/transform/{table}")
        .trigger(availableNow=True)
        .start()
    )


def transform_available(spark: SparkSession, root: str, table: str) -> None:
    stream = start_transform(spark, root, table)
    if stream is not None:
        stream.awaitTermination()
