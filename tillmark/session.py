"""Session settings shared by every job, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

# Runtime settings the plans rely on. Timestamps carry no zone, so the session zone is pinned.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split even when that costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.fileCompressionFactor": "1.0",
    "spark.sql.maxConcurrentOutputFileWriters": "0",
}

# Added for the stored tables. Keys take 10 to 50 times as much in the driver's hash table as in a compressed file, so by
# the size of their files millions of them would be broadcast; how many rows a join has is measured when it runs.
# A write into few folders keeps their files open side by side instead of sorting the rows by folder.
STORED_RUNTIME = {
    "spark.sql.sources.fileCompressionFactor": "20",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

# Tables of a warehouse are written once and read often: a third smaller than with Spark's default, at little more time.
STORED = {"compression": "zstd"}


def configure(spark: SparkSession, **more: str) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in {**RUNTIME, **more}.items():
        spark.conf.set(key, value)
    return spark


def configure_stored(spark: SparkSession) -> SparkSession:
    """The runtime settings for plans over stored tables."""
    return configure(spark, **STORED_RUNTIME)


def build_session(app: str = "tillmark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.ui.enabled": "false", **RUNTIME, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Scratch folders of local sessions without a configured one, by application id.
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's checkpoint folder.

    Only a session that runs on this machine alone may go without one, as tests do.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="tillmark-")
    return _LOCAL_DIRS[context.applicationId]


def no_rows(spark: SparkSession, schema) -> DataFrame:
    """An empty frame the optimizer knows to be empty: whatever is joined to it is planned away."""
    return spark.createDataFrame([], schema).limit(0)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def side_by_side(work: Callable[[Item], Result], items: Iterable[Item], jobs: int = 8) -> list[Result]:
    """Run independent Spark jobs together; results in the order of the items."""
    with ThreadPoolExecutor(max_workers=jobs) as pool:
        return list(pool.map(work, items))
