"""Registry of the queries of this subpackage, and what they share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tillmark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Batches handed to Python stay small whatever the length of a text: by rows, and by bytes where texts are long.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


# Applications whose executors were given this package.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark hand the package to executors that don't have it installed. Its file server reads the archive."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='tillmark-package-')}/tillmark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the operators of this subpackage rely on."""
    configure(spark)
    ship(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that must give the same rows, if SQL can."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """As many partitions as the session deals a shuffle to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write to the shared folder and read it again: the plan ends there, and a lost executor costs only a read."""
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, key: str, path: str, **options: str) -> DataFrame:
    """The same in Spark's buckets of `key`, one for each partition of a shuffle: joins on the key don't shuffle these rows.

    Rows of equal keys are written by one task, so keys shouldn't repeat much.
    """
    spark, count = df.sparkSession, partitions(df.sparkSession)
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(count, key).write.format("parquet").options(path=path, **options)
    writer.bucketBy(count, key).saveAsTable(name)
    return spark.table(name)
