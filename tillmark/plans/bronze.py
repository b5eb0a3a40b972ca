"""Bronze: every new drop file is appended once, all columns as text, with lineage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import islice
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.incremental import next_mark, rows_since
from tillmark.session import STORED, no_rows, side_by_side
from tillmark.sources.csv_drops import list_drops, read_drops
from tillmark.sources.folders import finished_runs, last_finished
from tillmark.specs import TABLES, TableSpec

LOAD_LOG = (
    "file_path string, row_count bigint, loaded_at timestamp_ntz, table_name string, _batch_id bigint"
)
INGEST_STATS = "table string, files_loaded bigint, rows_loaded bigint"
# Files per batch: bounds the path list a single read holds. No result depends on it.
FILES_PER_BATCH = 10_000


class Ingested(NamedTuple):
    table: str
    files_loaded: int
    rows_loaded: int


@dataclass(frozen=True)
class Bronze:
    spark: SparkSession
    root: str

    def table_path(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def log_path(self, table: str) -> str:
        return f"{self.root}/control/load_log/table_name={table}"

    def _log_of(self, table: str, batches: Sequence[int]) -> DataFrame:
        reader = self.spark.read.schema(LOAD_LOG).option("basePath", f"{self.root}/control/load_log")
        return reader.parquet(*[f"{self.log_path(table)}/_batch_id={b}" for b in batches])

    def load_log(self, table: str) -> DataFrame:
        """Files already loaded: (file_path, row_count, loaded_at, table_name, _batch_id)."""
        last = self._last_batch(table)
        if last < 0:
            return no_rows(self.spark, LOAD_LOG)
        reader = self.spark.read.schema(LOAD_LOG).option("basePath", f"{self.root}/control/load_log")
        return reader.parquet(self.log_path(table)).where(F.col("_batch_id") <= last)

    def _last_batch(self, table: str) -> int:
        return last_finished(self.spark, self.log_path(table), "_batch_id")

    def loaded_at(self, table: str, batch: int) -> dt.datetime:
        """The load time of a batch's last file; it grows with the batch number."""
        return self._log_of(table, [batch]).agg(F.max("loaded_at")).first()[0]

    def next_stamp(self, table: str) -> dt.datetime:
        """A load time after that of every file logged so far, whatever the clock does."""
        now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        last = self._last_batch(table)
        return now if last < 0 else max(now, self.loaded_at(table, last) + dt.timedelta(microseconds=1))

    def since(
        self, table: str, batch: int, mark: dt.datetime, upto: int | None = None
    ) -> tuple[int, dt.datetime, DataFrame | None]:
        """Rows loaded after the mark, which was set at a batch: (last batch, its mark, rows or None).

        With ``upto``, no batch after that one.

        Only the folders of later batches are opened, and whether they hold rows and how new those are is read from
        the log. A batch that was cut off before it was logged is not seen.
        """
        before = None if upto is None else upto + 1
        new = finished_runs(self.spark, self.log_path(table), "_batch_id", after=batch, before=before)
        if not new:
            return batch, mark, None
        logged = self._log_of(table, new).agg(
            F.sum("row_count").alias("rows"), next_mark("loaded_at", mark).alias("mark")
        ).first()
        rows = rows_since(self._rows(table, new), mark) if logged.rows else None
        return new[-1], logged.mark, rows

    def _rows(self, table: str, batches: Sequence[int]) -> DataFrame:
        reader = self.spark.read.schema(TABLES[table].bronze_schema()).option("basePath", self.table_path(table))
        return reader.parquet(*[f"{self.table_path(table)}/_batch_id={b}" for b in batches])

    def read(self, table: str) -> DataFrame:
        """All rows of the logged batches."""
        last = self._last_batch(table)
        if last < 0:
            return no_rows(self.spark, TABLES[table].bronze_schema())
        reader = self.spark.read.schema(TABLES[table].bronze_schema())
        return reader.parquet(self.table_path(table)).where(F.col("_batch_id") <= last)

    def new_files(self, listing: DataFrame, table: str) -> DataFrame:
        """Listed files that are not in the load log."""
        return listing.join(self.load_log(table).select("file_path"), "file_path", "left_anti")

    def append(self, files: list[tuple[str, str]], spec: TableSpec, first: dt.datetime | None = None) -> int:
        """Load files as one batch and return its number. The log entry is written last and makes it visible.

        Every file has a load time of its own: ``first`` and a microsecond more for each file before it. The number
        follows the last logged one, so a repeated attempt replaces what a failed one left.
        """
        last = self._last_batch(spec.name)
        first = self.next_stamp(spec.name) if first is None else first
        target = f"{self.table_path(spec.name)}/_batch_id={last + 1}"
        stamps = self.spark.createDataFrame(
            [(name, first + dt.timedelta(microseconds=i)) for i, (_, name) in enumerate(files)],
            "file_path string, loaded_at timestamp_ntz",
        )
        # One row per file of the batch, whose number is bounded.
        of_file = F.broadcast(stamps.toDF("_source_file", "_loaded_at"))
        rows = read_drops(self.spark, files, spec).join(of_file, "_source_file")
        rows.write.options(**STORED).mode("overwrite").parquet(target)

        counts = (
            self.spark.read.schema("_source_file string").parquet(target)
            .groupBy(F.col("_source_file").alias("file_path"))
            .agg(F.count(F.lit(1)).alias("row_count"))
        )
        # A file without rows is logged too, else it would be read again every time.
        log = stamps.join(counts, "file_path", "left").select(
            "file_path", F.coalesce("row_count", F.lit(0)).alias("row_count"), "loaded_at"
        )
        log.coalesce(1).write.mode("overwrite").parquet(f"{self.log_path(spec.name)}/_batch_id={last + 1}")
        return last + 1

    def load_listing(self, listing: DataFrame, table: str, files_per_batch: int = FILES_PER_BATCH) -> list[int]:
        """Load the listed files that are new, in name order. Returns the numbers of the new batches.

        Load times follow the order of the names, wherever one batch ends and the next begins.
        """
        new = self.new_files(listing, table).orderBy("file_path").toLocalIterator()
        files = ((row.path, row.file_path) for row in new)
        batches, stamp = [], self.next_stamp(table)
        while batch := list(islice(files, files_per_batch)):
            batches.append(self.append(batch, TABLES[table], stamp))
            stamp += dt.timedelta(microseconds=len(batch))
        return batches

    def ingest(self, raw_dir: str, table: str) -> Ingested:
        """Load a table's new drops. No folder, or nothing new, means zeros."""
        listing = list_drops(self.spark, raw_dir, table)
        batches = [] if listing is None else self.load_listing(listing, table)
        if not batches:
            return Ingested(table, 0, 0)
        counts = self._log_of(table, batches).agg(F.count(F.lit(1)), F.sum("row_count")).first()
        return Ingested(table, *counts)


def tenant_dir(raw_root: str, tenant: str) -> str:
    """Drops of one tenant live below ``{raw_root}/{tenant}``."""
    return f"{raw_root.rstrip('/')}/{tenant}"


def ingest_all(spark: SparkSession, root: str, raw_dir: str, tables=tuple(TABLES)) -> DataFrame:
    """Load every table's new drops, in layout order; one statistics row per table."""
    bronze = Bronze(spark, root)
    return spark.createDataFrame(side_by_side(lambda table: bronze.ingest(raw_dir, table), tables), INGEST_STATS)


def totals(stats: DataFrame) -> DataFrame:
    """Sums over all tables of a run."""
    return stats.agg(
        F.sum("files_loaded").alias("files_loaded"), F.sum("rows_loaded").alias("rows_loaded")
    )
