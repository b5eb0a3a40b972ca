"""Silver: cleaned current state per key, upserted from the bronze rows that arrived since the last run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.cleaning import clean_columns, parsed
from tillmark.operators.incremental import EPOCH
from tillmark.operators.integrity import MISSING_KEY, has_key, reject_rows, split_missing_key
from tillmark.operators.versions import latest_by_key
from tillmark.plans.bronze import Bronze
from tillmark.session import fresh_dir, no_rows, side_by_side
from tillmark.sources.folders import any_match, last_finished
from tillmark.sources.keyed_table import KeyedTable
from tillmark.specs import TABLES, VERSION, TableSpec

MARK = "last_loaded_at timestamp_ntz, last_batch bigint, rows_upserted bigint, rows_rejected bigint"
MARKS = f"{MARK}, table_name string, run bigint"
REJECTS = "table_name string, reason string, row_json string, source_file string, rejected_at timestamp_ntz"
# Tables that the fact is joined from: their snapshots are bucketed by the join's key.
BUCKETED = {"orders": "order_id", "order_items": "order_id"}
BUCKETS = 64
# Hashes of repeated keys that are broadcast at most; where there are more, all rows are ranked.
REPEATED_KEYS = 1_000_000
TRANSFORM_STATS = "table string, rows_upserted bigint, rows_rejected bigint"


def clean(bronze_rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows with the lineage columns that order versions."""
    return clean_columns(bronze_rows, spec, *VERSION)


def current_rows(cleaned: DataFrame, spec: TableSpec) -> DataFrame:
    """Latest version per key, in the silver layout; rows without a key are left out."""
    keyed, _ = split_missing_key(cleaned, spec.key, cleaned=True)
    return latest_by_key(keyed, spec.key, VERSION).select(spec.silver_schema().names)


def repeated_keys(keyed: DataFrame, spec: TableSpec) -> tuple[DataFrame, int]:
    """Hashes of the keys that come more than once, and how many there are, counted no further than the bound.

    ``keyed`` has cleaned keys. The hashes are counted and written out: nothing else of a row is shuffled for that.
    """
    path = fresh_dir(keyed.sparkSession, "repeated-keys")
    counts = keyed.groupBy(F.xxhash64(*spec.key).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    counts.where("_n > 1").select("_hash").write.parquet(path)
    repeated = keyed.sparkSession.read.schema("_hash bigint").parquet(path)
    return repeated, repeated.limit(REPEATED_KEYS + 1).count()


def told_apart(bronze_rows: DataFrame, spec: TableSpec, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(uncleaned rows whose key comes once, the others); keys that merely share a hash are among the others."""
    hashed = bronze_rows.withColumn("_hash", F.xxhash64(*[parsed(spec, k) for k in spec.key]))
    once = hashed.join(F.broadcast(repeated), "_hash", "left_anti").drop("_hash")
    return once, hashed.join(F.broadcast(repeated), "_hash", "left_semi").drop("_hash")


def newest_rows(bronze_rows: DataFrame, spec: TableSpec, rejected: Observation) -> DataFrame:
    """What current_rows() makes of uncleaned rows; ``rejected`` receives the number of rows without a key as ``rows``.

    Most keys come once. The hashes of keys are counted first, so that only rows of repeated ones are shuffled and sorted
    whole; keys that merely share a hash are told apart there.
    """
    keys = clean(bronze_rows, spec).select(*spec.key)
    keyed, _ = split_missing_key(
        keys.observe(rejected, F.count_if(~has_key(spec.key, cleaned=True)).alias("rows")), spec.key, cleaned=True
    )
    repeated, many = repeated_keys(keyed, spec)
    if many > REPEATED_KEYS:
        return current_rows(clean(bronze_rows, spec), spec)
    names = spec.silver_schema().names
    if not many:
        return split_missing_key(clean(bronze_rows, spec), spec.key, cleaned=True)[0].select(names)
    once, again = told_apart(bronze_rows, spec, repeated)
    once, _ = split_missing_key(clean(once, spec), spec.key, cleaned=True)
    return once.select(names).unionByName(current_rows(clean(again, spec), spec))


@dataclass(frozen=True)
class Silver:
    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def table(self, name: str) -> KeyedTable:
        spec = TABLES[name]
        by = (BUCKETED[name], self.buckets) if name in BUCKETED else None
        return KeyedTable(self.spark, f"{self.root}/silver/{name}", spec.key, spec.silver_schema(), by)

    def _rejects_path(self, name: str) -> str:
        return f"{self.root}/silver_rejects/table_name={name}"

    def last_run(self, name: str) -> int:
        """The last run whose mark was written; what later runs left is not there yet."""
        return last_finished(self.spark, self._marks_path(name), "run")

    def read(self, name: str) -> DataFrame:
        return self.table(name).read(before=self.last_run(name) + 1)

    def changes(self, name: str, after: int) -> DataFrame:
        """Rows changed by the finished runs after ``after``, newest per key."""
        return self.table(name).changes(after, before=self.last_run(name) + 1)

    def _marks_path(self, name: str) -> str:
        return f"{self.root}/control/silver/table_name={name}"

    def _last_mark(self, name: str) -> tuple[int, int, dt.datetime]:
        """(number of the last finished run, last bronze batch it read, its high-water mark)."""
        run = self.last_run(name)
        if run < 0:
            return -1, -1, EPOCH
        mark = self.spark.read.schema(MARKS).parquet(f"{self._marks_path(name)}/run={run}").first()
        return run, mark.last_batch, mark.last_loaded_at

    def compact(self, name: str) -> None:
        """Let reads of a table start from its state after the last finished run."""
        self.table(name).compact(before=self.last_run(name) + 1)

    def rejects(self) -> DataFrame:
        """Rejected rows of the finished runs."""
        last = {name: run for name in TABLES if (run := self.last_run(name)) >= 0}
        if not any_match(self.spark, f"{self._rejects_path('*')}/run=*/_SUCCESS"):
            return no_rows(self.spark, REJECTS)
        rows = self.spark.read.schema(f"{REJECTS}, run bigint").parquet(f"{self.root}/silver_rejects")
        finished = F.lit(False)
        for name, run in last.items():
            finished = finished | ((F.col("table_name") == name) & (F.col("run") <= run))
        return rows.where(finished).select("table_name", "reason", "row_json", "source_file", "rejected_at")

    def transform(self, name: str, upto: int | None = None) -> tuple[str, int, int]:
        """Fold the new bronze rows of one table in: (table, rows_upserted, rows_rejected).

        With ``upto``, those of bronze batches up to that one.

        Changes and rejects go to folders numbered by the run and the mark is written last, so a run that
        was cut off is repeated under the same number and leaves nothing twice. The keys of the new rows are
        read first, then the rows, once more if some keys repeat or some rows have to be rejected.
        """
        spec = TABLES[name]
        last_run, batch, mark = self._last_mark(name)
        run = last_run + 1
        seen, (batch, mark, fresh) = batch, Bronze(self.spark, self.root).since(name, batch, mark, upto)
        if batch == seen:
            return name, 0, 0

        if fresh is None:
            # Files without rows have come: a run without changes, and the mark passes them.
            self.table(name).merge(self.table(name).empty(), run, guard=False)
            counted = (name, 0, 0)
        else:
            upserted, rejected = Observation(), Observation()
            # Load times only grow from batch to batch, so no row here can be older than the current one.
            current = newest_rows(fresh, spec, rejected)
            self.table(name).merge(current, run, guard=False, counted=upserted)
            counted = (name, upserted.get["rows"], rejected.get["rows"])
        rejects = f"{self._rejects_path(name)}/run={run}"
        # What an attempt left that was cut off is replaced too, be it by nothing.
        if counted[2] or any_match(self.spark, rejects):
            rows = clean(no_rows(self.spark, spec.bronze_schema()) if fresh is None else fresh, spec)
            _, refused = split_missing_key(rows, spec.key, cleaned=True)
            rows = reject_rows(refused, name, MISSING_KEY, F.localtimestamp()).drop("table_name")
            rows.write.mode("overwrite").parquet(rejects)

        # Rejected rows count as read: the mark passes them.
        self.spark.createDataFrame([(mark, batch, *counted[1:])], MARK).coalesce(1).write.mode("overwrite").parquet(
            f"{self._marks_path(name)}/run={run}"
        )
        return counted


def transform_all(spark: SparkSession, root: str, tables=tuple(TABLES)) -> DataFrame:
    """Transform every table; one statistics row per table."""
    silver = Silver(spark, root)
    return spark.createDataFrame(side_by_side(silver.transform, tables), TRANSFORM_STATS)
