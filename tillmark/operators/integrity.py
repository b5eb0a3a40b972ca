"""Key and reference checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.cleaning import stripped
from tillmark.session import fresh_dir, side_by_side

MISSING_KEY = "missing_primary_key"
# Keys of a parent table that are broadcast at most (about 25 MB in the driver, for each of a table's parents at once); the
# keys of a larger one meet the child by a shuffle.
BROADCAST_KEYS = 250_000


def has_key(key: Sequence[str], cleaned: bool = False) -> Column:
    """Every key column is present and not blank. Never NULL, so it can be negated.

    In ``cleaned`` columns blank is already NULL.
    """
    present = [
        F.col(k).isNotNull() if cleaned else F.coalesce(stripped(F.col(k).cast("string")) != "", F.lit(False))
        for k in key
    ]
    return reduce(Column.__and__, present)


def split_missing_key(df: DataFrame, key: Sequence[str], cleaned: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rows without)."""
    return df.where(has_key(key, cleaned)), df.where(~has_key(key, cleaned))


def reject_rows(df: DataFrame, table: str, reason: str, rejected_at: Column) -> DataFrame:
    """Rejected rows of any table in one shape: every value as text inside a JSON object, NULL kept."""
    row = F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns])
    source = F.col("_source_file") if "_source_file" in df.columns else F.lit(None).cast("string")
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(reason).alias("reason"),
        F.to_json(row, {"ignoreNullFields": "false"}).alias("row_json"),
        source.alias("source_file"),
        rejected_at.alias("rejected_at"),
    )


References = Mapping[str, tuple[DataFrame, str]]


def _parent_keys(references: References) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The distinct keys of each reference's parent, as column ``_key``: (those to broadcast, the others).

    The check counts no further than the bound.
    """
    keys = {fk: parent.select(F.col(pk).alias("_key")) for fk, (parent, pk) in references.items()}
    counts = side_by_side(lambda k: k.limit(BROADCAST_KEYS + 1).count(), keys.values())
    few = {fk for fk, n in zip(keys, counts) if n <= BROADCAST_KEYS}
    small = {fk: F.broadcast(keys[fk].distinct()) for fk in keys if fk in few}
    return small, {fk: keys[fk] for fk in keys if fk not in few}


def _with_flags(child: DataFrame, small: Mapping[str, DataFrame]) -> DataFrame:
    """The child with ``_broken_{fk}`` for the parents that are broadcast: one pass, and nothing is shuffled."""
    for fk, keys in small.items():
        there = keys.select(F.col("_key").alias(f"_key_{fk}"))
        child = child.join(there, F.col(fk) == F.col(f"_key_{fk}"), "left").withColumn(
            f"_broken_{fk}", F.col(fk).isNotNull() & F.col(f"_key_{fk}").isNull()
        )
    return child


def _counted(child: DataFrame, fk: str, keys: DataFrame) -> DataFrame:
    """Keys without a parent and how many rows have them. They are counted in their own type before the join, so a hot
    key reaches it as one row."""
    used = child.select(F.col(fk).alias("_key")).where("_key IS NOT NULL").groupBy("_key")
    return used.agg(F.count(F.lit(1)).alias("row_count")).join(keys, "_key", "left_anti")


def reference_violations(child: DataFrame, references: References) -> DataFrame:
    """All broken references of a table: (fk, key_value as text, row_count). NULL passes.

    Parents of few keys are looked up in one pass over the child, of which only broken keys go on. A larger parent is
    joined with the counted keys of its column.
    """
    small, large = _parent_keys(references)
    found = [
        _counted(child, fk, keys).select(F.lit(fk).alias("fk"), F.col("_key").cast("string").alias("key_value"), "row_count")
        for fk, keys in large.items()
    ]
    if small:
        broken = [
            F.when(F.col(f"_broken_{fk}"), F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("key_value")))
            for fk in small
        ]
        flagged = _with_flags(child.select(*small), small)
        pairs = flagged.where(reduce(Column.__or__, [F.col(f"_broken_{fk}") for fk in small])).select(
            F.explode(F.array_compact(F.array(*broken))).alias("_pair")
        )
        found.append(pairs.groupBy("_pair.fk", "_pair.key_value").agg(F.count(F.lit(1)).alias("row_count")))
    return reduce(DataFrame.unionByName, found)


def flag_broken(
    child: DataFrame, references: References, out: str = "_broken", sources: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The child with ``out``: whether any of its references has no parent row.

    Broken keys of large parents are found first and written out; references without any are not joined, and being few
    as a rule, the keys of the others are broadcast by their size. They are looked for in the child or, where that is dear
    to compute, in the frames of ``sources``, which hold all of the child's keys.
    """
    spark = child.sparkSession
    small, large = _parent_keys(references)
    flagged = _with_flags(child, small)
    flags = [F.col(f"_broken_{fk}") for fk in small]
    for fk, keys in large.items():
        path = fresh_dir(spark, "broken-keys")
        _counted(child if sources is None else sources[fk], fk, keys).select("_key").write.parquet(path)
        broken = spark.read.schema(keys.schema).parquet(path)
        if not broken.isEmpty():
            broken = broken.select(F.col("_key").alias(f"_lost_{fk}"))
            flagged = flagged.join(broken, F.col(fk) == F.col(f"_lost_{fk}"), "left")
            flags.append(F.col(f"_lost_{fk}").isNotNull())
    return flagged.select(*child.columns, reduce(Column.__or__, flags, F.lit(False)).alias(out))


def split_by_references(
    child: DataFrame, references: References
) -> tuple[DataFrame, DataFrame]:
    """(rows whose references all resolve or are NULL, the other rows)."""
    flagged = flag_broken(child, references)
    return flagged.where("NOT _broken").drop("_broken"), flagged.where("_broken").drop("_broken")
