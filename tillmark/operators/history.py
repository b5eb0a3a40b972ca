"""Change data derived from re-emitted rows: snapshot diff, change history, status transitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.operators.timeline import with_previous


def snapshot_diff(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Compare two snapshots: (key…, change, changed_columns).

    ``change`` is insert, update, unchanged or absent; absent keys are reported, not deleted.
    """
    attributes = [c for c in after.columns if c not in key]
    old = before.select(*key, F.struct(*attributes).alias("_old"))
    new = after.select(*key, F.struct(*attributes).alias("_new"))
    differing = F.concat_ws(
        ",",
        *[F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in attributes],
    )
    return (
        old.join(new, list(key), "full_outer")
        .withColumn(
            "change",
            F.when(F.col("_old").isNull(), "insert")
            .when(F.col("_new").isNull(), "absent")
            .when(differing != "", "update")
            .otherwise("unchanged"),
        )
        .withColumn("changed_columns", F.when(F.col("change") == "update", differing).otherwise(F.lit("")))
        .select(*key, "change", "changed_columns")
    )


def bucket_digests(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Per bucket of keys how many rows it has and two sums of row hashes: (_bucket, _rows, _sum, _sum2).

    Rows are hashed with which of their values are NULL. Buckets of equal digests hold equal rows, but for chances of
    about 2^-128. One row per bucket; a snapshot's digests can be kept and compared with the next without reading it.
    """
    values = [F.col(c) for c in sorted(df.columns)]
    marked = [*values, *[v.isNull() for v in values]]
    hashes = [F.xxhash64(*marked), F.xxhash64(F.lit("second"), *marked)]
    rows = df.select(_bucket(key, buckets), *[h.cast("decimal(38,0)").alias(f"_h{i}") for i, h in enumerate(hashes)])
    return rows.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("_h0").alias("_sum"), F.sum("_h1").alias("_sum2")
    )


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("_bucket")


def differing_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets whose digests differ, or that only one side has."""
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ("_rows", "_sum", "_sum2")]
    both = before.alias("b").join(after.alias("a"), F.col("b._bucket") == F.col("a._bucket"), "full_outer")
    return both.where(~(same[0] & same[1] & same[2])).select(F.coalesce("b._bucket", "a._bucket").alias("_bucket"))


def snapshot_diff_by_digest(
    before: DataFrame, after: DataFrame, key: Sequence[str], buckets: int = 4096, before_digests: DataFrame | None = None
) -> DataFrame:
    """What snapshot_diff gives, with rows joined only in buckets of keys whose digests differ.

    All other rows of `after` are unchanged, and those of `before` are read no further than for their digests, or not
    at all where these were kept. Digests are one row per bucket, so the differing ones can be broadcast.
    """
    kept = bucket_digests(before, key, buckets) if before_digests is None else before_digests
    differing = F.broadcast(differing_buckets(kept, bucket_digests(after, key, buckets)))
    old, new = (df.withColumn("_bucket", _bucket(key, buckets)) for df in (before, after))
    changed = snapshot_diff(
        old.join(differing, "_bucket", "left_semi").drop("_bucket"), new.join(differing, "_bucket", "left_semi").drop("_bucket"), key
    )
    same = new.join(differing, "_bucket", "left_anti")
    return changed.unionByName(same.select(*key, F.lit("unchanged").alias("change"), F.lit("").alias("changed_columns")))


def _slotted(versions: DataFrame, columns: Sequence[str], time: str) -> DataFrame:
    """The columns a history needs, and the hour that cuts a key's rows into slots."""
    return versions.select(*dict.fromkeys(columns), F.date_trunc("hour", F.col(time)).alias("_slot"))


def change_history(
    versions: DataFrame, key: Sequence[str], order: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """One row per distinct state of a key: (key…, tracked…, valid_from, valid_to, is_current).

    ``order[0]`` is the version time; re-emissions that change nothing are merged into the state before.
    """
    slim = _slotted(versions, [*key, *order, *tracked], order[0])
    compared = with_previous(slim, key, order, tracked, "_before", "_slot")
    changed = F.col("_before").isNull()
    for name in tracked:
        changed = changed | ~F.col(f"_before.{name}").eqNullSafe(F.col(name))
    states = compared.where(changed).drop("_before")
    return with_previous(states, key, order, [order[0]], "_after", "_slot", following=True).select(
        *key,
        *tracked,
        F.col(order[0]).alias("valid_from"),
        F.col(f"_after.{order[0]}").alias("valid_to"),
        F.col("_after").isNull().alias("is_current"),
    )


def status_transitions(
    versions: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    status: str,
    allowed: Sequence[tuple[str, str]],
) -> DataFrame:
    """Every change of status with whether it is an allowed one: (key…, changed_at, from_status, to_status, allowed).

    The first status of a key has no predecessor and is not a transition.
    """
    slim = _slotted(versions, [*key, *order, status], order[0])
    previous = with_previous(slim, key, order, [status], "_before", "_slot")
    moved = previous.where(F.col("_before").isNotNull() & ~F.col(f"_before.{status}").eqNullSafe(F.col(status)))
    pair = F.struct(F.col(f"_before.{status}"), F.col(status))
    legal = F.lit(False)
    for old, new in allowed:
        legal = legal | pair.eqNullSafe(F.struct(F.lit(old), F.lit(new)))
    return moved.select(
        *key,
        F.col(order[0]).alias("changed_at"),
        F.col(f"_before.{status}").alias("from_status"),
        F.col(status).alias("to_status"),
        legal.alias("allowed"),
    )
