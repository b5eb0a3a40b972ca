"""Operators against brute force on small random tables, one key of which holds a third of the rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark.operators import integrity
from tillmark.operators import quality as q
from tillmark.operators.history import (
    bucket_digests, change_history, differing_buckets, snapshot_diff, snapshot_diff_by_digest, status_transitions
)
from tillmark.operators.integrity import reference_violations, reject_rows, split_by_references, split_missing_key
from tillmark.operators.timeline import as_of, with_previous
from tillmark.operators.versions import drop_stale, first_by_key, insert_if_absent, latest_by_key, overlay, upsert
from tillmark.session import STORED, configure, configure_stored
from tillmark.sources import folders
from tillmark.sources.keyed_table import KeyedTable

START = dt.datetime(2026, 1, 1)


def skewed_rows(n, seed):
    """(key, time, id, state): a third of the rows share one key; times repeat and leave gaps."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.34 else f"k{rnd.randint(0, 20)}"
        at = START + dt.timedelta(minutes=15 * rnd.randint(0, 4 * 24 * 9))
        rows.append((key, at, i, rnd.choice(["open", "busy", "done"])))
    return rows


@pytest.fixture(scope="module")
def rows():
    return skewed_rows(1500, 3)


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, at timestamp_ntz, id int, state string").repartition(5)


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_and_first_by_key(frame, rows):
    groups = by_key(rows)
    assert collected(latest_by_key(frame, ["k"], ["at", "id"])) == sorted((g[-1] for g in groups.values()), key=repr)
    assert collected(first_by_key(frame, ["k"], ["at", "id"])) == sorted((g[0] for g in groups.values()), key=repr)


def test_latest_by_key_limits_groups_before_the_exchange(frame):
    plan = latest_by_key(frame, ["k"], ["at", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("following", [False, True])
def test_with_previous_crosses_slots(frame, rows, following):
    slotted = frame.withColumn("hour", F.date_trunc("hour", "at"))
    got = with_previous(slotted, ["k"], ["at", "id"], ["state", "id"], "n", "hour", following)
    want = []
    for group in by_key(rows).values():
        shifted = [*group[1:], None] if following else [None, *group[:-1]]
        want += [(r[2], (n[3], n[2]) if n else None) for r, n in zip(group, shifted, strict=True)]
    assert sorted((r.id, tuple(r.n) if r.n else None) for r in got.collect()) == sorted(want)


def test_transitions_and_history(frame, rows):
    allowed = [("open", "busy"), ("busy", "done")]
    moves, states = [], []
    for key, group in by_key(rows).items():
        kept = [group[0]] + [b for a, b in zip(group, group[1:], strict=False) if a[3] != b[3]]
        states += [
            (key, a[3], a[1], b[1] if b else None, b is None) for a, b in zip(kept, [*kept[1:], None], strict=True)
        ]
        moves += [(key, b[1], a[3], b[3], (a[3], b[3]) in allowed) for a, b in zip(kept, kept[1:], strict=False)]
    got = status_transitions(frame, ["k"], ["at", "id"], "state", allowed)
    assert collected(got) == sorted(moves, key=repr)
    assert collected(change_history(frame, ["k"], ["at", "id"], ["state"])) == sorted(states, key=repr)


def test_as_of(spark, frame, rows):
    rnd = random.Random(5)
    times = {
        (f"k{rnd.randint(0, 20)}" if rnd.random() < 0.6 else "hot",
         START + dt.timedelta(minutes=15 * rnd.randint(0, 4 * 24 * 9)))
        for _ in range(120)
    }
    versions = [(k, at, rnd.choice([None, rnd.randint(1, 99)])) for k, at in sorted(times)]
    table = spark.createDataFrame(versions, "k string, since timestamp_ntz, price int")
    got = as_of(frame, "at", table, "since", ["k"], "price", "price")

    def current(key, at):
        known = [(since, price) for k, since, price in versions if k == key and since <= at]
        return max(known, key=lambda v: v[0])[1] if known else None

    want = sorted((r[2], current(r[0], r[1])) for r in rows)
    assert sorted(((r.id, r.price) for r in got.collect()), key=lambda v: v[0]) == want


def test_as_of_carries_key_and_time_once(spark):
    """They are taken from the exchange's own columns; where the types differ, the rows keep theirs."""
    moment = dt.datetime(2026, 1, 2, 10)
    rows = spark.createDataFrame(
        [("a", moment, 1), ("a", None, 2), (None, moment, 3), ("b", moment, 4)], "k string, at timestamp_ntz, id int"
    )
    versions = spark.createDataFrame([("a", dt.datetime(2026, 1, 1), 5)], "k string, since timestamp_ntz, price int")
    got = as_of(rows, "at", versions, "since", ["k"], "price", "price")
    assert got.columns == ["k", "at", "id", "price"]
    want = [("a", moment, 1, 5), ("a", None, 2, None), (None, moment, 3, None), ("b", moment, 4, None)]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_row_id" in plan and "_row_k" not in plan and "_row_at" not in plan
    days = rows.withColumn("at", F.to_date("at"))
    got = as_of(days, "at", versions, "since", ["k"], "price", "price")
    assert got.schema["at"].dataType.simpleString() == "date" and got.where("id = 1").first().price == 5


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, _loaded_at int")


def test_upsert_guard(spark):
    target = keyed(spark, [("a", 1, 5), ("b", 1, 5), ("c", 1, 5)])
    changes = keyed(spark, [("a", 2, 6), ("b", 2, 4), ("c", 2, 5), ("d", 2, 1)])
    want = [("a", 2, 6), ("b", 1, 5), ("c", 2, 5), ("d", 2, 1)]
    assert collected(upsert(target, changes, ["k"])) == want
    fresh = drop_stale(changes, target, ["k"])
    assert collected(fresh) == [("a", 2, 6), ("c", 2, 5), ("d", 2, 1)]
    assert collected(overlay(target, fresh, ["k"])) == want
    assert collected(insert_if_absent(target, changes, ["k"])) == [("a", 1, 5), ("b", 1, 5), ("c", 1, 5), ("d", 2, 1)]


def test_keyed_table_equals_upserts_in_order(spark, root):
    rnd = random.Random(11)
    schema = keyed(spark, []).schema
    table = KeyedTable(spark, root, ("k",), schema)
    assert table.read().count() == 0 and table.last_run() == -1
    state = {}
    for run in range(8):
        batch = {f"k{rnd.randint(0, 9)}": (rnd.randint(0, 99), rnd.randint(0, 5)) for _ in range(5)}
        table.merge(keyed(spark, [(k, *v) for k, v in batch.items()]), run)
        if run == 4:  # a repeated run changes nothing
            table.merge(keyed(spark, [(k, *v) for k, v in batch.items()]), run)
        if run in (2, 5):
            table.compact()
        for k, (v, at) in batch.items():
            if k not in state or at >= state[k][1]:
                state[k] = (v, at)
        assert collected(table.read()) == sorted((k, *v) for k, v in state.items())
    assert table._last_snapshot() == 5 and table._last_snapshot(before=5) == 2
    assert {r.k for r in table.changes(after=6).collect()} <= set(batch)


def test_compaction_is_a_step_of_its_own(spark, root):
    table = KeyedTable(spark, root, ("k",), keyed(spark, []).schema)
    table.compact()
    for run in range(3):
        table.merge(keyed(spark, [("k1", run, run), (f"k{run + 2}", run, run)]), run)
    before = collected(table.read())
    assert table._last_snapshot() == -1
    table.compact(before=2)
    table.compact()
    table.compact()
    assert (table._last_snapshot(), table._last_snapshot(before=2)) == (2, 1) and collected(table.read()) == before
    assert {r.k for r in table.read(before=2).collect()} == {"k1", "k2", "k3"}


def test_probes_do_not_grow_with_the_history(spark, root, monkeypatch):
    probes = []
    monkeypatch.setattr(folders, "_is_finished", lambda spark, root, label, n: probes.append(n) or 0 <= n <= last)
    monkeypatch.setattr(folders, "_numbers", lambda *_: pytest.fail("a listing"))
    for last in (-1, 0, 1, 6, 7, 49, 50, 35_000):
        probes.clear()
        assert folders.last_finished(spark, root, "run") == last
        assert len(probes) <= 2 + 2 * max(last, 1).bit_length()
        after = max(last - 3, -1)
        assert folders.finished_runs(spark, root, "run", after) == list(range(after + 1, last + 1))
    assert folders.last_finished(spark, root, "run", before=9) == 8


def test_missing_keys_and_rejects(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), (" ", "x", 2), (None, "x", 3), ("b", None, 4)], "k1 string, k2 string, _source_file int"
    )
    ok, bad = split_missing_key(df, ["k1", "k2"])
    assert collected(ok) == [("a", "x", 1)]
    rejected = reject_rows(bad, "t", "missing_primary_key", F.localtimestamp()).orderBy("source_file").collect()
    assert [r.row_json for r in rejected] == [
        '{"k1":" ","k2":"x","_source_file":"2"}',
        '{"k1":null,"k2":"x","_source_file":"3"}',
        '{"k1":"b","k2":null,"_source_file":"4"}',
    ]


@pytest.mark.parametrize("few", [0, 1, 1000])
def test_references_by_broadcast_and_by_counted_keys(spark, monkeypatch, few):
    monkeypatch.setattr(integrity, "BROADCAST_KEYS", few)
    rows = [(i, None if i % 7 == 0 else f"k{i % 5}", None if i % 11 == 0 else i % 4) for i in range(60)]
    child = spark.createDataFrame(rows, "id int, fk string, number int")
    texts = spark.createDataFrame([("k0",), ("k1",), ("k1",), ("k2",)], "pk string")
    numbers = spark.createDataFrame([(1,)], "pk int")
    references = {"fk": (texts, "pk"), "number": (numbers, "pk")}
    lost = [("fk", k) for _, k, _ in rows if k in ("k3", "k4")] + [("number", str(n)) for *_, n in rows if n in (0, 2, 3)]
    want = sorted((fk, key, lost.count((fk, key))) for fk, key in set(lost))
    assert sorted(collected(reference_violations(child, references))) == want
    passed, held = split_by_references(child, references)
    bad = {i for i, k, n in rows if k in ("k3", "k4") or n in (0, 2, 3)}
    assert {r.id for r in held.collect()} == bad and held.count() == len(bad)
    assert {r.id for r in passed.collect()} == set(range(60)) - bad and passed.count() == 60 - len(bad)


def test_references(spark):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "x")], "id int, fk string")
    parent = spark.createDataFrame([("a",), ("b",)], "pk string")
    assert collected(reference_violations(child, {"fk": (parent, "pk")})) == [("fk", "x", 2)]
    passed, held = split_by_references(child, {"fk": (parent, "pk")})
    assert collected(passed.select("id")) == [(1,), (3,)]
    assert collected(held.select("id")) == [(2,), (4,)]


def test_snapshot_diff_by_digest(spark):
    rng = random.Random(3)
    layout = "id int, part string, x string, y int"
    rows = [(i, rng.choice("ab"), rng.choice(["p", "q", None]), rng.choice([1, 2, None])) for i in range(400)]
    after = rows[10:] + [(i, "a", "new", 1) for i in range(500, 510)]
    # A value that moves to another column, a value that turns NULL, and one that stops being NULL.
    after[5], after[6], after[7] = (15, "a", None, 7), (16, "b", "z", None), (17, "b", None, None)
    one, two = (spark.createDataFrame(r, layout) for r in (rows, after))
    key = ["id", "part"]
    want = sorted(collected(snapshot_diff(one, two, key)))
    for buckets in (1, 64, 5000):
        assert sorted(collected(snapshot_diff_by_digest(one, two, key, buckets))) == want
    kept = bucket_digests(one, key, 64)
    assert sorted(collected(snapshot_diff_by_digest(one, two, key, 64, kept))) == want
    assert differing_buckets(kept, bucket_digests(one.repartition(3), key, 64)).count() == 0
    few = differing_buckets(bucket_digests(one, key, 5000), bucket_digests(two, key, 5000)).count()
    assert 0 < few <= len({(r[0], r[1]) for r in set(rows) ^ set(after)})
    swapped = spark.createDataFrame([(1, "a", None, 1)], "id int, part string, x int, y int")
    other = spark.createDataFrame([(1, "a", 1, None)], "id int, part string, x int, y int")
    assert collected(snapshot_diff_by_digest(swapped, other, key)) == [(1, "a", "update", "x,y")]
    nothing = one.limit(0)
    assert {r.change for r in snapshot_diff_by_digest(nothing, two, key).collect()} == {"insert"}


def test_snapshot_diff(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "id int, x string, y int")
    after = spark.createDataFrame([(1, "a", None), (2, "B", None), (4, "d", 1)], "id int, x string, y int")
    assert collected(snapshot_diff(before, after, ["id"])) == [
        (1, "unchanged", ""), (2, "update", "x,y"), (3, "absent", ""), (4, "insert", "")
    ]


@pytest.mark.parametrize("seed", range(4))
def test_overlapping_periods(spark, seed):
    rnd = random.Random(seed)
    periods = []
    for i in range(60):
        start = START + dt.timedelta(hours=6 * rnd.randint(0, 400))
        if i % 3 == 0:  # a third starts at one moment
            start = START + dt.timedelta(days=50)
        periods.append((f"P{i:03d}", start, start + dt.timedelta(hours=rnd.randint(-5, 40))))
    valid = sorted((s, k, e) for k, s, e in periods if s <= e)
    want = {k for i, (s, k, _) in enumerate(valid) if any(e2 >= s for _, _, e2 in valid[:i])}
    df = spark.createDataFrame(periods, "id string, s timestamp_ntz, e timestamp_ntz")
    found = q.overlapping_periods(df, "promotions", ["id"], "s", "e").collect()
    assert {r.record_key for r in found} == want and len(found) == len(want)


def test_duplicate_rows_do_not_mix_up_values(spark):
    df = spark.createDataFrame(
        [("a", "1", "23"), ("a", "12", "3"), ("a", None, "3"), ("a", "", "3"), ("b", "1", "2"), ("b", "1", "2")],
        "k string, x string, y string",
    )
    found = q.duplicate_rows(df, "t", ["k"], ["x", "y"]).collect()
    assert [(r.record_key, r.detail) for r in found] == [("b", "2")]


def test_number_and_measure_rules(spark):
    df = spark.createDataFrame(
        [("a", "1,5"), ("b", "1.234,56"), ("c", ""), ("d", "-2"), ("e", "0"), ("f", "7"), ("g", "1e400")],
        "k string, n string",
    )
    found = {r.record_key: r.detail for r in q.matching(df, "t", ["k"], q.number_format("n")).collect()}
    assert found == {"a": "decimal_comma", "b": "unreadable", "g": "unreadable"}
    assert {r.record_key: r.detail for r in q.matching(df, "t", ["k"], q.not_positive("n")).collect()} == {
        "d": "negative", "e": "zero"
    }
    bounds = q.out_of_bounds("n", 1, 5)
    assert [r.record_key for r in q.matching(df, "t", ["k"], bounds).collect()] == ["d", "e", "f", "g"]
    together = q.check_rows(df, "t", ["k"], [q.number_format("n"), q.not_positive("n"), bounds])
    apart = [q.matching(df, "t", ["k"], rule) for rule in (q.number_format("n"), q.not_positive("n"), bounds)]
    assert collected(together) == collected(apart[0].unionByName(apart[1]).unionByName(apart[2]))


def test_cost_ratio_keeps_the_bounds(spark):
    costs = spark.createDataFrame(
        [("p", Decimal(c)) for c in ("50", "80", "49.99", "80.01")], "product_id string, cost decimal(18,4)"
    )
    products = spark.createDataFrame([("p", Decimal("100"))], "product_id string, price decimal(18,4)")
    found = q.cost_ratio(costs, "t", ["cost"], "product_id", "cost", products, "price", "0.50", "0.80")
    assert sorted(r.record_key for r in found.collect()) == ["49.9900", "80.0100"]


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_many_keys_in_small_files_are_not_broadcast(spark, tmp_path):
    """Their hash table is many times as large as their file: which join it takes is decided when the rows are counted."""
    configure_stored(spark)
    try:
        spark.range(400_000).select(F.left(F.md5(F.col("id").cast("string")), F.lit(12)).alias("k")).write.options(**STORED).parquet(f"{tmp_path}/k")
        keys = spark.read.parquet(f"{tmp_path}/k")
        assert sum(p.stat().st_size for p in tmp_path.glob("k/*.parquet")) < 10 << 20
        assert "BroadcastHashJoin" not in _plan(overlay(spark.range(9).select(F.col("id").cast("string").alias("k")), keys, ["k"]))
        keys.limit(5).write.parquet(f"{tmp_path}/few")
        few = spark.read.parquet(f"{tmp_path}/few")
        assert "BroadcastHashJoin" in _plan(overlay(keys, few, ["k"]))
        # The reference check asks for no more of them to be broadcast either.
        assert "BroadcastHashJoin" not in _plan(reference_violations(few.withColumnRenamed("k", "fk"), {"fk": (keys, "k")}))
    finally:
        configure(spark)
