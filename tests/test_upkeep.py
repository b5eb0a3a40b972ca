"""Views kept up by change, and silver in buckets."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.plans import gold as gold_plan, upkeep
from tillmark.plans.gold import DIM_CUSTOMER, DIM_PRODUCT, DIM_STORE, FACT_SALES, Gold, dim_date, fact_sales
from tillmark.plans.silver import Silver
from tillmark.plans.upkeep import KeptViews
from tillmark.plans.views import all_views
from tillmark.sources.bucketed import read_bucketed
from tillmark.specs import TABLES

CALENDAR = ("2026-01-01", "2026-03-31")


def plan_of(df):
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture
def star(spark):
    made = {
        "dim_date": dim_date(spark, *CALENDAR),
        "dim_customer": spark.createDataFrame(
            [(f"C{i}", "n", None, None, None, "AB"[i % 2] if i < 5 else None, None, None) for i in range(6)], DIM_CUSTOMER
        ),
        "dim_store": spark.createDataFrame([(f"S{i}", f"store {i}", "x", None, None) for i in range(3)], DIM_STORE),
        "dim_product": spark.createDataFrame([(f"P{i}", f"p {i}", None, None, None, None) for i in range(5)], DIM_PRODUCT),
    }
    return made


def test_kept_views_equal_views_from_scratch(spark, root, star):
    """Rounds of random changes: sales appear, change status, product, store, customer, date and order."""
    rng, sales = random.Random(6), {}
    gold = Gold(spark, root, CALENDAR)
    table, kept = gold.table("fact_sales"), KeptViews(gold)
    days = [r.date_key for r in star["dim_date"].collect()]

    def sale(item):
        quantity, price = rng.randint(1, 5), rng.randint(1, 9)
        status = rng.choice(["pending", "completed", "completed", "cancelled", None])
        return (
            item, f"O{rng.randrange(12)}", rng.choice(days), f"C{rng.randrange(6)}", rng.choice([f"P{rng.randrange(5)}", None]),
            f"S{rng.randrange(3)}", rng.choice(["card", "cod", None]), status, quantity, price, quantity * price,
        )

    def rows(items, number):
        stamp = F.lit(f"2026-05-{number + 1:02d} 00:00:00").cast("timestamp_ntz")
        layout = T.StructType.fromDDL(FACT_SALES.replace("decimal(18,4)", "bigint")).fields[:-1]
        df = spark.createDataFrame([sales[i] for i in items], T.StructType(layout)).withColumn("_loaded_at", stamp)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(FACT_SALES)])

    def same():
        scratch = all_views({**star, "fact_sales": gold.read("fact_sales")})
        for name, df in kept.views(star).items():
            want = scratch[name].select(*df.columns).collect()
            assert [tuple(map(str, r)) for r in df.collect()] == [tuple(map(str, r)) for r in want], name

    for number, items in enumerate([range(40), rng.sample(range(60), 15), rng.sample(range(60), 25), range(0, 60, 2)]):
        for i in items:
            sales[f"I{i}"] = sale(f"I{i}")
        table.merge(rows([f"I{i}" for i in items], number), number)
        if number != 1:  # one refresh takes in two runs
            assert kept.refresh() and not kept.refresh()
            same()
    # Everything cancelled: no group is left.
    sales.update({i: (*s[:7], "cancelled", *s[8:]) for i, s in sales.items()})
    table.merge(rows(list(sales), 9), 4)
    kept.refresh()
    same()
    assert kept.state("store").count() == 0
    # A refresh cut off before its mark is repeated under its number.
    sales["I0"] = (*sales["I0"][:7], "completed", *sales["I0"][8:])
    table.merge(rows(["I0"], 10), 5)
    run, _ = kept._last_mark()
    kept._table("store").merge(kept._table("store").empty(), run + 1, guard=False)
    same_before = kept.state("store").count()
    assert same_before == 0 and kept.refresh()
    same()


def test_buckets_spare_the_exchange_and_are_pruned(spark, root, monkeypatch):
    silver = Silver(spark, root, 8)
    orders = [(f"O{i}", "C1", "S1", None, "card", "pending", "f", None) for i in range(300)]
    items = [(f"I{i}", f"O{i % 300}", "P1", 1, None, "f", None) for i in range(900)]
    names = {"orders": orders, "order_items": items}
    for name, data in names.items():
        spec = TABLES[name]
        df = spark.createDataFrame(data, spec.silver_schema())
        table = silver.table(name)
        table.merge(df, 0, guard=False)
        table.compact()
        assert table.read().count() == len(data)
    full = fact_sales(silver.table("order_items").read().fillna({"unit_price": 1}), silver.table("orders").read())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(full)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        mine = F.col("order_id").isin("O5", "O17")
        few = fact_sales(silver.table("order_items").read().where(mine), silver.table("orders").read().where(mine))
        counts = re.findall(r"SelectedBucketsCount: (\d+) out of 8", plan_of(few))
        assert len(counts) == 2 and all(int(n) <= 2 for n in counts) and "Exchange" not in plan_of(few)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Another number of buckets starts from the runs again, and a hot order is divided between files.
    assert Silver(spark, root, 4).table("orders").read().count() == 300
    assert gold_plan.NAMED_ORDERS > 0


def test_refresh_writes_the_touched_sales_once(spark, root):
    """Of an item that moved, of a compacted or uncompacted table: both orders' sales, and what holds of each."""
    gold = Gold(spark, root, CALENDAR, 8)
    table, kept = gold.table("fact_sales"), KeptViews(gold)
    staged = f"{root}/gold/views_staged/sales"

    def rows(sales, day):
        data = [(i, o, 20260101, "C1", "P1", "S1", "card", "pending", 1, None, None, None) for i, o in sales]
        stamp = F.lit(f"2026-05-{day:02d} 00:00:00").cast("timestamp_ntz")
        df = spark.createDataFrame(data, FACT_SALES)
        return df.withColumns({"_loaded_at": stamp, "line_amount": F.lit(2).cast("decimal(18,4)")})

    def held():
        marked = spark.read.parquet(staged).groupBy("order_id").agg(F.sum("_was"), F.sum("_now"))
        return {r[0]: tuple(r[1:]) for r in marked.collect()}

    table.merge(rows([("I1", "O1"), ("I2", "O1"), ("I3", "O2"), ("I4", "O3")], 1), 0)
    kept.refresh()
    assert held() == {"O1": (0, 2), "O2": (0, 1), "O3": (0, 1)}
    table.merge(rows([("I1", "O2")], 2), 1)
    kept.refresh()
    assert held() == {"O1": (2, 1), "O2": (1, 2)}
    table.merge(rows([("I1", "O3"), ("I5", "O4")], 3), 2)
    table.merge(rows([("I5", "O3")], 4), 3)
    table.compact()
    kept.refresh()
    assert held() == {"O2": (2, 1), "O3": (1, 3)}
    assert [tuple(r) for r in kept.state("store").select("sales", "order_count", "units").collect()] == [(5, 3, 5)]
    # What an order holds in a group is counted where its sales lie.
    layout = T.StructType.fromDDL(upkeep.TOUCHED)
    assert "Exchange" not in plan_of(upkeep.per_order(read_bucketed(spark, staged, layout, "order_id", 8), "store"))
