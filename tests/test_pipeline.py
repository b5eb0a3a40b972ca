"""The whole run on a small hand-made retail data set with worked-out results."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillmark.plans import audit, medallion, silver
from tillmark.plans import gold as gold_plans
from tillmark.plans.bronze import Bronze, ingest_all, tenant_dir, totals
from tillmark.plans.gold import BrokenReferenceError, Gold
from tillmark.plans.report import best_products, export_views, payment_share
from tillmark.plans.silver import Silver, transform_all
from tillmark.sources.csv_drops import describe_files, list_drops
from tillmark.sources.folders import any_match, finished_runs
from tillmark.specs import CORE, TABLES
from tillmark.streaming.ingest import ingest_available, start_ingest
from tillmark.streaming.transform import fold, transform_available

ONE, TWO = "20260708_132510", "20260708_141106"


def first_drop(raw):
    raw("categories", ONE, "category_id,category_name\nK1,Toys\nK2,Books\n")
    raw("stores", ONE, "store_id,store_name,city,opened_date\nS1,North,Oslo,2020-01-02\nS2,South,Rome,02/01/2020\n")
    raw("products", ONE, 'product_id,product_name,category_id,unit_price\nP1,Ball,K1,"10,5"\nP2,Atlas,K2,20\nP3,Odd,,5\n')
    raw(
        "customers",
        ONE,
        "customer_id,name,email,phone,city,join_date,segment\n"
        'C1,"  Ann ""A"", B.  ",a@x,1,Oslo,2024-05-01,Gold\nC2,Bob,,2,ROME,2024-05-02,Silver\n',
    )
    raw(
        "orders",
        ONE,
        "order_id,customer_id,store_id,order_date,payment_method,status\n"
        "O1,C1,S1,2026-07-08 10:00:00,cod,completed\n"
        "O2,C2,S2,08/07/2026 11:00:00,qris,pending\n"
        "O3,C1,S1,2026-07-09 09:00:00,cod,cancelled\n"
        "O2,C2,S2,08/07/2026 11:00:00,qris,completed\n"
        " ,C2,S2,2026-07-08 11:00:00,qris,pending\n",
    )
    raw(
        "order_items",
        ONE,
        "order_item_id,order_id,product_id,quantity,unit_price\n"
        'I1,O1,P1,2,"10,5"\nI2,O1,P2,1,20\nI3,O2,P2,3,21\nI4,O3,P1,1,10.5\nI5,O2,P3,-1,5\nI6,O9,P1,1,1\n',
    )


def second_drop(raw):
    raw("categories", TWO, "category_id,category_name\nK1,Games\nK2,Books\n")
    raw(
        "orders",
        TWO,
        "order_id,customer_id,store_id,order_date,payment_method,status\n"
        "O1,C1,S1,2026-07-08 10:00:00,cod,cancelled\nO4,C2,S1,2026-08-01,cod,pending\n",
    )
    raw(
        "order_items",
        TWO,
        "unit_price,order_item_id,order_id,product_id,quantity,note\n"
        "5,I5,O2,P3,4,fixed\n7,I3,O2,P2,-9,broken later\n10,I7,O4,P1,1,new\n",
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_two_rounds(spark, raw, root):
    first_drop(raw)
    ingested, transformed, views = medallion.run(spark, raw.dir, root)
    stats = {r.table: (r.files_loaded, r.rows_loaded) for r in ingested.collect()}
    assert stats["orders"] == (1, 5) and stats["order_items"] == (1, 6) and stats["payments"] == (0, 0)
    assert [r.table for r in ingested.collect()] == list(TABLES)
    assert rows(totals(ingested)) == [(6, 20)]
    stats = {r.table: (r.rows_upserted, r.rows_rejected) for r in transformed.collect()}
    assert stats["orders"] == (3, 1) and stats["order_items"] == (6, 0) and stats["payments"] == (0, 0)

    assert rows(views["vw_revenue_by_store"]) == [
        ("S2", "South", "Rome", 1, Decimal("63.0000")), ("S1", "North", "Oslo", 1, Decimal("41.0000"))
    ]
    assert rows(views["vw_top_products"]) == [
        ("P2", "Atlas", "Books", 4, Decimal("83.0000")), ("P1", "Ball", "Toys", 2, Decimal("21.0000"))
    ]
    assert rows(views["vw_monthly_sales_trend"]) == [(2026, 7, "July", Decimal("104.0000"), 2)]
    assert [(r.segment, r.customer_count, r.avg_order_value) for r in views["vw_customer_segment_revenue"].collect()] == [
        ("Silver", 1, Decimal("63")), ("Gold", 1, Decimal("41"))
    ]
    assert rows(payment_share(views["vw_payment_method_mix"]).select("payment_method", "share_pct")) == [
        ("qris", Decimal("60.6")), ("cod", Decimal("39.4"))
    ]

    silver = Silver(spark, root)
    ann = silver.read("customers").where("customer_id = 'C1'").first()
    assert ann.name == 'Ann "A", B.' and ann.join_date == dt.datetime(2024, 5, 1)
    assert silver.read("customers").where("customer_id = 'C2'").first().email is None
    assert {r.opened_date for r in silver.read("stores").collect()} == {dt.datetime(2020, 1, 2)}
    reject = silver.rejects().first()
    assert (reject.table_name, reject.reason) == ("orders", "missing_primary_key")
    assert '"order_id":null' in reject.row_json and reject.source_file.endswith(f"orders_{ONE}.csv")

    # Nothing new: nothing changes, on any layer.
    before = {t: sorted(rows(silver.read(t)), key=repr) for t in CORE}
    ingested, transformed, views = medallion.run(spark, raw.dir, root)
    assert {r.files_loaded for r in ingested.collect()} == {0}
    assert {(r.rows_upserted, r.rows_rejected) for r in transformed.collect()} == {(0, 0)}
    assert {t: sorted(rows(silver.read(t)), key=repr) for t in CORE} == before
    assert silver.rejects().count() == 1
    assert Gold(spark, root).table("fact_sales").last_run() == 0

    second_drop(raw)
    _, _, views = medallion.run(spark, raw.dir, root)
    fact = {r.order_item_id: r for r in Gold(spark, root).read("fact_sales").collect()}
    assert set(fact) == {"I1", "I2", "I3", "I4", "I5", "I7"}
    # An item that can no longer be used keeps its last good row; an order's new status reaches its items.
    assert (fact["I3"].quantity, fact["I3"].line_amount) == (3, Decimal("63.0000"))
    assert fact["I1"].order_status == fact["I2"].order_status == "cancelled"
    assert fact["I5"].line_amount == Decimal("20.0000") and fact["I7"].date_key == 20260801
    products = {r.product_id: r.category_name for r in Gold(spark, root).read("dim_product").collect()}
    assert products == {"P1": "Games", "P2": "Books", "P3": None}
    assert rows(views["vw_revenue_by_store"]) == [
        ("S2", "South", "Rome", 1, Decimal("83.0000")), ("S1", "North", "Oslo", 1, Decimal("10.0000"))
    ]
    assert rows(best_products(views["vw_top_products"], 2).select("product_id")) == [("P3",), ("P2",)]
    assert rows(spark.table("vw_payment_method_mix")) == rows(views["vw_payment_method_mix"])

    paths = export_views(views, f"{root}/report")
    back = spark.read.option("header", True).csv(paths["Revenue by Store"])
    assert [r.store_id for r in back.collect()] == ["S2", "S1"]


STAR = {
    "dim_date": "date_key int, full_date date, year int, quarter int, month int, month_name string, day int, "
    "day_name string, is_weekend boolean",
    "dim_customer": "customer_id string, name string, email string, phone string, city string, segment string, "
    "join_date timestamp_ntz, _loaded_at timestamp_ntz",
    "dim_store": "store_id string, store_name string, city string, opened_date timestamp_ntz, _loaded_at timestamp_ntz",
    "dim_product": "product_id string, product_name string, category_id string, category_name string, "
    "unit_price decimal(18,4), _loaded_at timestamp_ntz",
    "fact_sales": "order_item_id string, order_id string, date_key int, customer_id string, product_id string, "
    "store_id string, payment_method string, order_status string, quantity bigint, unit_price decimal(18,4), "
    "line_amount decimal(18,4), _loaded_at timestamp_ntz",
}
ITEMS = "order_item_id string, order_id string, product_id string, quantity bigint, unit_price decimal(18,4)"


def test_types_of_the_stored_tables(spark, raw, root):
    first_drop(raw)
    _, _, views = medallion.run(spark, raw.dir, root)
    gold, silver = Gold(spark, root), Silver(spark, root)

    def types(df):
        return [(f.name, f.dataType) for f in df.schema.fields]

    for name, layout in STAR.items():
        assert types(gold.read(name)) == types(spark.createDataFrame([], layout)), name
    lineage = ", _source_file string, _loaded_at timestamp_ntz"
    assert types(silver.read("order_items")) == types(spark.createDataFrame([], ITEMS + lineage))
    assert {f.dataType.typeName() for v in views.values() for f in v.schema.fields if f.name == "revenue"} == {"decimal"}
    mark = spark.read.parquet(f"{root}/control/silver/table_name=orders").first()
    assert mark.last_loaded_at == silver.read("orders").agg(F.max("_loaded_at")).first()[0]


def test_a_silver_run_without_its_mark_is_not_seen(spark, raw, root):
    first_drop(raw)
    silver, gold = Silver(spark, root), Gold(spark, root)
    ingest_all(spark, root, raw.dir)
    state = silver.table("stores")
    state.merge(spark.createDataFrame([("S1", *[None] * 5)], state.schema), 0)
    rejected = "reason string, row_json string, source_file string, rejected_at timestamp_ntz"
    spark.createDataFrame([("r", "{}", "f", None)], rejected).write.parquet(f"{root}/silver_rejects/table_name=stores/run=0")
    assert silver.read("stores").count() == 0 == silver.rejects().count()
    gold.build_dims()
    assert gold.read("dim_store").count() == 0
    transform_all(spark, root)
    gold.build_dims()
    assert gold.read("dim_store").count() == 2 and silver.rejects().count() == 1
    medallion.compact(spark, root)
    assert gold.read("dim_store").count() == 2 == silver.read("stores").count()


def test_views_are_there_for_later_sessions(spark, raw, root):
    first_drop(raw)
    _, _, views = medallion.run(spark, raw.dir, root)
    stored = medallion.stored_views(spark, root)
    assert {name: rows(v) for name, v in stored.items()} == {name: rows(v) for name, v in views.items()}


def test_late_file_with_an_old_name_still_wins(spark, raw, root):
    bronze, silver = Bronze(spark, root), Silver(spark, root)
    raw("categories", TWO, "category_id,category_name\nK1,Second\n")
    bronze.ingest(raw.dir, "categories")
    silver.transform("categories")
    raw("categories", ONE, "category_id,category_name\nK1,Late\n")
    bronze.ingest(raw.dir, "categories")
    silver.transform("categories")
    assert silver.read("categories").first().category_name == "Late"


def test_files_of_one_run_apply_in_name_order(spark, raw, root):
    raw("categories", TWO, "category_id,category_name\nK1,Second\n")
    raw("categories", ONE, "category_id,category_name\nK1,First\nK1,First again\nK2,Other\n")
    Bronze(spark, root).ingest(raw.dir, "categories")
    Silver(spark, root).transform("categories")
    assert sorted(r.category_name for r in Silver(spark, root).read("categories").collect()) == ["Other", "Second"]


def test_a_batch_without_log_entry_is_not_seen_and_is_replaced(spark, raw, root):
    first_drop(raw)
    bronze = Bronze(spark, root)
    bronze.ingest(raw.dir, "stores")
    # What an attempt leaves that was cut off before its log entry.
    bronze.read("stores").drop("_batch_id").write.parquet(f"{bronze.table_path('stores')}/_batch_id=1")
    assert bronze.read("stores").count() == 2
    raw("stores", TWO, "store_id,store_name,city,opened_date\nS3,East,Bonn,\n")
    bronze.ingest(raw.dir, "stores")
    assert sorted(r.store_id for r in bronze.read("stores").collect()) == ["S1", "S2", "S3"]


def test_silver_run_cut_off_before_its_mark_is_repeated(spark, raw, root):
    first_drop(raw)
    Bronze(spark, root).ingest(raw.dir, "orders")
    silver = Silver(spark, root)
    state = silver.table("orders")
    state.merge(spark.createDataFrame([("X", *[None] * 7)], state.schema), 0)
    assert silver.transform("orders") == ("orders", 3, 1)
    assert sorted(r.order_id for r in silver.read("orders").collect()) == ["O1", "O2", "O3"]
    assert silver.rejects().count() == 1


def test_missing_tables_and_empty_files(spark, raw, root):
    raw("orders", ONE, "order_id,customer_id,store_id,order_date,payment_method,status\n")
    stats = {r.table: (r.files_loaded, r.rows_loaded) for r in ingest_all(spark, root, raw.dir).collect()}
    assert stats["orders"] == (1, 0) and stats["employees"] == (0, 0)
    assert {r.files_loaded for r in ingest_all(spark, root, raw.dir).collect()} == {0}
    assert {r.rows_upserted for r in transform_all(spark, root).collect()} == {0}


def test_columns_bind_by_name(spark, raw, root):
    raw("stores", "1", "city,store_id,extra,store_name\nOslo,S1,x,North\n")
    raw("stores", "2", "﻿store_id\r\nS2\r\n")
    raw("stores", "3", "other\nS3\n")
    raw("stores", "4", "store_id,store_name,city,opened_date\nS4,,NA,\n")
    Bronze(spark, root).ingest(raw.dir, "stores")
    got = Bronze(spark, root).read("stores").select(*TABLES["stores"].names, "_batch_ts")
    assert sorted(rows(got)) == [
        ("", "", "", "", None), ("S1", "North", "Oslo", "", None), ("S2", "", "", "", None), ("S4", "", "NA", "", None)
    ]


def test_files_with_line_breaks_inside_fields_are_told_apart(spark, raw, root):
    header = "review_id,customer_id,product_id,rating,review_text,review_date\n"
    raw("product_reviews", "1", header + 'R1,C1,P1,5,"two\nlines, ""quoted""",2026-07-08\nR2,C1,P1,4,plain,2026-07-08\n')
    raw("product_reviews", "2", header + 'R3,C1,P1,3,"a, ""b""",2026-07-08\n')
    files = [r.path for r in list_drops(spark, raw.dir, "product_reviews").orderBy("path").collect()]
    layout = describe_files(spark, files, TABLES["product_reviews"]).orderBy("file_path").collect()
    assert [r.multiline for r in layout] == [True, False] and {r.header for r in layout} == {header.strip()}
    Bronze(spark, root).ingest(raw.dir, "product_reviews")
    texts = {r.review_id: r.review_text for r in Bronze(spark, root).read("product_reviews").collect()}
    assert texts == {"R1": 'two\nlines, "quoted"', "R2": "plain", "R3": 'a, "b"'}


def test_records_that_span_lines_are_read_in_parallel(spark, raw, root):
    """One file, many blocks: fields with line breaks and quotes cross the borders of blocks."""
    rng = random.Random(9)
    header = "review_id,customer_id,product_id,rating,review_text,review_date"
    texts = {}
    for i in range(600):
        words = [rng.choice(["plain", "a,b", '"q"', "two\nlines", "\n\n", "x\r\ny", "end\n", "é" * 40]) for _ in range(rng.randint(0, 6))]
        texts[f"R{i}"] = " ".join(words)
    quoted = lambda t: '"' + t.replace('"', '""') + '"' if any(c in t for c in ',"\n\r') else t
    lines = [f"{k},C1,P1,5,{quoted(t)},2026-07-08" for k, t in texts.items()]
    lines.insert(3, "")
    lines.append("R600,C1")  # a short row
    raw("product_reviews", ONE, header + "\r\n" + "\r\n".join(lines) + "\r\n")
    texts["R600"] = ""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        Bronze(spark, root).ingest(raw.dir, "product_reviews")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    rows = Bronze(spark, root).read("product_reviews").orderBy("_block_start", "_row_id").collect()
    assert [r.review_id for r in rows] == [f"R{i}" for i in range(601)]
    assert {r.review_id: r.review_text.strip() for r in rows} == {k: t.strip() for k, t in texts.items()}
    assert len({r._block_start for r in rows}) > 5


def test_rows_of_a_split_file_stay_in_order(spark, raw, root):
    lines = "".join(f"K{i % 50},name {i}\n" for i in range(20000))
    raw("categories", ONE, "category_id,category_name\n" + lines)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        Bronze(spark, root).ingest(raw.dir, "categories")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert Bronze(spark, root).read("categories").select("_block_start").distinct().count() > 3
    Silver(spark, root).transform("categories")
    got = {r.category_id: r.category_name for r in Silver(spark, root).read("categories").collect()}
    assert got == {f"K{i}": f"name {19950 + i}" for i in range(50)}


def test_files_are_loaded_in_batches(spark, raw, root):
    for i in range(5):
        raw("categories", f"2026070{i + 1}_000000", f"category_id,category_name\nK1,v{i}\nK{i + 2},x\n")
    bronze = Bronze(spark, root)
    assert bronze.load_listing(list_drops(spark, raw.dir, "categories"), "categories", files_per_batch=2) == [0, 1, 2]
    assert finished_runs(spark, bronze.log_path("categories"), "_batch_id") == [0, 1, 2]
    Silver(spark, root).transform("categories")
    got = {r.category_id: r.category_name for r in Silver(spark, root).read("categories").collect()}
    assert got["K1"] == "v4" and len(got) == 6


def test_stream_loads_each_file_once(spark, raw, root):
    assert start_ingest(spark, raw.dir, root, "stores") is None
    first_drop(raw)
    for _ in range(2):
        ingest_available(spark, raw.dir, root, "orders")
        assert Bronze(spark, root).read("orders").count() == 5
    second_drop(raw)
    ingest_available(spark, raw.dir, root, "orders")
    assert Bronze(spark, root).read("orders").count() == 7
    # Batch ingest and stream share the load log.
    assert Bronze(spark, root).ingest(raw.dir, "orders").files_loaded == 0


def test_silver_by_stream_is_exactly_once(spark, raw, root, monkeypatch):
    header = "category_id,category_name\n"
    bronze, silver = Bronze(spark, root), Silver(spark, root)

    def names():
        return {r.category_id: r.category_name for r in silver.read("categories").collect()}

    transform_available(spark, root, "categories")  # nothing logged yet
    raw("categories", ONE, header + "K1,a\nK2,b\n,x\n")
    bronze.ingest(raw.dir, "categories")
    transform_available(spark, root, "categories")
    assert names() == {"K1": "a", "K2": "b"} and silver.rejects().count() == 1
    raw("categories", TWO, header + "K2,c\n,y\n")
    bronze.ingest(raw.dir, "categories")
    # Cut off between merge and mark: the micro-batch isn't committed and comes again with the next start.
    with monkeypatch.context() as patch:
        patch.setattr("tillmark.plans.silver.any_match", lambda *a: 1 / 0)
        patch.setattr("tillmark.plans.silver.reject_rows", lambda *a: 1 / 0)
        with pytest.raises(StreamingQueryException):
            transform_available(spark, root, "categories")
    assert names() == {"K1": "a", "K2": "b"} and silver.last_run("categories") == 0
    transform_available(spark, root, "categories")
    assert names() == {"K1": "a", "K2": "c"} and silver.last_run("categories") == 1 and silver.rejects().count() == 2
    # A replay and an old micro-batch that comes late change nothing.
    fold(bronze.load_log("categories"), root, "categories")
    fold(bronze.load_log("categories").where("_batch_id = 0"), root, "categories")
    assert silver.last_run("categories") == 1 and silver.rejects().count() == 2
    # Batch runs and the stream share the mark.
    raw("categories", "20260709_000000", header + "K1,d\n")
    bronze.ingest(raw.dir, "categories")
    silver.transform("categories")
    transform_available(spark, root, "categories")
    assert names() == {"K1": "d", "K2": "c"} and silver.last_run("categories") == 2


def test_broken_reference_fails_the_build_until_it_is_mended(spark, raw, root):
    first_drop(raw)
    raw("orders", TWO, "order_id,customer_id,store_id,order_date,payment_method,status\nO9,C7,S1,2026-07-08,cod,pending\n")
    with pytest.raises(BrokenReferenceError, match="customer_id = 'C7'"):
        medallion.run(spark, raw.dir, root)
    assert Gold(spark, root).read("fact_sales").count() == 0
    raw("customers", TWO, "customer_id,name,email,phone,city,join_date,segment\nC7,Eve,,,Oslo,,Gold\n")
    medallion.run(spark, raw.dir, root)
    assert {r.order_item_id for r in Gold(spark, root).read("fact_sales").collect()} == {"I1", "I2", "I3", "I4", "I6"}


def test_quarantine_holds_back_only_broken_rows_and_retries_them(spark, raw, root):
    first_drop(raw)
    raw("orders", TWO, "order_id,customer_id,store_id,order_date,payment_method,status\nO9,C7,S1,2050-07-08,cod,pending\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    assert {r.order_item_id for r in Gold(spark, root).read("fact_sales").collect()} == {"I1", "I2", "I3", "I4"}
    raw("customers", TWO, "customer_id,name,email,phone,city,join_date,segment\nC7,Eve,,,Oslo,,Gold\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    assert Gold(spark, root).read("fact_sales").count() == 4  # the date is still outside the calendar
    medallion.run(spark, raw.dir, root, "quarantine", calendar=("2015-01-01", "2060-12-31"))
    assert Gold(spark, root).read("fact_sales").count() == 5


def test_a_run_that_fails_on_broken_references_leaves_nothing_held_back(spark, raw, root):
    first_drop(raw)
    raw("orders", TWO, "order_id,customer_id,store_id,order_date,payment_method,status\nO9,C7,S1,2026-07-08,cod,pending\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    gold = Gold(spark, root)
    assert {r.order_item_id for r in gold.held_back().collect()} == {"I6"}
    with pytest.raises(BrokenReferenceError):
        medallion.run(spark, raw.dir, root, on_violation="fail")
    assert gold.held_back().count() == 1
    raw("customers", TWO, "customer_id,name,email,phone,city,join_date,segment\nC7,Eve,,,Oslo,,Gold\n")
    medallion.run(spark, raw.dir, root, on_violation="fail")
    assert gold.held_back().count() == 0 and gold.read("fact_sales").count() == 5
    runs = gold.table("fact_sales").last_run()
    medallion.run(spark, raw.dir, root, on_violation="fail")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    assert gold.table("fact_sales").last_run() == runs


def test_a_build_cut_off_at_its_merge_is_repeated(spark, raw, root, monkeypatch):
    first_drop(raw)
    raw("orders", TWO, "order_id,customer_id,store_id,order_date,payment_method,status\nO9,C7,S1,2026-07-08,cod,pending\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    raw("customers", TWO, "customer_id,name,email,phone,city,join_date,segment\nC7,Eve,,,Oslo,,Gold\n")
    ingest_all(spark, root, raw.dir)
    transform_all(spark, root)
    Gold(spark, root).build_dims()
    with monkeypatch.context() as patch:
        patch.setattr("tillmark.plans.gold.KeyedTable.merge", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            Gold(spark, root).build_fact("fail")
    assert Gold(spark, root).held_back().count() == 1
    medallion.run(spark, raw.dir, root, on_violation="fail")
    assert Gold(spark, root).held_back().count() == 0 and Gold(spark, root).read("fact_sales").count() == 5


def test_tenant_folder():
    assert tenant_dir("/data/raw/", "acme") == "/data/raw/acme"


def test_audit(spark, raw, root):
    first_drop(raw)
    second_drop(raw)
    raw(
        "payments", ONE,
        "payment_id,order_id,method,amount,status,paid_at\n"
        "Y1,O1,cod,41,pending,\nY1,O1,cod,41,success,\nY2,O2,qris,1,refunded,\nY3,O3,cod,\"10,5\",pending,\nY3,O3,cod,\"10,5\",pending,\n",
    )
    raw(
        "shipments", ONE,
        "shipment_id,order_id,courier,shipped_date,delivered_date,status\n"
        "H1,O1,,2026-07-09,2026-07-08,delivered\nH2,O99,jne,2026-07-09,,in_transit\nH2,O99,jne,2026-07-09,,lost\n",
    )
    raw("promotions", ONE, "promo_id,promo_code,discount_pct,start_date,end_date\n"
        "M1,A,10,2026-01-01,2026-01-10\nM2,B,120,2026-01-05,2026-01-06\nM3,C,-10,2026-02-01,2026-02-02\n")
    raw("order_promotions", ONE, "order_id,promo_id\nO1,M1\nO1,M999\n")
    raw("employees", ONE, "employee_id,name,store_id,role,hire_date\nE1,Zoe,,Clerk,2030-01-01\n")
    raw("loyalty_points", ONE, "loyalty_id,customer_id,order_id,points_earned,points_redeemed\nL1,C1,O1,-4,0\nL2,C1,O1,7,0\n")
    raw("product_suppliers", ONE, "product_id,supplier_id,cost_price\nP1,V1,6\nP2,V1,-1\nP2,V2,19\n")
    raw("product_reviews", ONE, "review_id,customer_id,product_id,rating,review_text,review_date\nR1,C1,P1,6,,2026-07-08\n")
    ingest_all(spark, root, raw.dir)
    transform_all(spark, root)
    today = F.lit(dt.datetime(2026, 7, 10)).cast("timestamp_ntz")
    found = {(r.table_name, r.rule, r.record_key) for r in audit.warehouse_audit(spark, root, today).collect()}
    assert found == {
        ("customers", "missing_value", "C2"),
        ("customers", "padded_text", "C1"),
        ("products", "missing_value", "P3"),
        ("products", "number_format", "P1"),
        ("orders", "date_format", "O2"),
        ("order_items", "number_format", "I1"),
        ("order_items", "not_positive", "I5"),
        ("order_items", "not_positive", "I3"),
        ("order_items", "price_drift", "I3"),
        ("order_items", "price_drift", "I6"),
        ("order_items", "price_drift", "I7"),
        ("payments", "missing_value", "Y1"),
        ("payments", "unknown_value", "Y2"),
        ("payments", "duplicate_row", "Y3"),
        ("payments", "amount_mismatch", "Y2"),
        ("shipments", "missing_value", "H1"),
        ("shipments", "wrong_order", "H1"),
        ("shipments", "orphan_reference", "H2"),
        ("promotions", "out_of_bounds", "M2"),
        ("promotions", "out_of_bounds", "M3"),
        ("promotions", "overlapping_period", "M2"),
        ("order_promotions", "orphan_reference", "O1|M999"),
        ("employees", "missing_value", "E1"),
        ("employees", "wrong_order", "E1"),
        ("loyalty_points", "not_positive", "L1"),
        ("loyalty_points", "points_mismatch", "L2"),
        ("product_suppliers", "not_positive", "P2|V1"),
        ("product_suppliers", "cost_ratio", "P2|V2"),
        ("product_reviews", "out_of_bounds", "R1"),
        ("product_reviews", "missing_value", "R1"),
    }

    bronze = Bronze(spark, root).read
    moves = audit.table_transitions(bronze, "shipments").collect()
    assert [(r.shipment_id, r.from_status, r.to_status, r.allowed) for r in moves] == [("H2", "in_transit", "lost", False)]
    moves = audit.table_transitions(bronze, "orders").collect()
    assert sorted((r.order_id, r.from_status, r.to_status, r.allowed) for r in moves) == [
        ("O1", "completed", "cancelled", False), ("O2", "pending", "completed", True)
    ]
    history = audit.table_history(bronze, "categories").orderBy("category_id", "valid_from").collect()
    assert [(r.category_id, r.category_name, r.is_current) for r in history] == [
        ("K1", "Toys", False), ("K1", "Games", True), ("K2", "Books", True)
    ]


def test_audit_compares_payments_of_unknown_orders(spark, raw, root):
    first_drop(raw)  # O9 has an item of 1 but no order head, O99 has neither
    raw(
        "payments", ONE,
        "payment_id,order_id,method,amount,status,paid_at\n"
        "Y1,O9,cod,1,pending,\nY2,O9,cod,2,pending,\nY3,O99,cod,5,pending,\nY4,O1,cod,41,pending,\nY5,,cod,5,pending,\n",
    )
    raw("loyalty_points", ONE, "loyalty_id,customer_id,order_id,points_earned,points_redeemed\nL1,C1,O99,7,0\n")
    ingest_all(spark, root, raw.dir)
    transform_all(spark, root)
    found = audit.warehouse_audit(spark, root).where(F.col("table_name").isin("payments", "loyalty_points")).collect()
    assert {(r.rule, r.record_key, r.detail) for r in found} == {
        ("amount_mismatch", "Y2", "1.0000"),
        ("amount_mismatch", "Y3", "0.0000"),
        ("orphan_reference", "L1", "O99"),
    }


def test_files_without_rows_are_passed(spark, raw, root):
    """A file of a header alone is a run without changes: the mark passes it, and it is not looked at again."""
    header = "category_id,category_name\n"
    raw_dir = raw("categories", ONE, header + "K1,a\n")
    silver, bronze = Silver(spark, root), Bronze(spark, root)
    bronze.ingest(raw_dir, "categories")
    assert silver.transform("categories") == ("categories", 1, 0)
    raw("categories", TWO, header)
    bronze.ingest(raw_dir, "categories")
    assert silver.transform("categories") == ("categories", 0, 0)
    assert silver.last_run("categories") == 1 and silver._last_mark("categories")[1] == 1
    assert silver.transform("categories") == ("categories", 0, 0) and silver.last_run("categories") == 1
    assert silver.changes("categories", 0).count() == 0 and silver.read("categories").count() == 1


def test_fact_follows_silver_whatever_was_loaded_first(spark, raw, root):
    """An item moves to another order: loaded before its old order came again, folded in after that."""
    first_drop(raw)
    ingest_all(spark, root, raw.dir)
    transform_all(spark, root)
    gold, bronze, silver = Gold(spark, root), Bronze(spark, root), Silver(spark, root)
    gold.build_dims()
    gold.build_fact()
    moved = gold.read("fact_sales").where("order_id = 'O1'").first().order_item_id
    items = "order_item_id,order_id,product_id,quantity,unit_price\n"
    raw("order_items", TWO, items + f"{moved},O2,P1,1,10\n")
    bronze.ingest(raw.dir, "order_items")
    raw("orders", TWO, "order_id,customer_id,store_id,order_date,payment_method,status\nO1,C1,S1,2026-07-08 10:00:00,cod,pending\n")
    bronze.ingest(raw.dir, "orders")
    silver.transform("orders")
    gold.build_fact()
    silver.transform("order_items")
    gold.build_fact()
    assert gold.read("fact_sales").where(F.col("order_item_id") == moved).first().order_id == "O2"


def test_only_rows_of_repeated_keys_are_ranked(spark, raw, root, monkeypatch):
    head = "order_id,customer_id,store_id,order_date,payment_method,status\n"
    raw("orders", ONE, head + "O1,C1,S1,2026-07-08,cod,pending\n O2,C1,S1,2026-07-08,cod,pending\n"
        "O3,C1,S1,2026-07-08,cod,pending\n\t,C1,S1,2026-07-08,cod,pending\n,C1,S1,2026-07-08,cod,pending\n")
    raw("orders", TWO, head + "O2 ,C2,S1,2026-07-08,cod,completed\n")
    ranked, before = [], silver.latest_by_key

    def latest(df, *args):
        ranked.append(sorted(r.order_id for r in df.select("order_id").collect()))
        return before(df, *args)

    monkeypatch.setattr(silver, "latest_by_key", latest)
    Bronze(spark, root).ingest(raw.dir, "orders")
    assert Silver(spark, root).transform("orders") == ("orders", 3, 2)
    assert ranked == [["O2", "O2"]]
    found = {(r.order_id, r.customer_id, r.status) for r in Silver(spark, root).read("orders").collect()}
    assert found == {("O1", "C1", "pending"), ("O2", "C2", "completed"), ("O3", "C1", "pending")}
    assert Silver(spark, root).rejects().count() == 2
    # With more repeated keys than are broadcast all rows are ranked.
    monkeypatch.setattr(silver, "REPEATED_KEYS", 0)
    assert Silver(spark, f"{root}-2").transform("orders") == ("orders", 0, 0)
    Bronze(spark, f"{root}-2").ingest(raw.dir, "orders")
    assert Silver(spark, f"{root}-2").transform("orders") == ("orders", 3, 2)
    assert len(ranked[1]) == 4
    assert {(r.order_id, r.customer_id, r.status) for r in Silver(spark, f"{root}-2").read("orders").collect()} == found


def test_sales_held_back_of_untouched_orders_are_not_joined_again(spark, raw, root, monkeypatch):
    first_drop(raw)
    head = "order_id,customer_id,store_id,order_date,payment_method,status\n"
    raw("orders", TWO, head + "O9,C7,S1,2026-07-08,cod,pending\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    raw("customers", TWO, "customer_id,name,email,phone,city,join_date,segment\nC7,Eve,,,Oslo,,Gold\n")
    joined, before = [], gold_plans.fact_sales

    def fact(items, orders):
        joined.append(items.count())
        return before(items, orders)

    monkeypatch.setattr(gold_plans, "fact_sales", fact)
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    assert joined == [0]
    sales = Gold(spark, root).read("fact_sales")
    assert {r.order_item_id for r in sales.collect()} == {"I1", "I2", "I3", "I4", "I6"}
    assert Gold(spark, root).held_back().count() == 0


def test_an_item_held_back_that_moves_to_another_order_is_there_once(spark, raw, root):
    first_drop(raw)
    head = "order_id,customer_id,store_id,order_date,payment_method,status\n"
    raw("orders", TWO, head + "O9,C7,S1,2026-07-08,cod,pending\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    raw("order_items", "20260709_000000", "order_item_id,order_id,product_id,quantity,unit_price\nI6,O1,P1,1,2\n")
    raw("customers", TWO, "customer_id,name,email,phone,city,join_date,segment\nC7,Eve,,,Oslo,,Gold\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    sales = {r.order_item_id: r.order_id for r in Gold(spark, root).read("fact_sales").collect()}
    assert Gold(spark, root).read("fact_sales").count() == len(sales) == 5
    assert sales["I6"] == "O1"


def test_sales_are_written_once(spark, raw, root):
    """A build moves what it joined to where it stays; with quarantine, the first one parts the sales as it writes them."""
    first_drop(raw)
    head = "order_id,customer_id,store_id,order_date,payment_method,status\n"
    raw("orders", TWO, head + "O9,C7,S1,2026-07-08,cod,pending\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    gold = Gold(spark, root)
    assert {r.order_item_id for r in gold.held_back().collect()} == {"I6"}
    assert gold.read("fact_sales").count() == 4 and gold.table("fact_sales").last_run() == 0
    assert gold.held_back().columns == gold.read("fact_sales").columns
    assert not any_match(spark, f"{root}/gold/fact_sales_staged/_held=*")
    raw("customers", TWO, "customer_id,name,email,phone,city,join_date,segment\nC7,Eve,,,Oslo,,Gold\n")
    medallion.run(spark, raw.dir, root)
    assert gold.read("fact_sales").count() == 5 and gold.held_back().count() == 0
    assert gold.table("fact_sales").last_run() == 1 and not any_match(spark, f"{root}/gold/fact_sales_staged")


def test_a_first_build_may_hold_back_all_sales_or_none(spark, raw, root):
    raw("order_items", ONE, "order_item_id,order_id,product_id,quantity,unit_price\nI1,O1,P1,1,10\n")
    raw("orders", ONE, "order_id,customer_id,store_id,order_date,payment_method,status\nO1,C1,S1,2026-07-08,cod,pending\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    gold = Gold(spark, root)
    assert gold.read("fact_sales").count() == 0 and [r.order_item_id for r in gold.held_back().collect()] == ["I1"]
    raw("customers", ONE, "customer_id,name\nC1,Ann\n")
    raw("stores", ONE, "store_id,store_name\nS1,One\n")
    raw("products", ONE, "product_id,product_name\nP1,Pen\n")
    medallion.run(spark, raw.dir, root, on_violation="quarantine")
    assert gold.read("fact_sales").count() == 1 and gold.held_back().count() == 0
    medallion.run(spark, raw.dir, f"{root}-2", on_violation="quarantine")
    gold = Gold(spark, f"{root}-2")
    assert gold.read("fact_sales").count() == 1 and gold.held_back().count() == 0


def test_first_sales_of_items_that_come_once_are_not_shuffled(spark, raw, root):
    spec, head = TABLES["order_items"], "order_item_id,order_id,product_id,quantity,unit_price\n"
    raw("order_items", ONE, head + "I1,O1,P1,1,10\nI2,O1,P1,1,11\n,O1,P1,1,12\n")
    bronze = Bronze(spark, root)
    bronze.ingest(raw.dir, "order_items")

    def prices():
        return {r.order_item_id: float(r.unit_price) for r in first().collect()}

    def first():
        return audit._first_dated(bronze.read("order_items"), spec)

    assert prices() == {"I1": 10, "I2": 11} and first().count() == 2
    assert "Exchange" not in first()._jdf.queryExecution().executedPlan().toString()
    raw("order_items", TWO, head + " I2,O1,P1,1,21\nI3,O1,P1,1,13\n")
    bronze.ingest(raw.dir, "order_items")
    assert prices() == {"I1": 10, "I2": 11, "I3": 13} and first().count() == 3
