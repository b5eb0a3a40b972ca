"""Drops written from the given tables, then loaded: source, bronze, stream and whole-run queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.filenames import batch_ts
from tillmark.plans import medallion
from tillmark.plans.audit import table_history
from tillmark.plans.bronze import Bronze, ingest_all, totals
from tillmark.plans.gold import Gold
from tillmark.plans.silver import Silver, clean, current_rows, transform_all
from tillmark.session import STORED, fresh_dir
from tillmark.sources.csv_drops import list_drops
from tillmark.specs import CORE, TABLES
from tillmark.streaming.ingest import ingest_available
from tillmark.streaming.transform import fold, transform_available
from tillmark.workload import roles
from tillmark.workload.cleaning import with_comma
from tillmark.workload.registry import query
from tillmark.workload.roles import FACT, read, with_ctes
from tillmark.workload.star import V_STORE

# The stamps of the drops.
FIRST, SECOND, THIRD = "20260708_132510", "20260708_141106", "20260708_150000"
CUT = "1998-07-01"


def drop(df: DataFrame, raw_dir: str, table: str, stamp: str) -> None:
    """Write one drop: a folder of CSV part files, compressed one by one, named like a raw file."""
    df.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip"
    ).csv(f"{raw_dir}/{table}/{table}_{stamp}.csv")


def early(column: str) -> Column:
    return F.col(column) < F.lit(CUT).cast("timestamp_ntz")


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    return roles.orders(spark, sf).select(*TABLES["orders"].names)


def raw_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items with decimal-comma prices, and their ship date to split drops by."""
    return read(spark, sf, "lineitem").select(
        roles.item_id().alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        with_comma("l_extendedprice").alias("unit_price"),
        "l_shipdate",
    )


def drop_orders(spark: SparkSession, sf: str, raw_dir: str) -> None:
    rows = raw_orders(spark, sf)
    drop(rows.where(early("order_date")), raw_dir, "orders", FIRST)
    drop(rows.where(~early("order_date")), raw_dir, "orders", SECOND)


def drop_core(spark: SparkSession, sf: str, raw_dir: str) -> None:
    """First drop of all core tables; orders and items up to the cut."""
    names = {"categories": roles.categories, "stores": roles.stores, "products": roles.products,
             "customers": roles.customers}
    for table, build in names.items():
        drop(build(spark, sf).select(*TABLES[table].names), raw_dir, table, FIRST)
    drop(raw_orders(spark, sf).where(early("order_date")), raw_dir, "orders", FIRST)
    drop(raw_items(spark, sf).where(early("l_shipdate")).drop("l_shipdate"), raw_dir, "order_items", FIRST)


def drop_core_again(spark: SparkSession, sf: str, raw_dir: str) -> None:
    """Second drop: the later orders and items."""
    drop(raw_orders(spark, sf).where(~early("order_date")), raw_dir, "orders", SECOND)
    drop(raw_items(spark, sf).where(~early("l_shipdate")).drop("l_shipdate"), raw_dir, "order_items", SECOND)


def raw_and_root(spark: SparkSession) -> tuple[str, str]:
    base = fresh_dir(spark, "drops")
    return f"{base}/raw", f"{base}/warehouse"


STAMPS = """CASE WHEN o_orderdate < TIMESTAMP '1998-07-01' THEN '2026-07-08 13:25:10' ELSE '2026-07-08 14:11:06' END"""
ORDERS_TEXT = """SELECT order_id, customer_id, store_id, strftime(order_date, '%Y-%m-%dT%H:%M:%S.000') AS order_date,
       payment_method, status, CASE WHEN order_date < TIMESTAMP '1998-07-01' THEN '2026-07-08 13:25:10'
       ELSE '2026-07-08 14:11:06' END AS batch_ts FROM retail_orders"""


def bronze_orders(spark: SparkSession, root: str) -> DataFrame:
    rows = Bronze(spark, root).read("orders")
    return rows.select(*TABLES["orders"].names, F.col("_batch_ts").alias("batch_ts"))


@query(with_ctes("retail_orders") + ORDERS_TEXT)
def bronze_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops of orders, loaded in one run: all columns as text, with the time from the file name."""
    raw_dir, root = raw_and_root(spark)
    drop_orders(spark, sf, raw_dir)
    Bronze(spark, root).ingest(raw_dir, "orders")
    return bronze_orders(spark, root)


@query(with_ctes("retail_orders") + ORDERS_TEXT)
def stream_ingest_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """The same by stream: three starts, of which the second finds nothing new."""
    raw_dir, root = raw_and_root(spark)
    rows = raw_orders(spark, sf)
    drop(rows.where(early("order_date")), raw_dir, "orders", FIRST)
    ingest_available(spark, raw_dir, root, "orders")
    ingest_available(spark, raw_dir, root, "orders")
    drop(rows.where(~early("order_date")), raw_dir, "orders", SECOND)
    ingest_available(spark, raw_dir, root, "orders")
    return bronze_orders(spark, root)


@query(
    """SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-07-01' THEN 'first' ELSE 'third' END AS run, count(*) AS rows_loaded
  FROM orders GROUP BY 1 UNION ALL SELECT 'second', CAST(0 AS BIGINT) FROM (SELECT count(*) FROM orders)"""
)
def bronze_rerun_skips(spark: SparkSession, sf: str) -> DataFrame:
    """Run, run again without new files, run after one more drop: rows loaded by each run."""
    raw_dir, root = raw_and_root(spark)
    bronze, rows = Bronze(spark, root), raw_orders(spark, sf)
    drop(rows.where(early("order_date")), raw_dir, "orders", FIRST)
    first = bronze.ingest(raw_dir, "orders")
    second = bronze.ingest(raw_dir, "orders")
    drop(rows.where(~early("order_date")), raw_dir, "orders", SECOND)
    third = bronze.ingest(raw_dir, "orders")
    runs = [("first", first.rows_loaded), ("second", second.rows_loaded), ("third", third.rows_loaded)]
    return spark.createDataFrame(runs, "run string, rows_loaded bigint")


@query(
    f"""SELECT 'orders' AS table_name, {STAMPS} AS batch_ts, count(*) AS row_count, CAST(0 AS BIGINT) AS batches_off
  FROM orders GROUP BY 2"""
)
def load_log(spark: SparkSession, sf: str) -> DataFrame:
    """Logged rows per drop, next to how far they are from the rows bronze holds."""
    raw_dir, root = raw_and_root(spark)
    drop_orders(spark, sf, raw_dir)
    bronze = Bronze(spark, root)
    bronze.ingest(raw_dir, "orders")
    logged = bronze.load_log("orders").groupBy(
        "table_name", batch_ts(F.col("file_path"), "orders").alias("batch_ts")
    ).agg(F.sum("row_count").alias("row_count"))
    held = bronze.read("orders").groupBy(F.col("_batch_ts").alias("batch_ts")).agg(F.count(F.lit(1)).alias("held"))
    return logged.join(held, "batch_ts").select(
        "table_name", "batch_ts", "row_count", (F.col("row_count") - F.col("held")).alias("batches_off")
    )


@query(
    f"""SELECT 'orders' AS kind, strftime(ts, '%Y%m%d') AS day, count(*) AS events, true AS is_new
  FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 2"""
)
def new_files_only(spark: SparkSession, sf: str) -> DataFrame:
    """Listing minus load log: one file per day of events, those of the first half already logged."""
    listing = read(spark, sf, "events").groupBy(
        F.concat(F.lit("orders_"), F.date_format("ts", "yyyyMMdd"), F.lit("_000000.csv")).alias("file_path")
    ).agg(F.count(F.lit(1)).alias("events"))
    logged = (
        read(spark, sf, "events")
        .where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
        .select(F.concat(F.lit("orders_"), F.date_format("ts", "yyyyMMdd"), F.lit("_000000.csv")).alias("file_path"))
        .distinct()
    )
    new = listing.join(logged, "file_path", "left_anti")
    return new.select(
        F.lit("orders").alias("kind"),
        F.substring("file_path", 8, 8).alias("day"),
        "events",
        batch_ts(F.col("file_path"), "orders").isNotNull().alias("is_new"),
    )


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
  '  ' || c_name || ' "' || c_mktsegment || '", NA' AS name, '' AS email, 'NA' AS city, '' AS segment FROM customer"""
)
def raw_text_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes, commas, padding and 'NA' come through as written; missing values are blank."""
    raw_dir, root = raw_and_root(spark)
    rows = read(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("  "), "c_name", F.lit(' "'), "c_mktsegment", F.lit('", NA')).alias("name"),
        F.lit(None).cast("string").alias("email"),
        F.lit("NA").alias("city"),
        F.lit("").alias("segment"),
    )
    drop(rows, raw_dir, "customers", FIRST)
    bronze = Bronze(spark, root)
    bronze.ingest(raw_dir, "customers")
    return bronze.read("customers").select("customer_id", "name", "email", "city", "segment")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
  CASE WHEN c_acctbal < 0 THEN '' ELSE 'NATION_' || CAST(c_nationkey AS VARCHAR) END AS city, '' AS phone,
  CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS segment FROM customer"""
)
def schema_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """One drop with reordered and surplus columns, one with few columns: bound by name, gaps blank."""
    raw_dir, root = raw_and_root(spark)
    rows = read(spark, sf, "customer")
    reordered = rows.where("c_acctbal >= 0").select(
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.concat(F.lit("NATION_"), "c_nationkey").alias("city"),
        F.col("c_name").alias("name"),
        F.col("c_custkey").alias("customer_id"),
    )
    short = rows.where("c_acctbal < 0").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("customer_id")
    )
    drop(reordered, raw_dir, "customers", FIRST)
    drop(short, raw_dir, "customers", SECOND)
    bronze = Bronze(spark, root)
    bronze.ingest(raw_dir, "customers")
    return bronze.read("customers").select("customer_id", "name", "city", "phone", "segment")


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS review_id, md5(text) AS text_digest, source AS customer_id FROM documents"
)
def multiline_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Review texts with line breaks and quotes inside a field stay one record."""
    raw_dir, root = raw_and_root(spark)
    rows = read(spark, sf, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("source").alias("customer_id"), F.col("text").alias("review_text")
    )
    drop(rows, raw_dir, "product_reviews", FIRST)
    bronze = Bronze(spark, root)
    bronze.ingest(raw_dir, "product_reviews")
    return bronze.read("product_reviews").select("review_id", "customer_id", F.md5("review_text").alias("text_digest"))


COUNTS = """SELECT 'categories' AS t, count(DISTINCT p_brand) AS n FROM part
UNION ALL SELECT 'stores', count(*) FROM supplier UNION ALL SELECT 'products', count(*) FROM part
UNION ALL SELECT 'customers', count(*) FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'order_items', count(*) FROM lineitem
UNION ALL SELECT 'suppliers', CAST(0 AS BIGINT) FROM (SELECT count(*) FROM region)"""


@query(
    f"""WITH c AS ({COUNTS}) SELECT t AS table_name, n AS rows_loaded, n > 0 AS has_files FROM c
  UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT), true FROM c"""
)
def ingest_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows loaded per table and in total; a table without drops counts zero."""
    raw_dir, root = raw_and_root(spark)
    drop_core(spark, sf, raw_dir)
    drop_core_again(spark, sf, raw_dir)
    stats = ingest_all(spark, root, raw_dir, (*CORE, "suppliers"))
    total = totals(stats).select(F.lit("total").alias("table"), "files_loaded", "rows_loaded")
    return stats.unionByName(total).select(
        F.col("table").alias("table_name"), "rows_loaded", (F.col("files_loaded") > 0).alias("has_files")
    )


@query(
    f"""WITH c AS ({COUNTS}) SELECT 'first' AS run, t AS table_name, n AS rows_upserted,
  CASE WHEN t = 'orders' THEN (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') ELSE 0 END AS rows_rejected
  FROM c UNION ALL SELECT 'second', t, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM c"""
)
def transform_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows upserted and rejected per table by a run and by its repetition; urgent orders come once without a key."""
    raw_dir, root = raw_and_root(spark)
    drop_core(spark, sf, raw_dir)
    drop_core_again(spark, sf, raw_dir)
    keyless = raw_orders(spark, sf).where("payment_method = '1-URGENT'").withColumn("order_id", F.lit("\t\u00a0"))
    drop(keyless, raw_dir, "orders", THIRD)
    tables = (*CORE, "suppliers")
    ingest_all(spark, root, raw_dir, tables)
    first = transform_all(spark, root, tables).withColumn("run", F.lit("first"))
    second = transform_all(spark, root, tables).withColumn("run", F.lit("second"))
    return first.unionByName(second).withColumnRenamed("table", "table_name")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS VARCHAR) AS order_date,
  CASE WHEN o_orderdate < TIMESTAMP '1998-07-01' OR o_orderstatus = 'F' THEN 'cancelled'
       WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'completed' END AS status FROM orders"""
)
def silver_rerun_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Orders loaded in one run, the early ones again as cancelled in the next: silver holds the last state."""
    raw_dir, root = raw_and_root(spark)
    bronze, silver, rows = Bronze(spark, root), Silver(spark, root), raw_orders(spark, sf)
    drop(rows, raw_dir, "orders", FIRST)
    bronze.ingest(raw_dir, "orders")
    silver.transform("orders")
    drop(rows.where(early("order_date")).withColumn("status", F.lit("cancelled")), raw_dir, "orders", SECOND)
    bronze.ingest(raw_dir, "orders")
    silver.transform("orders")
    return silver.read("orders").select("order_id", "order_date", "status")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS VARCHAR) AS order_date,
  CASE WHEN o_orderdate < TIMESTAMP '1998-07-01' OR o_orderstatus = 'F' THEN 'cancelled'
       WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'completed' END AS status, CAST(3 AS BIGINT) AS runs FROM orders"""
)
def silver_by_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same by streams over the load log: three drops, each folded in by a start of its own, and micro-batches
    replayed after each, which add no run."""
    raw_dir, root = raw_and_root(spark)
    bronze, silver, rows = Bronze(spark, root), Silver(spark, root), raw_orders(spark, sf)
    late = rows.where(~early("order_date"))
    drops = [rows.where(early("order_date")), late, rows.where(early("order_date")).withColumn("status", F.lit("cancelled"))]
    for stamp, df in zip((FIRST, SECOND, THIRD), drops):
        drop(df, raw_dir, "orders", stamp)
        bronze.ingest(raw_dir, "orders")
        transform_available(spark, root, "orders")
        fold(bronze.load_log("orders"), root, "orders")
    return silver.read("orders").select(
        "order_id", "order_date", "status", F.lit(silver.last_run("orders") + 1).cast("bigint").alias("runs")
    )


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name,
  'NATION_' || CAST(s_nationkey AS VARCHAR) AS city FROM supplier"""
)
def silver_cut_off(spark: SparkSession, sf: str) -> DataFrame:
    """A silver run is cut off before its mark, gold is built, another drop arrives: no row is lost."""
    raw_dir, root = raw_and_root(spark)
    bronze, silver, gold = Bronze(spark, root), Silver(spark, root), Gold(spark, root)
    rows = roles.stores(spark, sf).select(*TABLES["stores"].names)
    rich = rows.join(
        read(spark, sf, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").cast("string").alias("store_id")),
        "store_id",
        "left_semi",
    )
    drop(rich, raw_dir, "stores", FIRST)
    bronze.ingest(raw_dir, "stores")
    # What a run leaves that ended between its changes and its mark.
    silver.table("stores").merge(current_rows(clean(bronze.read("stores"), TABLES["stores"]), TABLES["stores"]), 0)
    gold.build_dims()
    drop(rows.join(rich, "store_id", "left_anti"), raw_dir, "stores", SECOND)
    bronze.ingest(raw_dir, "stores")
    silver.transform("stores")
    gold.build_dims()
    return gold.read("dim_store").select("store_id", "store_name", "city")


BATCHES = (1, 2, 100)


@query(
    f"""SELECT b.unnest AS files_per_batch, CAST(c_custkey AS VARCHAR) AS customer_id, 'S' || s.unnest AS segment,
  s.unnest = 3 AS is_current, false AS empty FROM customer, unnest([{", ".join(map(str, BATCHES))}]) AS b,
  unnest([1, 2, 3]) AS s"""
)
def history_by_batch_size(spark: SparkSession, sf: str) -> DataFrame:
    """Three drops of all customers loaded in batches of one, two and many files: the same history each time."""
    parts = []
    for size in BATCHES:
        raw_dir, root = raw_and_root(spark)
        for number in (1, 2, 3):
            rows = roles.customers(spark, sf).withColumn("segment", F.lit(f"S{number}"))
            drop(rows.select(*TABLES["customers"].names), raw_dir, "customers", f"2026070{number}_000000")
        bronze = Bronze(spark, root)
        bronze.load_listing(list_drops(spark, raw_dir, "customers"), "customers", size)
        history = table_history(bronze.read, "customers")
        parts.append(
            history.select(
                F.lit(size).alias("files_per_batch"),
                "customer_id",
                "segment",
                "is_current",
                F.coalesce(F.col("valid_from") >= F.col("valid_to"), F.lit(False)).alias("empty"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(V_STORE)
def raw_to_views(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run over two rounds of drops, from CSV to revenue by store."""
    raw_dir, root = raw_and_root(spark)
    drop_core(spark, sf, raw_dir)
    # Items may precede their order, and orders their items: each joins when the other arrives.
    medallion.run(spark, raw_dir, root, calendar=roles.CALENDAR)
    drop_core_again(spark, sf, raw_dir)
    _, _, views = medallion.run(spark, raw_dir, root, calendar=roles.CALENDAR)
    return views["vw_revenue_by_store"]


def late_stores(spark: SparkSession, sf: str) -> tuple[str, str, Gold]:
    """All core tables loaded but the stores with a negative balance: (warehouse, where their drop waits, gold)."""
    raw_dir, root = raw_and_root(spark)
    drop_core(spark, sf, raw_dir)
    drop_core_again(spark, sf, raw_dir)
    # Read the drop of stores as written, and let only part of them reach the dimension at first.
    known = read(spark, sf, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").cast("string").alias("store_id"))
    late_raw = f"{raw_dir}-late"
    stores = roles.stores(spark, sf).select(*TABLES["stores"].names)
    drop(stores.join(known, "store_id", "left_semi"), late_raw, "stores", FIRST)
    drop(stores.join(known, "store_id", "left_anti"), late_raw, "stores", SECOND)

    ingest_all(spark, root, raw_dir, tuple(t for t in CORE if t != "stores"))
    Bronze(spark, root).load_listing(
        spark.read.format("binaryFile").load(f"{late_raw}/stores/stores_{FIRST}.csv").select(
            "path", F.col("_metadata.file_path").alias("file_path")
        ),
        "stores",
    )
    return root, late_raw, Gold(spark, root, roles.CALENDAR)


@query(
    with_ctes(*FACT)
    + """, w AS (SELECT *, store_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal >= 0) AS held
  FROM fact_sales)
SELECT order_item_id, held, store_id FROM w"""
)
def raw_to_fact_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Stores with a negative balance arrive late: their sales are held back, and let in by the next run."""
    root, late_raw, gold = late_stores(spark, sf)

    def build() -> DataFrame:
        transform_all(spark, root, CORE)
        gold.build_dims()
        gold.build_fact("quarantine")
        return gold.read("fact_sales").select("order_item_id", "store_id")

    # The first state is written out, the second build replaces what it was read from.
    build().write.options(**STORED).parquet(f"{root}/first_state")
    before = spark.read.parquet(f"{root}/first_state").select("order_item_id", F.lit(False).alias("_held"))
    ingest_all(spark, root, late_raw, ("stores",))
    after = build()
    return after.join(before, "order_item_id", "left").select(
        "order_item_id", "store_id", F.col("_held").isNull().alias("held")
    )


@query(
    with_ctes(*FACT)
    + """, w AS (SELECT count(*) AS n, CAST(count_if(store_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier
  WHERE s_acctbal >= 0)) AS BIGINT) AS held FROM fact_sales)
SELECT 'quarantine' AS run, n - held AS fact_rows, held AS held_rows, true AS wrote FROM w
UNION ALL SELECT 'fail', n, 0, true FROM w UNION ALL SELECT 'idle', n, 0, false FROM w"""
)
def raw_to_fact_policies(spark: SparkSession, sf: str) -> DataFrame:
    """The same under a change of policy: held back by one run, let in by the next that fails on broken references,
    which leaves nothing held back; a third run finds nothing to do."""
    root, late_raw, gold = late_stores(spark, sf)
    table, runs, states = gold.table("fact_sales"), -1, []
    for run, policy in (("quarantine", "quarantine"), ("fail", "fail"), ("idle", "fail")):
        if run == "fail":
            ingest_all(spark, root, late_raw, ("stores",))
        transform_all(spark, root, CORE)
        gold.build_dims()
        gold.build_fact(policy)
        states.append((run, gold.read("fact_sales").count(), gold.held_back().count(), table.last_run() > runs))
        runs = table.last_run()
    return spark.createDataFrame(states, "run string, fact_rows bigint, held_rows bigint, wrote boolean")
