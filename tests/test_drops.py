"""How the drops of the workload are written."""

from pyspark.sql import functions as F

from tillmark.plans.bronze import Bronze
from tillmark.workload.audit import written_twice
from tillmark.workload.ingest import drop


def test_copies_of_a_row_share_a_part_file(spark, tmp_path):
    rows = spark.range(100).repartition(5).select("id", F.when(F.col("id") < 90, F.col("id") % 2).alias("odd"))
    written_twice(rows, F.col("odd") == 1).write.csv(f"{tmp_path}/drop")
    found = spark.read.schema("id long, odd long").csv(f"{tmp_path}/drop").select("id", F.col("_metadata.file_path").alias("f"))
    copies = found.groupBy("id").agg(F.count("f").alias("n"), F.count_distinct("f").alias("files")).collect()
    assert {r.id: (r.n, r.files) for r in copies} == {i: (2 if i < 90 and i % 2 else 1, 1) for i in range(100)}
    # Every task writes its own share.
    assert found.select("f").distinct().count() == 5


def test_drops_are_compressed(spark, tmp_path):
    drop(spark.range(20).selectExpr("id AS order_id", "'a, \"b\"' AS status"), str(tmp_path), "orders", "20260708_132510")
    parts = list(tmp_path.glob("orders/orders_20260708_132510.csv/part-*"))
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    bronze = Bronze(spark, str(tmp_path / "warehouse"))
    assert bronze.ingest(str(tmp_path), "orders").rows_loaded == 20
    assert {(r.status, str(r._batch_ts)) for r in bronze.read("orders").collect()} == {('a, "b"', "2026-07-08 13:25:10")}
