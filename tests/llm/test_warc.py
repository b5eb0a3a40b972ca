"""Archives: exact round trip, revisits, and the query against SQL."""

import hashlib

import check_oracle
import pytest
from pyspark.sql import functions as F

from tillmark.llm import decontaminate_query, warc_query  # noqa: F401 - registers the queries
from tillmark.llm.registry import ORACLE, QUERIES
from tillmark.llm.warc import read_archive, write_archive

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("name", ["op2_warc_archive", "op7_decontamination"])
def test_against_sql(spark, name):
    ok, note = check_oracle.compare_frames(QUERIES[name](spark, SF), check_oracle.connect(SF), ORACLE[name])
    assert ok, note


def test_round_trip(spark, tmp_path):
    big, small = "é" * 600, "é" * 400
    rows = [(1, "u1", big), (5, "u5", big), (3, None, big), (2, "u2", small), (4, "u\r\nX: y", small), (6, "u6", None)]
    rows += [(7, "u7", "x" * 1000), (7, "u7", "x" * 1000), (None, "n", "y"), (8, "u8", "z" * 3_000_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"digest": F.lit("clash"), "payload": F.lit(1)})
    write_archive(pages, f"{tmp_path}/a")
    got = read_archive(spark, f"{tmp_path}/a").collect()
    by = {(r.page_id, r.url): r for r in got}
    assert len(got) == len(rows)
    for page_id, url, html in rows:
        r = by[page_id, url and url.replace("\r", " ").replace("\n", " ")]
        body = (html or "").encode()
        assert r.payload == body and r.payload_bytes == len(body)
        assert r.payload_digest == hashlib.sha1(body).hexdigest()
        revisit = page_id in (1, 3)
        assert (r.record_type, r.refers_to) == (("revisit", 5) if revisit else ("response", None))
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        block, end = rest[:length], rest[length:]
        assert end == b"\r\n\r\n" and block.startswith(b"HTTP/1.1 200 OK\r\n")
        assert block.partition(b"\r\n\r\n")[2] == (b"" if revisit else body)
    assert spark.read.parquet(f"{tmp_path}/a/payloads").count() == len({(h or "") for _, _, h in rows})


def test_empty_archive(spark, tmp_path):
    write_archive(spark.createDataFrame([], PAGES), f"{tmp_path}/a")
    assert read_archive(spark, f"{tmp_path}/a").count() == 0


def test_damage_is_found(spark, tmp_path):
    write_archive(spark.createDataFrame([(1, "u", "abc")], PAGES), f"{tmp_path}/a")
    damaged = spark.read.parquet(f"{tmp_path}/a/payloads").select("digest", F.lit(b"abd").alias("payload")).collect()
    spark.createDataFrame(damaged, "digest string, payload binary").write.mode("overwrite").parquet(f"{tmp_path}/a/payloads")
    with pytest.raises(Exception, match="damaged"):
        read_archive(spark, f"{tmp_path}/a").collect()
