"""Content-addressed archives of web records.

An archive is a folder of two tables. `payloads` holds each distinct payload once, under its SHA-256, which is checked
when it is written and when it is read. `records` holds the exact header bytes of every record and the digest of its
payload. Joining both by digest gives the original records back, byte for byte. All of it is DataFrame code; payload
bytes are shuffled once, when copies are folded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.registry import written
from tillmark.session import fresh_dir

# Payloads below this are archived as responses of their own, whatever their copies.
LEAST_REVISIT = 1000
CAPTURED = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none if the value is null. Control characters cannot break out of it."""
    clean = F.regexp_replace(value, r"[\x00-\x1F\x7F]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _described(pages: DataFrame, id_column: str, url: str, body: str) -> DataFrame:
    payload = F.coalesce(F.col(f"`{body}`"), F.lit("")).cast("binary")
    return pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload, 256).alias("digest"),
        F.sha1(payload).alias("sha1"),
    )


def write_archive(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url: str = "url",
    body: str = "html",
    captured: str = CAPTURED,
    least: int = LEAST_REVISIT,
) -> None:
    """Archive one record per row.

    Of rows with equal payloads of at least `least` bytes, that with the largest page_id is the response and the others
    revisit it; smaller ones are all responses. A null body is an empty payload, a null url has no header line, and a
    null page_id is archived as `none`. Repeated rows are records of their own; rows that share the largest page_id are
    responses alike. An empty table gives an empty archive. Other columns are not archived.
    """
    # Bodies are read and hashed once; what follows starts from this table.
    scratch = fresh_dir(pages.sparkSession, "archive-rows")
    rows = written(_described(pages, id_column, url, body), scratch, compression="zstd")
    folded = rows.groupBy("digest").agg(
        F.any_value("payload").alias("payload"),
        F.min("size").alias("_least"),
        F.max("size").alias("_most"),
        F.min("sha1").alias("_first"),
        F.max("sha1").alias("_last"),
    )
    # Equal strong digests must mean equal payloads: their lengths and second digests have to agree.
    agree = (F.col("_least") == F.col("_most")) & (F.col("_first") == F.col("_last"))
    checked = F.when(agree, F.col("payload")).otherwise(F.raise_error(F.lit("two payloads share a digest")))
    folded.select("digest", checked.cast("binary").alias("payload")).write.option("compression", "zstd").parquet(
        f"{path}/payloads"
    )
    heads = rows.drop("payload")
    newest = (
        heads.where(F.col("size") >= least).groupBy(F.col("digest")).agg(F.max("page_id").alias("_response"))
    )
    typed = heads.join(newest, "digest", "left").withColumn(
        "_revisit",
        F.col("_response").isNotNull() & ~F.col("_response").eqNullSafe(F.col("page_id")),
    )
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.octet_length(http) + F.when(F.col("_revisit"), 0).otherwise(F.col("size"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(F.col("_revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(captured)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(F.col("_revisit"), _record_id(F.col("_response")))),
        _line("WARC-Profile", F.when(F.col("_revisit"), REVISIT_PROFILE)),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
    )
    typed.select("digest", header.cast("binary").alias("header"), http.cast("binary").alias("http_header")).write.option(
        "compression", "zstd"
    ).parquet(f"{path}/records")


def _field(name: str) -> Column:
    """The value of a header line; null if there is none."""
    text = F.col("header").cast("string")
    found = F.regexp_extract(text, rf"(?:^|\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:x-page:(-?\d+)>$", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive, their fields parsed from the header bytes and their payloads found by digest.

    Columns: page_id, url, record_type, refers_to, payload_bytes, payload_digest (SHA-1 of the full payload), header,
    http_header, payload, and record, the bytes of the whole record. A payload whose SHA-256 isn't its digest, or whose
    SHA-1 isn't the one in the header, is an error, as is a record whose block isn't as long as its header says.
    """
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.lit("a payload is damaged")).cast("binary")
    )
    payloads = payloads.select("digest", sound.alias("payload"))
    payloads = payloads.select(
        "digest",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    records = spark.read.schema("digest string, header binary, http_header binary").parquet(f"{path}/records")
    page_id, refers_to = _page_of(_field("WARC-Record-ID")), _page_of(_field("WARC-Refers-To"))
    records = records.select(
        "digest",
        F.when(page_id != "", page_id).cast("long").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        F.when(refers_to != "", refers_to).cast("long").alias("refers_to"),
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("_named"),
        _field("Content-Length").cast("long").alias("_length"),
        "header",
        "http_header",
    )
    own = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    same = F.when(F.col("_named") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a header names another payload")).cast("string")
    )
    block = F.concat("http_header", own)
    complete = F.when(F.octet_length(block) == F.col("_length"), block).otherwise(
        F.raise_error(F.lit("a record is not as long as its header says")).cast("binary")
    )
    return records.join(payloads, "digest").select(
        "page_id",
        "url",
        "record_type",
        "refers_to",
        "payload_bytes",
        same.alias("payload_digest"),
        "header",
        "http_header",
        "payload",
        F.concat("header", complete, F.lit(b"\r\n\r\n")).alias("record"),
    )
