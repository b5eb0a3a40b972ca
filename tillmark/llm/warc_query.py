"""Query of the web archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.registry import query, table
from tillmark.llm.warc import read_archive, write_archive
from tillmark.session import fresh_dir

# The last two columns are those of whole records, put together here as the archive's format says.
SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS payload_digest,
         CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages
), newest AS (SELECT body, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY body),
typed AS (
  SELECT *, response IS NOT NULL AND response <> page_id AS revisit,
         E'HTTP/1.1 200 OK\\r\\nContent-Type: text/html; charset=utf-8\\r\\nContent-Length: ' || payload_bytes || E'\\r\\n\\r\\n' AS http
  FROM p LEFT JOIN newest USING (body)
), built AS (
  SELECT *, E'WARC/1.1\\r\\nWARC-Type: ' || CASE WHEN revisit THEN 'revisit' ELSE 'response' END
    || E'\\r\\nWARC-Record-ID: <urn:x-page:' || page_id || E'>\\r\\nWARC-Date: 2024-01-01T00:00:00Z\\r\\n'
    || coalesce('WARC-Target-URI: ' || regexp_replace(url, '[\\x00-\\x1F\\x7F]', ' ', 'g') || E'\\r\\n', '')
    || 'WARC-Payload-Digest: sha1:' || payload_digest || E'\\r\\n'
    || CASE WHEN revisit THEN 'WARC-Refers-To: <urn:x-page:' || response || E'>\\r\\nWARC-Profile: '
       || E'http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\\r\\n' ELSE '' END
    || E'Content-Type: application/http; msgtype=response\\r\\nContent-Length: '
    || (strlen(http) + CASE WHEN revisit THEN 0 ELSE payload_bytes END) || E'\\r\\n\\r\\n'
    || http || CASE WHEN revisit THEN '' ELSE body END || E'\\r\\n\\r\\n' AS record
  FROM typed
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN response END AS refers_to, CAST(strlen(record) AS BIGINT) AS record_bytes,
       sha256(record) AS record_sha256
FROM built
"""


@query(SQL)
def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is rebuilt from header and payload; its length and digest are two more columns."""
    path = fresh_dir(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    rebuilt = [F.octet_length("record").cast("long").alias("record_bytes"), F.sha2("record", 256).alias("record_sha256")]
    return read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *rebuilt
    )
