"""Query of the Merkle manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.merkle import verify
from tillmark.llm.registry import query, table

# Ranks, nodes of all levels and their siblings by windows; crc32 and the folds by reduction over lists.
SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, text,
         concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id::varchar, '-'),
                coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'),
                coalesce(strlen(n_chars::varchar) || ':' || n_chars::varchar, '-')) AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
         xor(list_reduce(
           list_prepend(4294967295::bigint,
             list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii((doc_id::varchar)[i])::bigint)),
           lambda c, b: list_reduce(
             list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
             lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::bigint) ELSE a >> 1 END)
         ), 4294967295::bigint) AS crc
  FROM documents
), hashed AS (
  SELECT doc_id, lang, sha256(concat(head, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
         CASE WHEN crc % 3 = 0 THEN sha256(concat(head, coalesce(strlen(lowered) || ':' || lowered, '-'))) END AS changed
  FROM fields
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS id
  FROM hashed
), tree AS (
  SELECT lang, 0 AS lev, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT lang, lev + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
  FROM tree WHERE n > 1 GROUP BY lang, lev, pos // 8, n
), subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS lev, pos, digest, n FROM subroots
  UNION ALL
  SELECT lev + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
  FROM top WHERE n > 1 GROUP BY lev, pos // 8, n
), steps AS (
  SELECT lang, lev, pos, n,
         coalesce(string_agg(digest, '') OVER before_it, '') AS l, coalesce(string_agg(digest, '') OVER after_it, '') AS r
  FROM tree
  WINDOW before_it AS (PARTITION BY lang, lev, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after_it AS (PARTITION BY lang, lev, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
), top_steps AS (
  SELECT lev, pos, n,
         coalesce(string_agg(digest, '') OVER before_it, '') AS l, coalesce(string_agg(digest, '') OVER after_it, '') AS r
  FROM top
  WINDOW before_it AS (PARTITION BY lev, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after_it AS (PARTITION BY lev, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
), proofs AS (
  SELECT x.id, s.lev AS k, s.l, s.r
  FROM leaves x JOIN steps s ON s.lang IS NOT DISTINCT FROM x.lang AND s.n > 1 AND s.pos = x.pos // (8 ** s.lev)::bigint
  UNION ALL
  SELECT x.id, 100 + s.lev, s.l, s.r
  FROM leaves x JOIN subroots u ON u.lang IS NOT DISTINCT FROM x.lang
  JOIN top_steps s ON s.n > 1 AND s.pos = u.pos // (8 ** s.lev)::bigint
), whole AS (
  SELECT id, sha256(string_agg(l || r, '' ORDER BY k)) AS proof, list({'l': l, 'r': r} ORDER BY k) AS path
  FROM proofs GROUP BY id
), folds AS (
  SELECT x.id, coalesce(x.changed, x.leaf) AS acc, w.path, 1 AS k FROM leaves x LEFT JOIN whole w USING (id)
  UNION ALL
  SELECT id, sha256(concat(path[k].l, acc, path[k].r)), path, k + 1 FROM folds WHERE k <= coalesce(len(path), 0)
)
SELECT x.doc_id, x.leaf, u.digest AS subroot, t.digest AS root, coalesce(w.proof, sha256('')) AS proof_sha256,
       f.acc AS folded_root, f.acc = t.digest AS verified
FROM leaves x
JOIN subroots u ON u.lang IS NOT DISTINCT FROM x.lang
JOIN (SELECT digest FROM top WHERE n = 1) t ON true
LEFT JOIN whole w USING (id)
JOIN folds f ON f.id = x.id AND f.k = coalesce(len(f.path), 0) + 1
"""


def tampered():
    """The rows whose tampering has to be found: those where 3 divides the crc32 of the decimal doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


@query(SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(table(spark, sf_dir, "documents"), tampered())
