"""DuckDB SQL for the results that SQL can express."""

from __future__ import annotations


def _base32(digest: str) -> str:
    """Base32 of 40 hex digits: five digits are 20 bits, four characters."""
    parts = []
    for k in range(8):
        bits = f"('0x' || substr({digest}, {5 * k + 1}, 5))::INTEGER"
        parts += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({bits} >> {s}) & 31) + 1, 1)"
                  for s in (15, 10, 5, 0)]
    return " || ".join(parts)


WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS h,
             max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, {_base32('h')} AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM d"""

EGO = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
finite AS (
  SELECT vec_id, e, CASE WHEN len(e) > 0 AND list_count(e) = len(e)
                         THEN sqrt(list_dot_product(e, e)) END AS n FROM v),
good AS (SELECT * FROM finite WHERE n > 0 AND isfinite(n)),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT r.a AS vec_id, (SELECT count(*) FROM links l WHERE l.a = r.a) AS n_links,
       min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r GROUP BY r.a"""

ORACLE_SQL = {"op4_warc": WARC, "op6_ego": EGO}
