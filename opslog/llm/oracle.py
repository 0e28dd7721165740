"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

#: All 50-byte strings of all texts, as hex; the parts only keep the cutting cheap.
SUBSTRING_DEDUP = """
WITH body AS (SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (
  SELECT doc_id, p, substr(h, (2 * p + 1)::BIGINT, 1098) AS h
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49, 500)) AS p FROM body WHERE length(h) >= 100)),
win AS (
  SELECT doc_id, p + i AS i, substr(h, (2 * i + 1)::BIGINT, 100) AS s
  FROM (SELECT doc_id, p, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM part)),
low AS (SELECT s, min(doc_id) AS least FROM win GROUP BY s),
hit AS (SELECT doc_id, i FROM win JOIN low USING (s) WHERE doc_id > least),
mark AS (SELECT doc_id, i, i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 AS far FROM hit),
run AS (
  SELECT doc_id, i, sum(CASE WHEN far IS NULL OR far THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i) AS k FROM mark),
gone AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY doc_id, k),
edge AS (
  SELECT doc_id, k, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 0) AS prev FROM gone),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last_b,
    string_agg(substr(h, (2 * prev + 1)::BIGINT, (2 * (a - prev))::BIGINT), '' ORDER BY k) AS head
  FROM edge JOIN body USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, (2 * coalesce(last_b, 0) + 1)::BIGINT))) AS kept_sha256
FROM body LEFT JOIN kept USING (doc_id)"""

#: Every pair of every label, and the pairs that chains of links reach.
EMBEDDING_NEAR_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
  vec_id <= coalesce(low.b, vec_id) AS kept
FROM embeddings LEFT JOIN low ON low.a = vec_id LEFT JOIN deg ON deg.a = vec_id"""
