"""DuckDB SQL of the contracts that SQL can express, by brute force.

Independent of the operators: words and shingles by regular expression, all
pairs that share a shingle, all pairs of vectors, and a recursive reach for the
components.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN comp c ON d.doc_id = c.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

NEAR_VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION
  SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a),
comp AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT c.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM comp c LEFT JOIN n ON n.vec_id = c.vec_id"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS size, array_to_string(ws[p:p + least(13, len(ws)) - 1], ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 12))) AS p FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, p, size, array_to_string(ws[p:p + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, ws, size, unnest(generate_series(1, len(ws) - size + 1)) AS p
        FROM d JOIN (SELECT DISTINCT size FROM iw) ON len(ws) >= size)),
hits AS (SELECT doc_id, p, dw.size, item_id FROM dw JOIN iw ON dw.size = iw.size AND dw.phrase = iw.phrase),
places AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(p, p + size - 1)) AS place FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN places ON places.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id"""
