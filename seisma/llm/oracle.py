"""DuckDB SQL for the training-data queries that SQL can express, stated by brute force."""

from __future__ import annotations

_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
needle AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, list_aggregate(w[i : i + least(len(w), 10) - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
hay AS (
  SELECT doc_id, k, i, list_aggregate(w[i : i + k - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM needle) WHERE len(w) >= k)),
found AS (SELECT doc_id, item_id, i, k FROM hay JOIN needle USING (k, phrase)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
gram AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM doc),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
overlap AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM overlap JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, edge.y FROM reach JOIN edge ON reach.other = edge.x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN size USING (doc_id)
"""

ORACLE = {"op3_decontaminate": DECONTAMINATE, "op9_ngram_join": NGRAM_JOIN}
