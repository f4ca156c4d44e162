"""DuckDB SQL for the operators that SQL can express, by plain definition."""

from __future__ import annotations

#: Groups of equal or linked rows: everything reachable, then the smallest id.
_REACH = """
reach AS (
  SELECT id, id AS root FROM points
  UNION
  SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id),
groups AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)"""

MINHASH = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, unnest(list_distinct(if(len(w) < 5, [array_to_string(w, ' ')],
    list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))) AS s
  FROM texts WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
points AS (SELECT doc_id AS id FROM documents),{_REACH}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept
FROM groups LEFT JOIN sizes ON sizes.doc_id = id"""

EMBED_DEDUP = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
points AS (SELECT vec_id AS id FROM embeddings),{_REACH}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept
FROM groups"""

ORACLES: dict[str, str] = {"op2_minhash": MINHASH, "op3_embed_dedup": EMBED_DEDUP}
