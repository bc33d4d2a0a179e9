"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
links AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, k.y FROM reach r JOIN links k ON r.y = k.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d JOIN comp ON comp.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP9 = r"""
WITH parts AS (
  SELECT page_id, url,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules(rhost, rpath, rverdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM p LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit
"""

OP2 = """
WITH codes AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.bits, c.bits), lambda p: CASE WHEN p[1] <> p[2] THEN 1 ELSE 0 END)) AS INTEGER) AS distance
  FROM codes q JOIN codes c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id, distance FROM pairs)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""

OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND list_count(e) = len(e) AND list_bool_and(list_transform(e, lambda x: isfinite(x))) AND list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM v
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN comp ON comp.x = vec_id LEFT JOIN n ON n.x = vec_id
"""

ORACLES: dict[str, str] = {
    "op2_multi_index_hamming": OP2,
    "op3_tensored_minhash": OP3,
    "op9_bloom_cascade": OP9,
    "op10_cover_tree": OP10,
}
