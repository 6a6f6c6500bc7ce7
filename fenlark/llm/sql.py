"""SQL of training-data queries that SQL can express, for DuckDB."""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda z: z <> '') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id, r.doc_id = min(r.c) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
