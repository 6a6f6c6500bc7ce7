"""Document dataflow, duplicates, similarity, signatures and rewriting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as x
from ..operators import blocks, fuzzy, rewrite, tabular
from ..operators.nearest import nearest
from ..operators.scratch import written
from .base import query, read


_TRIM = "trim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))"


@query(f"SELECT doc_id, sha256(replace({_TRIM}, concat(chr(13), chr(10)), chr(10))) AS signature FROM documents")
def content_signature(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", x.signature(F.col("text")).alias("signature"))


@query(r"SELECT page_id, substr(sha256(lower(replace(concat_ws(':', coalesce(url, ''), CAST(page_id AS VARCHAR)), '\', '/'))), 1, 16) AS key FROM pages")
def example_key(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", x.example_key(F.col("url"), F.col("page_id")).alias("key"))


@query(f"""
WITH s AS (SELECT doc_id, sha256({_TRIM}) AS h FROM documents)
SELECT doc_id, h AS signature, n FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM s) WHERE n >= 2
""")
def exact_duplicates(spark, sf_dir):
    """Texts are hashed once; counts are aggregated before they are joined back, so that a hot signature is not one window partition."""
    s = written(read(spark, sf_dir, "documents").select("doc_id", F.unhex(F.sha2(x.stripped(F.col("text")), 256)).alias("h")))
    n = s.groupBy("h").agg(F.count("*").alias("n")).where("n >= 2")
    return s.join(n, "h").select("doc_id", F.lower(F.hex("h")).alias("signature"), "n")


_LINES = r"SELECT doc_id, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '\s+', ' ', 'g'), ' ') AS line FROM documents"


def _overlap_sql(least: float) -> str:
    return f"""
WITH l AS (SELECT DISTINCT doc_id, line FROM ({_LINES}) WHERE length(line) >= 20), s AS (SELECT doc_id, count(*) AS n FROM l GROUP BY 1)
SELECT p.a, p.b, p.common, round(p.common / CAST(greatest(1, least(x.n, y.n)) AS DOUBLE), 6) AS ratio
FROM (SELECT l1.doc_id AS a, l2.doc_id AS b, count(*) AS common FROM l l1 JOIN l l2 ON l1.line = l2.line AND l1.doc_id < l2.doc_id GROUP BY 1, 2) p
JOIN s x ON x.doc_id = p.a JOIN s y ON y.doc_id = p.b WHERE p.common / CAST(greatest(1, least(x.n, y.n)) AS DOUBLE) >= {least}
"""


def _prose(spark, sf_dir):
    rows = blocks.lines(read(spark, sf_dir, "documents"), "doc_id", F.col("text"))
    return rows.select("doc_id", F.trim(F.regexp_replace(F.lower("line"), r"\s+", " ")).alias("line")).where("length(line) >= 20")


@query(_overlap_sql(0.5))
def prose_overlap(spark, sf_dir):
    return blocks.overlap(_prose(spark, sf_dir), "doc_id", "line", 0.5)


@query(_overlap_sql(0.6))
def block_overlap(spark, sf_dir):
    return blocks.overlap(_prose(spark, sf_dir), "doc_id", "line", 0.6)


@query("""
SELECT doc_id, list_sort(list(DISTINCT marker)) AS markers FROM documents JOIN (VALUES ('MIT'), ('Apache'), ('GNU'), ('token = ')) m(marker) ON contains(text, marker) GROUP BY 1
""")
def foreign_markers(spark, sf_dir):
    markers = F.array(*(F.lit(m) for m in ("MIT", "Apache", "GNU", "token = ")))
    found = F.array_sort(F.filter(markers, lambda m: F.contains(F.col("text"), m)))
    return read(spark, sf_dir, "documents").select("doc_id", found.alias("markers")).where(F.size("markers") > 0)


@query(r"""
WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '[A-Z][a-z]+')) AS s FROM documents), p AS (SELECT a.doc_id, a.s AS before, b.s AS after FROM w a JOIN w b ON b.doc_id = a.doc_id + 1)
SELECT doc_id, list_sort(list_filter(after, lambda z: NOT list_contains(before, z))) AS added, list_sort(list_filter(before, lambda z: NOT list_contains(after, z))) AS removed FROM p
""")
def set_difference(spark, sf_dir):
    """Capitalised words that the next document adds and drops; ids are joined, never paired."""
    w = read(spark, sf_dir, "documents").select("doc_id", F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Z][a-z]+"), F.lit(0))).alias("s"))
    j = w.withColumnRenamed("s", "before").join(w.select((F.col("doc_id") - 1).alias("doc_id"), F.col("s").alias("after")), "doc_id")
    added, removed = x.set_changes(F.col("before"), F.col("after"))
    return j.select("doc_id", added.alias("added"), removed.alias("removed"))


@query("""
WITH q AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings WHERE vec_id % 100 = 0 AND embedding IS NOT NULL),
s AS (SELECT query_id, vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]), 6) AS similarity FROM embeddings, q WHERE vec_id <> query_id AND embedding IS NOT NULL)
SELECT query_id, vec_id, label, similarity FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, label, vec_id) <= 10
""")
def knn_topk(spark, sf_dir):
    """Every row whose id is divisible by 100 against all others."""
    return nearest(read(spark, sf_dir, "embeddings"), 100, 10)


@query("""
WITH c AS (SELECT a.vec_id, greatest(0.0, least(1.0, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]))) AS s FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
SELECT vec_id, round(1 - s, 6) AS drift, 1 - s < 0.9 AS admitted FROM c
""")
def drift_score(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    j = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("after")), "vec_id")
    s = x.cosine(F.col("embedding"), F.col("after"))
    return j.select("vec_id", F.round(1 - s, 6).alias("drift"), (1 - s < 0.9).alias("admitted"))


@query("""
WITH c AS (SELECT a.label, b.vec_id IS NULL AS alone, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1),
d AS (SELECT label, alone, 1 - CASE WHEN c IS NULL OR isnan(c) THEN 0.0 ELSE greatest(0.0, least(1.0, c)) END AS drift FROM c)
SELECT label, CASE WHEN label % 3 = 0 THEN 'fixed_examples' ELSE 'original_examples' END AS collection, count(*) AS n FROM d WHERE alone OR drift < 0.9 GROUP BY 1, 2
""")
def vector_admission(spark, sf_dir):
    """Vectors whose drift to the next one is under the threshold of drift_score; one without a next has no drift and is admitted."""
    e = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("after"), F.lit(True).alias("paired"))
    drift = 1 - x.cosine(F.col("embedding"), F.col("after"))
    e = e.join(after, "vec_id", "left").where(F.col("paired").isNull() | (drift < 0.9))
    return e.groupBy("label", F.when(F.col("label") % 3 == 0, "fixed_examples").otherwise("original_examples").alias("collection")).agg(F.count("*").alias("n"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '([A-Z])[a-z]+ing\b')) AS applied, regexp_replace(text, '([A-Z])[a-z]+ing\b', '\1~', 'g') AS new FROM documents")
def rewrite_regex(spark, sf_dir):
    """A learned replacement: the new text and how often it applied."""
    pattern = r"([A-Z])[a-z]+ing\b"
    return read(spark, sf_dir, "documents").select("doc_id", F.regexp_count("text", F.lit(pattern)).cast("long").alias("applied"), rewrite.regex_replace(F.col("text"), pattern, r"\1~").alias("new"))


@query("""SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages""")
def marker_extraction(spark, sf_dir):
    """The links of a page, in order."""
    return read(spark, sf_dir, "pages").select("page_id", F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)).alias("links"))


@query("""
SELECT p_type, list_sort(list(DISTINCT p_brand)) AS brands, min(p_partkey) AS first FROM part GROUP BY 1
""")
def mine_using_patterns(spark, sf_dir):
    return read(spark, sf_dir, "part").groupBy("p_type").agg(F.sort_array(F.collect_set("p_brand")).alias("brands"), F.min("p_partkey").alias("first"))


# the longest block of a word that a name holds, its first place in the word, and its first place in the name
_BLOCK = "list_filter(flatten(list_transform(range(length(x), 0, -1), lambda k: list_transform(range(1, length(x) - k + 2), lambda i: [k, i, position(substr(x, i, k) IN y)]))), lambda t: t[3] > 0)[1]"


@query(f"""WITH RECURSIVE w AS (SELECT DISTINCT p_brand AS word FROM part WHERE p_brand IS NOT NULL), n AS (SELECT DISTINCT replace(p_brand, 'Brand', 'Brnad') AS name FROM part WHERE p_brand IS NOT NULL),
r(word, name, x, y) AS (SELECT word, name, word, name FROM w, n UNION ALL SELECT word, name, c[1], c[2] FROM (SELECT word, name, unnest([[substr(x, 1, t[2] - 1), substr(y, 1, t[3] - 1)], [substr(x, t[2] + t[1]), substr(y, t[3] + t[1])]]) AS c
 FROM (SELECT word, name, x, y, {_BLOCK} AS t FROM r WHERE x <> '' AND y <> '') WHERE t IS NOT NULL)),
s AS (SELECT word, name, 2.0 * sum(coalesce({_BLOCK}[1], 0)) / (length(word) + length(name)) AS score FROM r GROUP BY 1, 2), m AS (SELECT name, max([score::VARCHAR, word]) AS best FROM s WHERE score >= 0.7 GROUP BY 1)
SELECT p_partkey, replace(p_brand, 'Brand', 'Brnad') AS name, best[2] AS match FROM part LEFT JOIN m ON m.name = replace(p_brand, 'Brand', 'Brnad')""")
def fuzzy_match(spark, sf_dir):
    """The brand most alike by matching blocks, for misspelt names."""
    bad = read(spark, sf_dir, "part").select("p_partkey", F.regexp_replace("p_brand", "Brand", "Brnad").alias("name"))
    found = fuzzy.closest(bad.select("name"), read(spark, sf_dir, "part").select(F.col("p_brand").alias("name")), 0.7)
    return bad.join(found.select("name", F.col("word").alias("match")), "name", "left").select("p_partkey", "name", "match")


@query("SELECT user_id, event_id, kind, ref FROM (SELECT user_id, event_id, unnest(['event_type', 'props']) AS kind, unnest([event_type, props]) AS ref FROM events) WHERE ref IS NOT NULL AND ref <> ''")
def artifact_unpivot(spark, sf_dir):
    return tabular.unpivot_refs(read(spark, sf_dir, "events"), ["user_id", "event_id"], ["event_type", "props"])
