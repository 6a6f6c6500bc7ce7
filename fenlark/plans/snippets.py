"""Extraction, policy filters, catalog look-ups and signature comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tabular as t
from .base import query, read


@query(r"""
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<p>')) AS paragraphs FROM pages
""")
def marker_pairs(spark, sf_dir):
    """Text between an opening and a closing marker, and how often a marker stands."""
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit("<p>"), F.lit(0))).cast("long").alias("paragraphs"))


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem JOIN (SELECT p_partkey FROM part WHERE lower(p_type) = 'economy') p ON l_partkey = p_partkey WHERE l_returnflag = 'R'
""")
def case_insensitive_lookup(spark, sf_dir):
    p = read(spark, sf_dir, "part").where(F.lower("p_type") == "economy").select(F.col("p_partkey").alias("l_partkey"))
    return read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").join(p, "l_partkey", "left_semi").select("l_orderkey", "l_linenumber")


@query("SELECT label, least(1.0, 0.8 * (label % 2) + least(0.5, 0.1 * count(*))) AS drift FROM embeddings GROUP BY 1")
def drift_weights(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").groupBy("label").agg(F.count("*").alias("n")).select("label", F.least(F.lit(1.0), 0.8 * (F.col("label") % 2) + F.least(F.lit(0.5), 0.1 * F.col("n"))).alias("drift"))


@query("SELECT doc_id, regexp_replace(lower(text), '[ \\t\\n\\r]+', '', 'g') = regexp_replace(lower(regexp_replace(text, ' ', '  ', 'g')), '[ \\t\\n\\r]+', '', 'g') AS same FROM documents")
def identity_ignoring_space(spark, sf_dir):
    bare = lambda c: F.regexp_replace(F.lower(c), "[ \t\n\r]+", "")
    c = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", (bare(c) == bare(F.replace(c, F.lit(" "), F.lit("  ")))).alias("same"))


@query("""
SELECT n_name, r_name, coalesce(s.n, 0) AS suppliers FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey
""")
def family_hierarchy(spark, sf_dir):
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    s = read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return n.join(r, "n_regionkey").join(s, "n_nationkey", "left").select("n_name", "r_name", F.coalesce("n", F.lit(0)).alias("suppliers"))


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'error' THEN 0 ELSE 1 END, value DESC, event_id) <= 3")
def progressive_enrichment(spark, sf_dir):
    first = F.when(F.col("event_type") == "error", 0).otherwise(1)
    return t.newest(read(spark, sf_dir, "events"), ["user_id"], [first, F.desc("value"), F.col("event_id")], 3).select("user_id", "event_id")
