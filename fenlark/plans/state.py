"""Stateful and set-like operations: transitions, cascades, queues, copies, promotion, streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import blocks
from ..operators import tabular as t
from ..operators.scratch import folder
from ..store import Store
from ..streaming import windows
from .base import query, read


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderpriority, o_orderdate, o_orderkey LIMIT 1")
def queue_next(spark, sf_dir):
    return read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").orderBy("o_orderpriority", "o_orderdate", "o_orderkey").limit(1).select("o_orderkey", "o_orderpriority")


@query("""
SELECT c_custkey, coalesce(s_name, n_name, 'none') AS resolved, CASE WHEN s_name IS NOT NULL THEN 'exact' WHEN n_name IS NOT NULL THEN 'family' ELSE 'missing' END AS tier
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey AND s_acctbal > 0 LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 3
""")
def cascade_resolve(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    n = read(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = read(spark, sf_dir, "customer").join(s, "c_custkey", "left").join(n, "c_nationkey", "left")
    return j.select("c_custkey", F.coalesce("s_name", "n_name", F.lit("none")).alias("resolved"), F.when(F.col("s_name").isNotNull(), "exact").when(F.col("n_name").isNotNull(), "family").otherwise("missing").alias("tier"))


@query(r"""
WITH l AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]')[1:5], lambda z: regexp_replace(z, '^\s+|\s+$', '', 'g') <> '') AS h FROM documents),
d AS (SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\r\n', chr(10), 'g')) AS signature,
 CASE WHEN len(h) > 0 THEN list_transform(h, lambda z: regexp_replace(lower(regexp_replace(z, '^\s+|\s+$', '', 'g')), ';+$', '')) END AS head FROM l),
s AS (SELECT signature, count(*) AS n FROM d GROUP BY 1), t AS (SELECT head, count(*) AS n FROM d GROUP BY 1),
r AS (SELECT doc_id, coalesce(s.n, t.n, 0) AS n FROM d LEFT JOIN s ON s.signature = d.signature LEFT JOIN t ON t.head = d.head)
SELECT doc_id, CASE WHEN n = 0 THEN 'missing' WHEN n = 1 THEN 'unique' WHEN n <= 3 THEN 'ambiguous' ELSE 'rejected' END AS resolution FROM r
""")
def block_resolution(spark, sf_dir):
    """Whole texts are compared first, the first five lines only where no whole text matches; a null text is missing."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.col("n")
    return blocks.resolve(d, d, "doc_id", "text").select("doc_id", F.when(n == 0, "missing").when(n == 1, "unique").when(n <= 3, "ambiguous").otherwise("rejected").alias("resolution"))


@query("""
SELECT p_name, count(DISTINCT p_brand) AS families, min(p_partkey) AS keeper, count(*) - 1 AS retired FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) >= 2
""")
def global_promotion(spark, sf_dir):
    return read(spark, sf_dir, "part").groupBy("p_name").agg(F.countDistinct("p_brand").alias("families"), F.min("p_partkey").alias("keeper"), (F.count("*") - 1).alias("retired")).where("families >= 2")


@query("SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_brand <> b.p_brand AND a.p_partkey < b.p_partkey")
def conflict_pairs(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_brand")
    q = p.select(F.col("p_partkey").alias("b"), "p_name", "p_type", "p_size", F.col("p_brand").alias("other"))
    return p.withColumnRenamed("p_partkey", "a").join(q, ["p_name", "p_type", "p_size"]).where("p_brand <> other and a < b").select("a", "b")


_OLD, _NEW = "o_orderkey % 3 < 2", "o_orderkey % 3 > 0"


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN 'old' ELSE 'new' END AS origin FROM orders")
def copy_insert_ignore(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    part = lambda where, name: o.where(where).select("o_orderkey", F.lit(name).alias("origin"))
    return t.insert_ignore(part(_OLD, "old"), part(_NEW, "new"), ["o_orderkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 'new' ELSE 'old' END AS origin, o_orderdate AS created_at FROM orders")
def upsert_latest(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    old = o.where(_OLD).select("o_orderkey", F.lit("old").alias("origin"), F.col("o_orderdate").alias("created_at"))
    new = o.where(_NEW).select("o_orderkey", F.lit("new").alias("origin"), F.when(F.col("o_orderkey") % 3 == 2, F.col("o_orderdate")).alias("created_at"))
    return t.upsert(old, new, ["o_orderkey"], keep=["created_at"])


@query("SELECT conv_id, bool_and(length(text) > 10) AS passed, bool_or(role = 'user') AS asked, count(DISTINCT role) AS roles FROM conversations GROUP BY 1")
def consensus_vote(spark, sf_dir):
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.bool_and(F.length("text") > 10).alias("passed"), F.bool_or(F.col("role") == "user").alias("asked"), F.countDistinct("role").alias("roles"))


@query("""
SELECT user_id, island, count(*) AS n FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM events)
WHERE event_type = 'error' GROUP BY 1, 2 HAVING count(*) >= 2
""")
def consecutive_failures(spark, sf_dir):
    """Failures in a row share the number of other calls before them."""
    e = read(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    other = ~F.col("event_type").eqNullSafe("error")
    e = t.running_count(e, "user_id", ["ts", "event_id"], other, "island")
    return e.where("event_type = 'error'").groupBy("user_id", "island").agg(F.count("*").alias("n")).where("n >= 2")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_counts(spark, sf_dir):
    """The streaming windows of fenlark.streaming over a batch."""
    return windows.tumbling(read(spark, sf_dir, "events"), "1 hour").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("SELECT event_type, count(*) FILTER (WHERE event_id % 2 = 0) AS n, count(*) FILTER (WHERE event_id % 2 = 1) AS later FROM events GROUP BY 1")
def pattern_snapshot(spark, sf_dir):
    """What a reader pinned to a version sees after two more writes (n), and what the last version holds (later): rows
    with even ids, then all upserted, then the even ones deleted."""
    e = read(spark, sf_dir, "events").select(F.col("event_id").alias("signature_id"), "event_type")
    store = Store(spark, folder(spark))
    store.write("semantic_signature", e.where("signature_id % 2 = 0"))
    pinned = store.versions("semantic_signatures")[-1]
    store.write("semantic_signature", e.withColumn("event_type", F.when(F.col("signature_id") % 2 == 0, "changed").otherwise(F.col("event_type"))))
    store.delete("semantic_signatures", F.col("signature_id") % 2 == 0)
    both = store.table("semantic_signatures", pinned).select("event_type", F.lit(1).alias("n"), F.lit(0).alias("later")).unionByName(store.table("semantic_signatures").select("event_type", F.lit(0).alias("n"), F.lit(1).alias("later")))
    return both.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("later").alias("later"))
