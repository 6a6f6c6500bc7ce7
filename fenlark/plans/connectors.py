"""Readers and writers put to work: what is written comes back, and a store of records keeps its promises."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.scratch import folder, written
from ..sources import files, sinks
from ..store import Store
from ..streaming import windows
from .base import query, read


@query("SELECT p_partkey, p_name, p_brand, p_type FROM part")
def json_round_trip(spark, sf_dir):
    """A catalogue exported as JSON with sorted keys and read again under a strict schema."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    path = folder(spark)
    sinks.export_json(part, path)
    return files.json_records(spark, path, StructType(part.schema.fields), multi_line=False)


@query("""SELECT event_type, count(*) AS n, CAST(sum(CASE WHEN part = 'old' THEN 1 ELSE 0 END) AS BIGINT) AS old FROM (SELECT event_type, CASE WHEN event_type = 'error' THEN 'new' ELSE 'old' END AS part FROM events UNION ALL SELECT event_type, 'old' FROM events WHERE event_id % 2 = 0 AND event_type <> 'error') GROUP BY 1""")
def append_and_replace(spark, sf_dir):
    """Rows appended twice, then one partition replaced: the others stay."""
    e = read(spark, sf_dir, "events").select("event_id", "event_type")
    path = folder(spark)
    sinks.append(e.withColumn("part", F.lit("old")), path, ("event_type",))
    sinks.append(e.where("event_id % 2 = 0").withColumn("part", F.lit("old")), path, ("event_type",))
    sinks.replace_partitions(e.where("event_type = 'error'").withColumn("part", F.lit("new")), path, ("event_type",))
    back = spark.read.schema("event_id long, part string, event_type string").parquet(path)
    return back.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("part") == "old").alias("old"))


@query("SELECT concat('page', page_id, '.md') AS name, CAST(strlen(coalesce(html, '')) + 1 AS BIGINT) AS bytes, CAST(len(string_split(coalesce(html, ''), chr(10))) + 1 AS INTEGER) AS lines FROM pages WHERE page_id % 5 <> 0")
def file_scan(spark, sf_dir):
    """Pages written as files and found again by pattern, drafts left out, read whole."""
    name = F.concat_ws("", F.when(F.col("page_id") % 5 != 0, "page").otherwise("draft_"), F.col("page_id").cast("string"), F.lit(".md"))
    folders = sinks.text_files(read(spark, sf_dir, "pages").select(name.alias("name"), F.col("html").alias("text")), folder(spark))
    name = F.regexp_extract("path", r"/(?:name=)?([^/=]+\.md)(?:/[^/]+)?$", 1)
    told = lambda found: found.select(name.alias("name"), F.octet_length("text").cast("long").alias("bytes"), F.size(F.split("text", "\n")).alias("lines"))
    return files.scanned(spark, folders, told, "*.{md,txt}", r"/(name=)?draft_[^/]*")


@query("""WITH o AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS run_id, CAST(o_orderkey AS VARCHAR) AS example_id, CASE WHEN o_orderkey % 3 = 0 THEN 'VERIFIED' WHEN o_orderkey % 3 = 1 THEN 'COMPILE_FAILED' ELSE 'DISCOVERED' END AS status FROM orders)
SELECT run_id, CASE WHEN status = 'DISCOVERED' THEN 'NEEDS_REVIEW' ELSE status END AS status, count(*) AS n FROM o WHERE run_id <> '7' GROUP BY 1, 2""")
def store_round_trip(spark, sf_dir):
    """Run states written to a store, written again with new states, updated and cut: what a reader finds at last."""
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).cast("string").alias("run_id"), k.cast("string").alias("example_id"), (k % 3).alias("k"))
    store = Store(spark, folder(spark))
    store.write("example_run_state", o.select("run_id", "example_id", F.lit("DISCOVERED").alias("status")))
    store.write("example_run_state", o.where("k <> 2").select("run_id", "example_id", F.when(F.col("k") == 0, "VERIFIED").otherwise("COMPILE_FAILED").alias("status")))
    store.update("example_run_state", F.col("status") == "DISCOVERED", status="NEEDS_REVIEW")
    store.delete("example_run_state", F.col("run_id") == "7")
    return store.count_by("example_run_state", "run_id", "status")


@query("SELECT s.start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL '1 hour', ts), time_bucket(INTERVAL '1 hour', ts) - INTERVAL '1 hour']) AS start FROM events) s GROUP BY 1, 2")
def sliding_counts(spark, sf_dir):
    """Windows of two hours, one an hour."""
    return windows.sliding(read(spark, sf_dir, "events"), "2 hours", "1 hour").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '2 hours' THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def session_counts(spark, sf_dir):
    """Sessions that end with a gap of two hours."""
    return windows.sessions(read(spark, sf_dir, "events"), "2 hours").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT count(DISTINCT (user_id, event_type)) AS n FROM events")
def first_events(spark, sf_dir):
    """Each kind of event of a user once, as a stream within its watermark would keep it."""
    e = read(spark, sf_dir, "events").withColumn("key", F.concat_ws(":", F.col("user_id").cast("string"), "event_type"))
    return windows.distinct_events(e, "key").agg(F.count("*").alias("n"))


@query("SELECT lower(regexp_extract(url, '\\.([^./]+)$', 1)) AS extension, count(*) AS files, CAST(sum(coalesce(strlen(html), 0)) AS BIGINT) AS bytes FROM pages GROUP BY 1")
def page_inventory(spark, sf_dir):
    """What kinds of pages there are, and their bytes."""
    p = read(spark, sf_dir, "pages")
    return p.groupBy(F.lower(F.regexp_extract("url", r"\.([^./]+)$", 1)).alias("extension")).agg(F.count("*").alias("files"), F.sum(F.coalesce(F.octet_length("html"), F.lit(0))).cast("long").alias("bytes"))


@query("SELECT n_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def written_twice_read(spark, sf_dir):
    """A table written once to the shared folder and read by two branches."""
    c = written(read(spark, sf_dir, "customer").select("c_nationkey"))
    n = c.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    names = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name").join(c, "c_nationkey", "left_semi")
    return names.join(n, "c_nationkey").select("n_name", "n")
