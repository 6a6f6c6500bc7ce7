"""Aggregations, joins, windows and top-k over the run-like tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tabular as t
from .base import query, read


@query("""
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users,
       round(100.0 * count(CASE WHEN value > 50 THEN 1 END) / count(*), 2) AS high_pct
FROM events GROUP BY event_type
""")
def failure_breakdown(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), t.rate(F.count_if(F.col("value") > 50), F.count("*")).alias("high_pct"))


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("""
SELECT o_custkey % 100 AS run, CAST(sum(CASE WHEN o_orderstatus IN ('F','P') THEN 1 ELSE 0 END) AS BIGINT) AS verified,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS failed, count(*) AS total
FROM orders GROUP BY 1
""")
def run_stats(spark, sf_dir):
    s = F.col("o_orderstatus")
    return read(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 100).alias("run")).agg(F.count_if(s.isin("F", "P")).alias("verified"), F.count_if(s == "O").alias("failed"), F.count("*").alias("total"))


@query("""
WITH v AS (SELECT count(*) AS verified FROM orders WHERE o_orderstatus = 'F'),
e AS (SELECT count(*) FILTER (event_type = 'error') AS infra, count(*) FILTER (event_type IN ('click','view')) AS errors FROM events)
SELECT verified, infra, errors, CASE WHEN verified + errors > 0 THEN round(100.0 * verified / (verified + errors), 2) ELSE 0.0 END AS rate FROM v, e
""")
def runtime_kpis(spark, sf_dir):
    v = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").agg(F.count("*").alias("verified"))
    k = F.col("event_type")
    e = read(spark, sf_dir, "events").agg(F.count_if(k == "error").alias("infra"), F.count_if(k.isin("click", "view")).alias("errors"))
    both = v.crossJoin(F.broadcast(e))  # one row each
    return both.withColumn("rate", t.rate(F.col("verified"), F.col("verified") + F.col("errors")))


@query("""
SELECT user_id % 20 AS family, greatest(count(*) FILTER (event_type = 'error'), count(*) FILTER (value > 30)) AS worst,
       CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (value <= 30) / count(*), 2) ELSE 0.0 END AS rate,
       count(*) FILTER (value <= 30) * 100 >= 90 * count(*) AS gate
FROM events GROUP BY 1
""")
def phase2_metrics(spark, sf_dir):
    low, n = F.count_if(F.col("value") <= 30), F.count("*")
    return read(spark, sf_dir, "events").groupBy((F.col("user_id") % 20).alias("family")).agg(F.greatest(F.count_if(F.col("event_type") == "error"), F.count_if(F.col("value") > 30)).alias("worst"), t.rate(low, n).alias("rate"), (low * 100 >= n * 90).alias("gate"))


@query("""
SELECT event_type, user_id % 10 AS code, count(*) AS n, round(100.0 * count(*) FILTER (value > 20) / count(*), 2) AS fix_rate_pct
FROM events GROUP BY 1, 2 ORDER BY n DESC, event_type, code LIMIT 10
""")
def top_error_types(spark, sf_dir):
    g = read(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 10).alias("code"))
    return g.agg(F.count("*").alias("n"), t.rate(F.count_if(F.col("value") > 20), F.count("*")).alias("fix_rate_pct")).orderBy(F.desc("n"), "event_type", "code").limit(10)


@query("""
SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, count(*) FILTER (value > 10) AS resolved,
       round(100.0 * count(*) FILTER (value > 10) / count(*), 2) AS rate FROM events GROUP BY 1, 2
""")
def resolution_rates(spark, sf_dir):
    done = F.count_if(F.col("value") > 10)
    return read(spark, sf_dir, "events").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type").agg(F.count("*").alias("n"), done.alias("resolved"), t.rate(done, F.count("*")).alias("rate"))


@query("SELECT event_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM events GROUP BY 1")
def percent_of_total(spark, sf_dir):
    return t.share_of_total(read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")), "n")


@query("""
SELECT o_orderstatus AS status, count(*) AS n,
       array_to_string(list_sort(list(DISTINCT o_orderpriority))[1:3], ',') AS examples FROM orders GROUP BY 1
""")
def status_string_agg(spark, sf_dir):
    some = F.array_join(F.slice(F.sort_array(F.collect_set("o_orderpriority")), 1, 3), ",")
    return read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), some.alias("examples"))


@query("""
SELECT user_id, event_type, count(*) AS cnt, least(0.9, 0.3 + 0.1 * count(*)) AS confidence
FROM events GROUP BY 1, 2 HAVING count(*) >= 3 ORDER BY cnt DESC, user_id, event_type LIMIT 5
""")
def having_topk(spark, sf_dir):
    g = read(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("cnt")).where("cnt >= 3")
    return g.withColumn("confidence", F.least(F.lit(0.9), 0.3 + 0.1 * F.col("cnt"))).orderBy(F.desc("cnt"), "user_id", "event_type").limit(5)


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def last_attempt_per_key(spark, sf_dir):
    return t.newest(read(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 5")
def newest_n_runs(spark, sf_dir):
    return t.newest(read(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")], 5).select("o_custkey", "o_orderkey")


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, ts DESC, event_id) = 1")
def best_duplicate(spark, sf_dir):
    return t.newest(read(spark, sf_dir, "events"), ["user_id", "event_type"], [F.desc("value"), F.desc("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id")


@query("""
SELECT e.event_id, s.event_id AS last_signup FROM events e ASOF LEFT JOIN
(SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup') s ON e.user_id = s.user_id AND e.ts >= s.ts
""")
def asof_last_event(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    s = e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("last_signup"))
    return t.as_of(e.select("event_id", "user_id", "ts"), s, "user_id", "ts", "at", ["last_signup"]).select("event_id", "last_signup")


@query("""
WITH r AS (SELECT event_id AS run, user_id, ts AS started, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ended FROM events WHERE event_type = 'signup')
SELECT r.run, count(e.event_id) AS n, round(avg(e.value), 6) AS mean FROM r JOIN events e ON e.user_id = r.user_id AND e.ts >= r.started AND (r.ended IS NULL OR e.ts < r.ended) GROUP BY 1
""")
def next_run_window(spark, sf_dir):
    """A run lasts until the next one of its user starts; rows are assigned by an as-of pass, not by a range join."""
    e = read(spark, sf_dir, "events")
    s = e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("run"))
    return t.as_of(e.select("user_id", "ts", "value"), s, "user_id", "ts", "at", ["run"]).where("run is not null").groupBy("run").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("SELECT count(*) AS attempts, count(*) FILTER (l_returnflag = 'R') AS failed FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')")
def attempts_semi(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).select(F.col("o_orderkey").alias("l_orderkey"))
    return read(spark, sf_dir, "lineitem").join(o, "l_orderkey", "left_semi").agg(F.count("*").alias("attempts"), F.count_if(F.col("l_returnflag") == "R").alias("failed"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def never_seen_anti(spark, sf_dir):
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT c_custkey, coalesce(n, 0) AS applied, coalesce(s, 0.0) AS spent FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def left_coalesce(spark, sf_dir):
    p = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("s"))
    return read(spark, sf_dir, "customer").join(p, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("applied"), F.coalesce("s", F.lit(0.0)).alias("spent"))


@query("""
WITH a AS (SELECT user_id AS id, max(event_type) AS s, max(value) AS d FROM events WHERE event_id % 2 = 0 GROUP BY 1),
b AS (SELECT user_id AS id, max(event_type) AS s, max(value) AS d FROM events WHERE event_id % 2 = 1 GROUP BY 1)
SELECT coalesce(a.id, b.id) AS id, coalesce(a.s, 'UNKNOWN') AS before, coalesce(b.s, 'UNKNOWN') AS after,
       (a.s IS NOT DISTINCT FROM b.s) AS same, coalesce(abs(a.d - b.d) <= 0.5, a.d IS NULL AND b.d IS NULL) AS close
FROM a FULL JOIN b ON a.id = b.id
""")
def full_outer_compare(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    half = lambda k: e.where(F.col("event_id") % 2 == k).groupBy(F.col("user_id").alias("id")).agg(F.max("event_type").alias(f"s{k}"), F.max("value").alias(f"d{k}"))
    both = half(0).join(half(1), "id", "full_outer")
    close = F.coalesce(F.abs(F.col("d0") - F.col("d1")) <= 0.5, F.col("d0").isNull() & F.col("d1").isNull())
    return both.select("id", F.coalesce("s0", F.lit("UNKNOWN")).alias("before"), F.coalesce("s1", F.lit("UNKNOWN")).alias("after"), F.col("s0").eqNullSafe(F.col("s1")).alias("same"), close.alias("close"))


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY GROUPING SETS ((quality), (toxic), ())")
def review_grouping_sets(spark, sf_dir):
    q, x = F.col("quality"), F.col("toxic")
    return read(spark, sf_dir, "labels").groupingSets([[q], [x], []], q, x).agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, max(value) AS most, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1")
def drift_stats(spark, sf_dir):
    e, v = read(spark, sf_dir, "events"), F.col("value")
    q = t.quantiles(e, "event_type", "value", {"median": 0.5, "p95": 0.95})
    g = e.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg(v), 6).alias("mean"), F.max(v).alias("most"))
    return g.join(q, "event_type", "left").select("event_type", "n", "mean", F.round("median", 6).alias("median"), "most", F.round("p95", 6).alias("p95"))


_EDGES = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 1.0]


@query("""
WITH l(label, lo, hi) AS (VALUES ('0-0.1',0.0,0.1),('0.1-0.2',0.1,0.2),('0.2-0.3',0.2,0.3),('0.3-0.4',0.3,0.4),('0.4-0.5',0.4,0.5),('0.5-0.6',0.5,0.6),('0.6-0.7',0.6,0.7),('0.7-1',0.7,1.0))
SELECT label, count(value) AS n FROM l LEFT JOIN events ON value / 100.0 >= CAST(lo AS DOUBLE) AND (value / 100.0 < CAST(hi AS DOUBLE) OR (CAST(hi AS DOUBLE) = 1.0 AND value / 100.0 <= 1.0)) GROUP BY 1
""")
def drift_histogram(spark, sf_dir):
    labels = spark.range(1).select(F.explode(F.array(*(F.lit(f"{a:g}-{b:g}") for a, b in zip(_EDGES[:-1], _EDGES[1:], strict=True)))).alias("label"))
    n = read(spark, sf_dir, "events").select(t.bins(F.col("value") / 100.0, _EDGES).alias("label")).groupBy("label").agg(F.count("*").alias("n"))
    return labels.join(F.broadcast(n), "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


@query("""
SELECT CASE WHEN k < 20 THEN 'low' WHEN k < 50 THEN 'mid' WHEN k < 80 THEN 'high' ELSE 'top' END AS bucket, count(*) AS n
FROM (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY 1
""")
def json_buckets(spark, sf_dir):
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(0))
    return read(spark, sf_dir, "events").groupBy(F.when(k < 20, "low").when(k < 50, "mid").when(k < 80, "high").otherwise("top").alias("bucket")).agg(F.count("*").alias("n"))


@query("""
SELECT user_id, CASE WHEN f = 0 OR abs((l - f) / f * 100) < 5 THEN 'stable' WHEN (l - f) / f > 0 THEN 'up' ELSE 'down' END AS trend
FROM (SELECT user_id, arg_min(value, (ts, event_id)) AS f, arg_max(value, (ts, event_id)) AS l FROM events GROUP BY 1)
""")
def trend_direction(spark, sf_dir):
    """From a user's first value to the last one; events without a value don't count."""
    at = F.when(F.col("value").isNotNull(), F.struct("ts", "event_id"))
    g = read(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("value", at).alias("f"), F.max_by("value", at).alias("l"))
    return g.select("user_id", t.direction(F.col("f"), F.col("l")).alias("trend"))


@query("SELECT event_type, user_id, count(DISTINCT CAST(ts AS DATE)) AS runs FROM events GROUP BY 1, 2 HAVING count(DISTINCT CAST(ts AS DATE)) >= 2")
def recurring_signatures(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.countDistinct(F.to_date("ts")).alias("runs")).where("runs >= 2")


@query("SELECT role, count(*) AS calls, CAST(sum(length(text)) AS BIGINT) AS chars, round(avg(length(text)) FILTER (length(text) > 0), 6) AS mean, round(sum(length(text)) / 1000.0 * 0.002, 6) AS cost FROM conversations GROUP BY 1")
def llm_usage(spark, sf_dir):
    n = F.length("text")
    return read(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("calls"), F.sum(n).alias("chars"), F.round(F.avg(F.when(n > 0, n)), 6).alias("mean"), F.round(F.sum(n) / 1000.0 * 0.002, 6).alias("cost"))


@query("""
SELECT n_name AS family, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS done, round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 1) AS pct
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def family_stats(spark, sf_dir):
    o, c, n = (read(spark, sf_dir, x) for x in ("orders", "customer", "nation"))
    j = o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").join(n.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    done = F.count_if(F.col("o_orderstatus") == "F")
    return j.groupBy(F.col("n_name").alias("family")).agg(F.count("*").alias("n"), done.alias("done"), t.rate(done, F.count("*"), 1).alias("pct"))


@query("SELECT user_id, max(CASE WHEN value > 90 THEN ts END) AS last_success, coalesce(max(value), 0) AS most FROM events GROUP BY 1")
def last_success(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.when(F.col("value") > 90, F.col("ts"))).alias("last_success"), F.coalesce(F.max("value"), F.lit(0.0)).alias("most"))


@query("""
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1
""")
def context_status_pivot(spark, sf_dir):
    s = F.col("o_orderstatus")
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(*(F.count_if(s == k).alias(k.lower()) for k in "FOP"))


@query("""SELECT p_brand, p_partkey, p_type = 'SMALL' AS has_target FROM part WHERE contains(p_name, 'o') AND p_type <> 'ECONOMY' QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_type = 'SMALL' DESC, p_size, p_partkey) = 1""")
def substitute_ranking(spark, sf_dir):
    """A substitute for each family: candidates have the keyword and lack what is to be avoided; those with the
    target first, then the smallest. One min of a struct, no sort."""
    c = read(spark, sf_dir, "part").where(F.contains("p_name", F.lit("o")) & (F.col("p_type") != "ECONOMY"))
    best = F.min(F.struct((F.col("p_type") != "SMALL").alias("a"), "p_size", "p_partkey"))
    return c.groupBy("p_brand").agg(best.alias("b")).select("p_brand", "b.p_partkey", (~F.col("b.a")).alias("has_target"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS ms, CAST(floor((epoch(TIMESTAMP '2025-01-01') - epoch(ts)) / 86400) AS BIGINT) AS age_days FROM events")
def age_and_duration(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    return read(spark, sf_dir, "events").select("event_id", F.unix_millis(at).alias("ms"), F.floor((F.unix_timestamp(F.lit("2025-01-01").cast("timestamp")) - F.unix_micros(at) / 1e6) / 86400).alias("age_days"))


@query("""
SELECT user_id, count(*) AS n, 'low_rate' AS reason FROM events GROUP BY 1 HAVING count(*) >= 5 AND avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END) <= 0.05
UNION ALL SELECT user_id, count(*) AS n, 'old' AS reason FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-05' AND NOT (count(*) >= 5 AND avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END) <= 0.05)
""")
def retire_patterns(spark, sf_dir):
    g = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.avg((F.col("value") > 50).cast("double")).alias("r"), F.max("ts").alias("at"))
    reason = F.when((F.col("n") >= 5) & (F.col("r") <= 0.05), "low_rate").when(F.col("at") < F.lit("2024-01-05").cast("timestamp_ntz"), "old")
    return g.withColumn("reason", reason).where("reason is not null").select("user_id", "n", "reason")


@query("SELECT user_id, n, s FROM (SELECT user_id, count(*) AS n, avg(CASE WHEN value > 20 THEN 1.0 ELSE 0.0 END) AS r FROM events GROUP BY 1), LATERAL (SELECT round(-(r * log10(n + 1)), 9) AS s) ORDER BY s, user_id")
def history_boost(spark, sf_dir):
    g = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.avg((F.col("value") > 20).cast("double")).alias("r"))
    return g.select("user_id", "n", F.round(-(F.col("r") * F.log10(F.col("n") + 1)), 9).alias("s")).orderBy("s", "user_id")


@query("SELECT o_custkey % 100 AS run, sha256(string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY CAST(o_orderkey AS VARCHAR))) AS selection_hash, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1")
def selection_hash(spark, sf_dir):
    """One hash of each run's selection, whatever its order."""
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select((F.col("o_custkey") % 100).alias("run"), F.col("o_orderkey").cast("string").alias("key"))
    return t.ordered_hash(o, "run", "key", "selection_hash").join(o.groupBy("run").agg(F.count("*").alias("n")), "run")
