"""Records of runs, failures, reviews and patterns: filters, look-ups, reports, stores and state.

events stand for failures and attempts, orders for runs, conversations for reviews, part for a catalogue of types.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import tabular as t
from .base import query, read
from .samples import MESSAGES, pick, pick_sql, quoted


def _first(pairs, otherwise):
    out = None
    for test, value in pairs:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(otherwise)


@query("SELECT o_orderkey, o_orderstatus, o_custkey % 100 AS run FROM orders WHERE o_orderstatus IN ('P', 'F') AND o_custkey % 100 = 7")
def status_in_list(spark, sf_dir):
    """Rows of one run with one of the given states."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 100).alias("run"))
    return o.where(F.col("o_orderstatus").isin("P", "F") & (F.col("run") == 7))


@query("SELECT page_id, url FROM pages WHERE url = (SELECT min(url) FROM pages)")
def file_filter(spark, sf_dir):
    """Rows of one file, the first by name."""
    p = read(spark, sf_dir, "pages").select("page_id", "url")
    return p.join(F.broadcast(p.agg(F.min("url").alias("url"))), "url").select("page_id", "url")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderpriority, o_orderkey LIMIT 20")
def review_queue(spark, sf_dir):
    return read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").orderBy("o_orderpriority", "o_orderkey").limit(20).select("o_orderkey", "o_orderpriority")


@query("""SELECT p_partkey, starts_with(p_type, 'E') AS phase, p_brand IS NULL OR NOT starts_with(p_brand, 'Brand#1') AS live, CASE WHEN p_brand IN ('Brand#2') THEN false WHEN p_size % 3 = 0 THEN true ELSE p_brand IN ('Brand#3', 'Brand#4') END AS owner FROM part""")
def predicates(spark, sf_dir):
    """A prefix, the negated prefix that keeps nulls, and an owner rule: blocked first, an empty list of allowed ones allows all."""
    b = F.col("p_brand")
    owner = F.when(b.isin("Brand#2"), False).when(F.col("p_size") % 3 == 0, True).otherwise(b.isin("Brand#3", "Brand#4"))
    return read(spark, sf_dir, "part").select("p_partkey", F.col("p_type").startswith("E").alias("phase"), (b.isNull() | ~b.startswith("Brand#1")).alias("live"), owner.alias("owner"))


@query("SELECT c_custkey, coalesce(max(o_orderkey), 0) AS latest, count(o_orderkey) AS attempts FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def latest_attempt(spark, sf_dir):
    """The highest attempt, 0 without any. Attempts are aggregated before the join."""
    o = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("latest"), F.count("*").alias("attempts"))
    return read(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("latest", F.lit(0)).alias("latest"), F.coalesce("attempts", F.lit(0)).alias("attempts"))


_MSG = pick_sql(MESSAGES, "event_id")


@query(f"""WITH e AS (SELECT user_id % 10 AS run, event_type AS phase, {_MSG} AS reason FROM events WHERE value > 10), n AS (SELECT run, reason, count(*) AS n FROM e GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY n DESC, reason) AS k FROM n)
SELECT run, 'phase' AS kind, phase AS name, count(*) AS n FROM e GROUP BY 1, 3 UNION ALL SELECT run, 'reason', reason, n FROM r WHERE k <= 10 UNION ALL SELECT run, 'total', '', count(*) FROM e GROUP BY 1""")
def rejection_rates(spark, sf_dir):
    """Rejections of each run: in all, by phase, and the ten commonest reasons."""
    e = read(spark, sf_dir, "events").where("value > 10").select((F.col("user_id") % 10).alias("run"), F.col("event_type").alias("phase"), pick(MESSAGES, F.col("event_id")).alias("reason"))
    total = e.groupBy("run").agg(F.count("*").alias("n")).select("run", F.lit("total").alias("kind"), F.lit("").alias("name"), "n")
    phase = e.groupBy("run", F.col("phase").alias("name")).agg(F.count("*").alias("n")).select("run", F.lit("phase").alias("kind"), "name", "n")
    reasons = t.newest(e.groupBy("run", F.col("reason").alias("name")).agg(F.count("*").alias("n")), ["run"], [F.desc("n"), F.col("name")], 10)
    return total.unionByName(phase).unionByName(reasons.select("run", F.lit("reason").alias("kind"), "name", "n"))


@query("SELECT o_custkey % 50 AS run, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS rate FROM orders GROUP BY 1 HAVING avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) < 0.5")
def quality_alert(spark, sf_dir):
    """Runs of which less than half is verified."""
    ok = F.avg((F.col("o_orderstatus") == "F").cast("double"))
    return read(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 50).alias("run")).agg(F.round(ok, 6).alias("rate"), ok.alias("r")).where("r < 0.5").select("run", "rate")


@query("""SELECT category, first_type, n, fixed, round(100.0 * fixed / n, 2) AS fix_rate, round(100.0 * n / sum(n) OVER (), 2) AS pct FROM (SELECT props AS category, min(event_type) AS first_type, count(*) AS n, count(*) FILTER (value <= 30) AS fixed FROM events WHERE props IS NOT NULL GROUP BY 1 ORDER BY n DESC, category LIMIT 10)""")
def top_errors_report(spark, sf_dir):
    """The ten commonest; their share is of these ten. The bare column of the group is its least value."""
    g = read(spark, sf_dir, "events").where("props is not null").groupBy(F.col("props").alias("category")).agg(F.min("event_type").alias("first_type"), F.count("*").alias("n"), F.count_if(F.col("value") <= 30).alias("fixed"))
    g = g.orderBy(F.desc("n"), "category").limit(10)
    return t.share_of_total(g.withColumn("fix_rate", F.round(100.0 * F.col("fixed") / F.col("n"), 2)), "n")


@query(f"""WITH f AS (SELECT event_type AS phase, CASE WHEN value < 5 THEN NULL ELSE {_MSG} END AS reason, value > 40 AS timeout FROM events)
SELECT 'timeout' AS report, phase AS name, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM f WHERE timeout GROUP BY 2
UNION ALL SELECT 'review', coalesce(reason, 'unknown'), count(*), round(100.0 * count(*) / sum(count(*)) OVER (), 2) FROM f WHERE NOT timeout GROUP BY 2""")
def failure_reports(spark, sf_dir):
    """Time-outs by phase and reasons for review, a missing one as unknown, each with its share."""
    reason = F.coalesce(F.when(F.col("value") >= 5, pick(MESSAGES, F.col("event_id"))), F.lit("unknown"))
    e = read(spark, sf_dir, "events").select("event_type", "value", reason.alias("reason"))
    part = lambda where, name, label: t.share_of_total(e.where(where).groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n")), "n").select(F.lit(label).alias("report"), "name", "n", "pct")
    return part("value > 40", "event_type", "timeout").unionByName(part("not value > 40", "reason", "review"))


@query("""WITH r AS (SELECT o_custkey % 30 AS family, o_orderkey AS run, o_totalprice AS processed, o_orderdate AS done FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT family, run FROM r QUALIFY row_number() OVER (PARTITION BY family ORDER BY processed DESC, done DESC, run DESC) = 1)
SELECT family, run, count(*) AS discovered, count(*) FILTER (l_returnflag = 'N') AS verified, count(*) FILTER (l_returnflag = 'R') AS failed, round(100.0 * count(*) FILTER (l_returnflag = 'N') / count(*), 1) AS rate FROM b JOIN lineitem ON l_orderkey = run GROUP BY 1, 2""")
def baseline_from_best_run(spark, sf_dir):
    """Each family's largest finished run, the newest of equal ones, and what came of it. One max_by, no window."""
    best = F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderdate", "o_orderkey"))
    b = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy((F.col("o_custkey") % 30).alias("family")).agg(best.alias("run"))
    x, n = F.col("l_returnflag"), F.count("*")
    j = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run"), "l_returnflag").join(b, "run")
    return j.groupBy("family", "run").agg(n.alias("discovered"), F.count_if(x == "N").alias("verified"), F.count_if(x == "R").alias("failed"), F.round(100.0 * F.count_if(x == "N") / n, 1).alias("rate"))


@query("""SELECT s_suppkey, sha256(concat('{"cli_overrides": {"limit": ', s_suppkey, '}, "family": {"name": ', to_json(s_name), ', "roots": ["a", "', s_nationkey, '"]}, "global": {"positive": ', CASE WHEN s_acctbal > 0 THEN 'true' ELSE 'false' END, ', "retries": 3}}')) AS config_hash FROM supplier""")
def config_hash(spark, sf_dir):
    """SHA-256 of each supplier's effective configuration, its three sections side by side and all keys sorted."""
    text = lambda *x: F.concat(*(F.lit(v) if isinstance(v, str) else v.cast("string") for v in x))
    name = F.get_json_object(F.to_json(F.struct(F.array("s_name").alias("n"))), "$.n")
    family = text('{"name": ', F.substr(name, F.lit(2), F.length(name) - 2), ', "roots": ["a", "', F.col("s_nationkey"), '"]}')
    whole = text('{"cli_overrides": {"limit": ', F.col("s_suppkey"), '}, "family": ', family, ', "global": {"positive": ', F.when(F.col("s_acctbal") > 0, "true").otherwise("false"), ', "retries": 3}}')
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.sha2(whole, 256).alias("config_hash"))


@query("SELECT event_type AS pattern, count(*) AS applied, count(*) FILTER (value > 20) AS succeeded, round((count(*) FILTER (value > 20) / count(*))::DOUBLE, 6) AS rate, max(ts) AS last_used FROM events GROUP BY 1")
def pattern_success(spark, sf_dir):
    """A pattern's counters from the log of its applications, whatever order they came in."""
    ok = F.count_if(F.col("value") > 20)
    return read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("pattern")).agg(F.count("*").alias("applied"), ok.alias("succeeded"), F.round(ok / F.count("*"), 6).alias("rate"), F.max("ts").alias("last_used"))


@query("""WITH n AS (SELECT max(o_orderdate) AS now FROM orders) SELECT o_orderkey, CAST(date_diff('day', o_orderdate, now) AS INTEGER) AS age, o_orderstatus = 'O' AND o_orderdate < now - INTERVAL 90 DAY AS stuck, date_diff('day', o_orderdate, now) <= 30 AS fresh FROM orders, n""")
def run_ages(spark, sf_dir):
    """Days since a run began, whether one that is still open is stuck (90 days) and whether a report is fresh (30)."""
    o = read(spark, sf_dir, "orders")
    now = F.broadcast(o.agg(F.max("o_orderdate").alias("now")))
    age = F.datediff("now", "o_orderdate")
    return o.crossJoin(now).select("o_orderkey", age.alias("age"), ((F.col("o_orderstatus") == "O") & (age > 90)).alias("stuck"), (age <= 30).alias("fresh"))


@query(f"SELECT user_id, list_sort(list(DISTINCT f)) AS fixes FROM (SELECT user_id, unnest([event_type, concat('f', event_id % 3)]) AS f FROM events) GROUP BY 1")
def fixes_by_example(spark, sf_dir):
    """Distinct fixes in the metadata's list, by example. They are made distinct before they are gathered."""
    k = F.col("event_id")
    meta = F.concat(F.lit('{"fixes": [{"type": "'), "event_type", F.lit('"}, {"type": "f'), (k % 3).cast("string"), F.lit('"}, {"type": "'), "event_type", F.lit('"}], "score": '), (k % 7).cast("string"), F.lit("}"))
    e = read(spark, sf_dir, "events").select("user_id", F.from_json(meta, "fixes array<struct<type:string>>, score int").alias("m"))
    return e.select("user_id", F.explode("m.fixes.type").alias("f")).distinct().groupBy("user_id").agg(F.sort_array(F.collect_list("f")).alias("fixes"))


@query(f"SELECT event_id, concat('{{\"fixes\":[{{\"type\":\"', event_type, '\"}}],\"nested\":{{\"score\":', event_id % 7, '}}}}') AS stable FROM events")
def volatile_keys_stripped(spark, sf_dir):
    """A run's JSON without its volatile keys, at every level: the schema that is read holds only what is stable."""
    k = F.col("event_id").cast("string")
    raw = F.concat(F.lit('{"run_id": "r'), k, F.lit('", "fixes": [{"timestamp": '), k, F.lit(', "type": "'), "event_type", F.lit('"}], "nested": {"duration_ms": 5, "score": '), (F.col("event_id") % 7).cast("string"), F.lit("}}"))
    return read(spark, sf_dir, "events").select("event_id", F.to_json(F.from_json(raw, "fixes array<struct<type:string>>, nested struct<score:int>")).alias("stable"))


@query("""WITH c AS (SELECT p_type AS type, list_sort(list(DISTINCT p_brand)) AS brands FROM part GROUP BY 1), d AS (SELECT p_type AS type, count(DISTINCT p_size) AS sizes, list_sort(list(DISTINCT concat(p_name, '()'))) AS methods FROM part GROUP BY 1),
f AS (SELECT lower(p_type) AS low, min(p_type) AS first FROM part GROUP BY 1)
SELECT p.p_partkey, c.brands AS members, list_filter(c.brands, lambda z: z <> p.p_brand) AS siblings, list_sort(list_distinct(list_concat(c.brands, [concat('size', p.p_size)]))) AS all_members, d.sizes > 1 AS ambiguous, f.first AS found, list_filter(d.methods, lambda z: contains(lower(z), 'a')) AS matching
FROM part p JOIN c ON c.type = p.p_type JOIN d ON d.type = p.p_type JOIN f ON f.low = lower(upper(p.p_type))""")
def catalog_lookups(spark, sf_dir):
    """What the catalogue says of a type: its members, siblings, all members with its own, whether it stands in several
    namespaces, its spelling whatever the case, and methods by part of their name. A type's lists are distinct before they are gathered."""
    p = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size", "p_name")
    lists = lambda x, name: p.select("p_type", x.alias("x")).distinct().groupBy("p_type").agg(F.sort_array(F.collect_list("x")).alias(name))
    c, d = lists(F.col("p_brand"), "members"), lists(F.concat("p_name", F.lit("()")), "methods")
    sizes = p.groupBy("p_type").agg((F.countDistinct("p_size") > 1).alias("ambiguous"))
    f = p.groupBy(F.lower("p_type").alias("low")).agg(F.min("p_type").alias("found"))
    j = p.join(c, "p_type").join(d, "p_type").join(sizes, "p_type").withColumn("low", F.lower(F.upper("p_type"))).join(f, "low")
    every = F.array_sort(F.array_union("members", F.array(F.concat(F.lit("size"), F.col("p_size").cast("string")))))
    return j.select("p_partkey", "members", F.filter("members", lambda z: z != F.col("p_brand")).alias("siblings"), every.alias("all_members"), "ambiguous", "found", F.filter("methods", lambda z: F.contains(F.lower(z), F.lit("a"))).alias("matching"))


@query("""WITH n AS (SELECT n_name AS type, r_name AS namespace, n_nationkey AS k FROM nation JOIN region ON r_regionkey = n_regionkey), b AS (SELECT namespace, min(type) AS base FROM n GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS ctors FROM supplier GROUP BY 1)
SELECT x.q AS asked, n.type IS NOT NULL AS known, n.namespace, nullif(b.base, n.type) AS base, coalesce(b.base, x.q) AS type_group, coalesce(s.ctors, 0) AS constructors FROM (SELECT DISTINCT CASE WHEN c_nationkey % 5 = 0 THEN concat('NONE_', c_nationkey) ELSE n_name END AS q FROM customer JOIN nation ON n_nationkey = c_nationkey) x
LEFT JOIN n ON n.type = x.q LEFT JOIN b ON b.namespace = n.namespace LEFT JOIN s ON s.k = n.k""")
def type_lookups(spark, sf_dir):
    """Whether a type is known, its namespace, base, group and number of constructors."""
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("type"), F.col("r_name").alias("namespace"), F.col("n_nationkey").alias("k"))
    b = n.groupBy("namespace").agg(F.min("type").alias("base"))
    s = read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("ctors"))
    x = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).distinct().join(n.select("k", "type"), "k").select(F.when(F.col("k") % 5 == 0, F.concat(F.lit("NONE_"), F.col("k").cast("string"))).otherwise(F.col("type")).alias("asked")).distinct()
    j = x.join(n, F.col("asked") == F.col("type"), "left").join(b, "namespace", "left").join(s, "k", "left")
    return j.select("asked", F.col("type").isNotNull().alias("known"), "namespace", F.nullif("base", "type").alias("base"), F.coalesce("base", "asked").alias("type_group"), F.coalesce("ctors", F.lit(0)).alias("constructors"))


@query("""WITH t AS (SELECT conv_id, turn, role, length(text) AS n FROM conversations), f AS (SELECT conv_id, bool_or(n % 2 = 0) AS fixed, bool_or(n % 7 = 0) AS mismatch FROM t GROUP BY 1)
SELECT conv_id, fixed OR mismatch AS reviewed, CASE WHEN fixed THEN 'llm_fixed' WHEN mismatch THEN 'filename_mismatch' ELSE 'auto_pass' END AS why FROM f""")
def review_selection(spark, sf_dir):
    """A file is reviewed as a whole if any of its examples was fixed by a model or names wrong files; others pass."""
    n = F.length("text")
    f = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.bool_or(n % 2 == 0).alias("fixed"), F.bool_or(n % 7 == 0).alias("mismatch"))
    return f.select("conv_id", (F.col("fixed") | F.col("mismatch")).alias("reviewed"), F.when(F.col("fixed"), "llm_fixed").when(F.col("mismatch"), "filename_mismatch").otherwise("auto_pass").alias("why"))


@query("""WITH s AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS pos FROM conversations), i AS (SELECT conv_id, turn, length(text) % 4 AS idx, length(text) % 3 = 0 AS disproved, role FROM conversations)
SELECT i.conv_id, i.turn, i.role, coalesce(CAST(s.turn AS VARCHAR), 'unknown') AS example FROM i LEFT JOIN s ON s.conv_id = i.conv_id AND s.pos = i.idx WHERE NOT (i.role = 'assistant' AND i.disproved)""")
def issue_positions(spark, sf_dir):
    """Issues with the example at their position, unknown beyond the list; mismatches that the catalogue disproves are dropped."""
    c = read(spark, sf_dir, "conversations")
    s = c.withColumn("idx", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "text")) - 1).select("conv_id", "idx", F.col("turn").cast("string").alias("example"))
    i = c.where(~((F.col("role") == "assistant") & (F.length("text") % 3 == 0))).select("conv_id", "turn", "role", (F.length("text") % 4).alias("idx"))
    return i.join(s, ["conv_id", "idx"], "left").select("conv_id", "turn", "role", F.coalesce("example", F.lit("unknown")).alias("example"))


@query("""WITH c AS (SELECT conv_id, role, concat('- ', role, ' ', turn) AS line, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS k FROM conversations)
SELECT conv_id, concat_ws(chr(10), string_agg(line, chr(10) ORDER BY k) FILTER (role = 'user' AND k <= 8), string_agg(line, chr(10) ORDER BY k) FILTER (role = 'assistant' AND k <= 12)) AS context FROM c GROUP BY 1""")
def review_context(spark, sf_dir):
    """The first 8 findings of one kind and 12 of another, as lines; no list is longer than that."""
    w = Window.partitionBy("conv_id", "role").orderBy("turn", "text")
    c = read(spark, sf_dir, "conversations").withColumn("k", F.row_number().over(w)).where(((F.col("role") == "user") & (F.col("k") <= 8)) | ((F.col("role") == "assistant") & (F.col("k") <= 12)))
    line = F.struct("k", F.concat(F.lit("- "), "role", F.lit(" "), F.col("turn").cast("string")).alias("line"))
    g = read(spark, sf_dir, "conversations").select("conv_id").distinct().join(c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.when(F.col("role") == "user", line))).alias("u"), F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", line))).alias("a")), "conv_id", "left")
    text = lambda x: F.when(F.size(x) > 0, F.array_join(F.transform(x, lambda z: z["line"]), "\n"))
    return g.select("conv_id", F.concat_ws("\n", text(F.col("u")), text(F.col("a"))).alias("context"))


@query("""WITH i AS (SELECT conv_id, turn AS issue, CASE WHEN length(text) % 3 = 0 THEN NULL WHEN length(text) % 5 = 0 THEN -1 ELSE turn END AS target FROM conversations WHERE role = 'assistant'), e AS (SELECT DISTINCT conv_id, turn FROM conversations)
SELECT i.conv_id, i.issue, e.turn FROM i JOIN e ON e.conv_id = i.conv_id AND (i.target IS NULL OR i.target = e.turn)""")
def remediation_targets(spark, sf_dir):
    """What an issue's remedy applies to: its example, or all of its file where it names none; an unknown example is skipped."""
    c = read(spark, sf_dir, "conversations")
    n = F.length("text")
    i = c.where("role = 'assistant'").select("conv_id", F.col("turn").alias("issue"), F.when(n % 3 != 0, F.when(n % 5 == 0, -1).otherwise(F.col("turn"))).alias("target"))
    e = c.select("conv_id", "turn").distinct()
    one = i.where("target is not null").join(e, (i["conv_id"] == e["conv_id"]) & (F.col("target") == F.col("turn")), "left_semi").select("conv_id", "issue", F.col("target").alias("turn"))
    return one.unionByName(i.where("target is null").join(e, "conv_id").select("conv_id", "issue", "turn"))


@query("""WITH r AS (SELECT o_custkey % 40 AS family, o_orderdate AS began, row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders), l AS (SELECT family, began FROM r WHERE k = 2)
SELECT l.family, count(o_orderkey) AS newer, count(o_orderkey) > 0 AS has_new FROM l LEFT JOIN orders ON o_custkey % 40 = l.family AND o_orderdate > l.began AND o_orderstatus = 'F' GROUP BY 1""")
def new_since_last_run(spark, sf_dir):
    """How many patterns are newer than the second newest run of their family."""
    o = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("family"), "o_orderdate", "o_orderkey", "o_orderstatus")
    w = Window.partitionBy("family").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    last = o.withColumn("k", F.row_number().over(w)).where("k = 2").select("family", F.col("o_orderdate").alias("began"))
    j = o.join(last, "family")
    return j.groupBy("family").agg(F.count_if((F.col("o_orderdate") > F.col("began")) & (F.col("o_orderstatus") == "F")).alias("newer")).withColumn("has_new", F.col("newer") > 0)


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority IS NULL THEN 'missing_code' WHEN o_orderstatus NOT IN ('F', 'P') THEN concat('status_', o_orderstatus) END AS error FROM orders""")
def provenance_check(spark, sf_dir):
    """Rows that may be written back have verified code and an allowed state; others carry the error."""
    return read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderpriority").isNull(), "missing_code").when(~F.col("o_orderstatus").isin("F", "P"), F.concat(F.lit("status_"), "o_orderstatus")).alias("error"))


@query("SELECT o_custkey % 25 AS batch, bool_and(o_orderstatus IN ('F', 'P')) AS valid, count(*) FILTER (o_orderstatus NOT IN ('F', 'P')) AS bad FROM orders GROUP BY 1")
def provenance_batches(spark, sf_dir):
    ok = F.col("o_orderstatus").isin("F", "P")
    return read(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 25).alias("batch")).agg(F.bool_and(ok).alias("valid"), F.count_if(~ok).alias("bad"))


_PATTERNS = "(SELECT p_partkey AS id, p_brand AS family, p_type AS signature, CASE p_size % 3 WHEN 0 THEN 'template' WHEN 1 THEN 'regex_replace' ELSE 'using_directive' END AS kind, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS fix, p_size AS applied, p_partkey % 11 AS succeeded, p_partkey % 7 AS priority, p_size / 50.0 AS confidence, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN 'retired_old' ELSE 'mined' END AS source, p_partkey % 3 <> 0 AS approved FROM part)"


def _patterns(spark, sf_dir):
    k, n = F.col("p_partkey"), F.col("p_size")
    kind = F.when(n % 3 == 0, "template").when(n % 3 == 1, "regex_replace").otherwise("using_directive")
    return read(spark, sf_dir, "part").select(k.alias("id"), F.col("p_brand").alias("family"), F.col("p_type").alias("signature"), kind.alias("kind"), F.when(n % 3 != 0, F.col("p_name")).alias("fix"), n.alias("applied"), (k % 11).alias("succeeded"), (k % 7).alias("priority"), (n / 50.0).alias("confidence"), F.when(k % 9 == 0, None).when(k % 4 == 0, "retired_old").otherwise("mined").alias("source"), (k % 3 != 0).alias("approved"))


@query(f"""WITH p AS (SELECT *, least(succeeded, applied) / applied AS rate, id % 400 AS age FROM {_PATTERNS} WHERE approved AND applied >= 5)
SELECT id, rate <= 0.3 OR age > 365 AS retire, concat_ws('; ', CASE WHEN rate <= 0.3 THEN 'low success rate' END, CASE WHEN age > 365 THEN 'too old' END) AS reason, CASE WHEN rate <= 0.3 OR age > 365 THEN concat('retired_', coalesce(source, '')) ELSE source END AS source, rate < 0.3 AND applied >= 10 AS low_performer FROM p""")
def retirement_policy(spark, sf_dir):
    """Approved patterns with five attempts or more: retired by rate or age, with all reasons and a marked source; and by the older, strict rule."""
    p = _patterns(spark, sf_dir).where("approved and applied >= 5").withColumn("rate", F.least("succeeded", "applied") / F.col("applied")).withColumn("age", F.col("id") % 400)
    low, old = F.col("rate") <= 0.3, F.col("age") > 365
    return p.select("id", (low | old).alias("retire"), F.concat_ws("; ", F.when(low, "low success rate"), F.when(old, "too old")).alias("reason"), F.when(low | old, F.concat(F.lit("retired_"), F.coalesce("source", F.lit("")))).otherwise(F.col("source")).alias("source"), ((F.col("rate") < 0.3) & (F.col("applied") >= 10)).alias("low_performer"))


@query(f"""SELECT family, signature, id, CAST(row_number() OVER (PARTITION BY family, signature ORDER BY priority, confidence DESC, id) AS INTEGER) AS rank FROM {_PATTERNS} WHERE approved AND id <= (SELECT coalesce(max(id), 0) FROM {_PATTERNS})""")
def pattern_preload(spark, sf_dir):
    """Approved patterns up to the run's version, in the order they are tried."""
    p = _patterns(spark, sf_dir)
    v = F.broadcast(p.agg(F.coalesce(F.max("id"), F.lit(0)).alias("version")))
    w = Window.partitionBy("family", "signature").orderBy("priority", F.desc("confidence"), "id")
    return p.where("approved").crossJoin(v).where("id <= version").select("family", "signature", "id", F.row_number().over(w).alias("rank"))


_NEW = f"(SELECT id + 1000000 AS id, family, signature, kind, CASE WHEN id % 5 = 0 THEN concat(fix, ' new') WHEN id % 13 = 0 THEN '[' ELSE fix END AS fix FROM {_PATTERNS} WHERE id % 2 = 0)"


@query(f"""WITH o AS (SELECT family, signature, kind, coalesce(fix, '') AS fix FROM {_PATTERNS} WHERE source IS NULL OR NOT starts_with(source, 'retired_')), n AS {_NEW}
SELECT id, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.family = n.family AND o.signature = n.signature AND o.kind = n.kind AND (n.kind = 'template' OR o.fix = coalesce(n.fix, ''))) THEN 'duplicate' WHEN kind = 'regex_replace' AND fix = '[' THEN 'invalid' ELSE 'stored' END AS outcome,
 CASE WHEN kind = 'using_directive' AND starts_with(fix, 'a') THEN 'global' ELSE 'family' END AS scope FROM n""")
def pattern_store(spark, sf_dir):
    """New patterns: duplicates of live ones are skipped, patterns that don't compile are refused, the rest is stored with its scope."""
    p = _patterns(spark, sf_dir)
    k = F.col("id")
    n = p.where(k % 2 == 0).select((k + 1000000).alias("id"), "family", "signature", "kind", F.when(k % 5 == 0, F.concat("fix", F.lit(" new"))).when(k % 13 == 0, "[").otherwise(F.col("fix")).alias("fix"))
    key = F.when(F.col("kind") == "template", "").otherwise(F.coalesce("fix", F.lit("")))
    live = p.where(F.col("source").isNull() | ~F.col("source").startswith("retired_")).select("family", "signature", "kind", key.alias("key")).distinct().withColumn("dup", F.lit(True))
    j = n.withColumn("key", key).join(live, ["family", "signature", "kind", "key"], "left")
    bad = (F.col("kind") == "regex_replace") & (F.col("fix") == "[")
    scope = F.when((F.col("kind") == "using_directive") & F.col("fix").startswith("a"), "global").otherwise("family")
    return j.select("id", F.when(F.col("dup"), "duplicate").when(bad, "invalid").otherwise("stored").alias("outcome"), scope.alias("scope"))


@query(f"""SELECT id, approved OR id % 6 = 0 AS approved, CASE WHEN id % 10 = 3 THEN 'retired_manual' ELSE source END AS source FROM {_PATTERNS}""")
def pattern_approval(spark, sf_dir):
    """The store after a bulk approval and single retirements: updates keyed by id, merged in one pass."""
    p = _patterns(spark, sf_dir).select("id", "approved", "source")
    updates = p.where("id % 6 = 0 or id % 10 = 3").select("id", (F.col("id") % 6 == 0).alias("approve"), F.when(F.col("id") % 10 == 3, "retired_manual").alias("retired"))
    j = p.join(updates, "id", "left")
    return j.select("id", (F.col("approved") | F.coalesce("approve", F.lit(False))).alias("approved"), F.coalesce("retired", "source").alias("source"))


PROOFS = [(r"foo(\d+)", "bar$1", "foo1 foo22", "bar1 bar22"), (r"a+", "b", "caat", "cbt "), (r"x", "y", "xx", "yx"), (r"\s+$", "", "end  ", "end")]


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN regexp_replace('foo1 foo22', 'foo(\\d+)', 'bar\\1', 'g') = 'bar1 bar22' WHEN 1 THEN trim(regexp_replace('caat', 'a+', 'b', 'g')) = trim('cbt ') WHEN 2 THEN regexp_replace('xx', 'x', 'y', 'g') = 'yx' ELSE regexp_replace('end  ', '\\s+$', '', 'g') = 'end' END AS proved FROM part")
def regex_proof(spark, sf_dir):
    """Whether a learned replacement turns its example's before into its after."""
    row = F.element_at(F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip("prba", x, strict=True))) for x in PROOFS)), (F.col("p_partkey") % 4 + 1).cast("int"))
    p = read(spark, sf_dir, "part").select("p_partkey", row.alias("x"))
    return p.select("p_partkey", (F.trim(F.regexp_replace("x.b", F.col("x.p"), F.col("x.r"))) == F.trim("x.a")).alias("proved"))


SPACES = {"Chart": "Acme.Charts", "Report": "Acme.Reports"}
DIRECTIVES = [("using System.IO;", "Chart"), ("using Acme.Charts;", "Chart"), ("using Acme.Reports;", "Chart"), ("using Acme.Reports;", "Other"), ("using Nowhere;", ""), ("import x", "Chart"), ("", "")]


@query(f"""WITH d AS (SELECT p_partkey, {pick_sql([d for d, _ in DIRECTIVES], 'p_partkey')} AS d, {pick_sql([w for _, w in DIRECTIVES], 'p_partkey')} AS w FROM part), n AS (SELECT *, regexp_extract(d, '^using\\s+([\\w.]+)\\s*;', 1) AS n, CASE w WHEN 'Chart' THEN 'Acme.Charts' WHEN 'Report' THEN 'Acme.Reports' END AS e FROM d)
SELECT p_partkey, CASE WHEN d = '' THEN 'missing' WHEN n = '' THEN 'invalid' WHEN n IN ('System', 'System.IO', 'System.Text', 'System.Linq') THEN 'bcl' WHEN e = n THEN 'match' WHEN e IS NOT NULL THEN 'mismatch' WHEN n IN ('Acme.Charts', 'Acme.Reports') THEN 'known' ELSE 'unknown' END AS verdict FROM n""")
def using_proof(spark, sf_dir):
    """Whether a learned directive's namespace is the platform's, its type's, or at least known."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select(k, pick([d for d, _ in DIRECTIVES], k).alias("d"), pick([w for _, w in DIRECTIVES], k).alias("w"))
    n = F.regexp_extract("d", r"^using\s+([\w.]+)\s*;", 1)
    e = F.when(F.col("w") == "Chart", SPACES["Chart"]).when(F.col("w") == "Report", SPACES["Report"])
    verdict = _first([(F.col("d") == "", "missing"), (n == "", "invalid"), (n.isin("System", "System.IO", "System.Text", "System.Linq"), "bcl"), (e == n, "match"), (e.isNotNull(), "mismatch"), (n.isin(*SPACES.values()), "known")], "unknown")
    return p.select("p_partkey", verdict.alias("verdict"))


# The states of an example and the moves between them.
MOVES = {
    "DISCOVERED": ["COMPILE_FAILED", "COMPILABLE", "NEEDS_REVIEW", "INFRA_BLOCKED"],
    "COMPILE_FAILED": ["COMPILABLE", "NEEDS_REVIEW", "INFRA_BLOCKED"],
    "COMPILABLE": ["RUNTIME_FAILED", "VERIFIED", "NEEDS_REVIEW", "INFRA_BLOCKED"],
    "RUNTIME_FAILED": ["VERIFIED", "NEEDS_REVIEW", "INFRA_BLOCKED"],
    "VERIFIED": ["MD_UPDATED", "NEEDS_REVIEW"],
    "MD_UPDATED": ["FINAL_REVIEW_PASSED", "FINAL_REVIEW_FAILED"],
    "FINAL_REVIEW_PASSED": ["COMMITTED"],
    "FINAL_REVIEW_FAILED": [],
    "NEEDS_REVIEW": [],
    "INFRA_BLOCKED": [],
    "COMMITTED": [],
}
STATES = list(MOVES)
_TO = pick_sql(STATES, "event_id * 7 + user_id")


@query(f"""WITH m AS (SELECT user_id, event_id, {_TO} AS wanted, coalesce(lag({_TO}) OVER (PARTITION BY user_id ORDER BY ts, event_id), 'DISCOVERED') AS was FROM events), l(was, wanted) AS (VALUES {', '.join(f"('{a}', '{b}')" for a, bs in MOVES.items() for b in bs)})
SELECT m.user_id, m.event_id, m.was, m.wanted, l.was IS NOT NULL AS allowed, m.was IN ('FINAL_REVIEW_FAILED', 'NEEDS_REVIEW', 'INFRA_BLOCKED', 'COMMITTED') AS terminal FROM m LEFT JOIN l ON l.was = m.was AND l.wanted = m.wanted""")
def transition_check(spark, sf_dir):
    """Every attempted move with the state before it, whether the machine allows it, and whether that state was final. Blocked attempts are kept as well."""
    to = pick(STATES, F.col("event_id") * 7 + F.col("user_id"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    m = read(spark, sf_dir, "events").select("user_id", "event_id", "ts", to.alias("wanted")).withColumn("was", F.coalesce(F.lag("wanted").over(w), F.lit("DISCOVERED")))
    legal = F.broadcast(spark.createDataFrame([(a, b, True) for a, bs in MOVES.items() for b in bs], "was string, wanted string, ok boolean"))
    final = [s for s, to in MOVES.items() if not to]
    return m.join(legal, ["was", "wanted"], "left").select("user_id", "event_id", "was", "wanted", F.coalesce("ok", F.lit(False)).alias("allowed"), F.col("was").isin(*final).alias("terminal"))


@query("""WITH a AS (SELECT o_orderstatus AS status, count(*) AS n FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1), b AS (SELECT CASE o_orderstatus WHEN 'P' THEN 'X' ELSE o_orderstatus END AS status, count(*) AS n FROM orders WHERE o_custkey % 2 = 1 GROUP BY 1)
SELECT coalesce(a.status, b.status) AS status, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after, coalesce(a.n, 0) = coalesce(b.n, 0) AS same FROM a FULL JOIN b ON a.status = b.status""")
def status_counts_compared(spark, sf_dir):
    """Counts of two runs by state; a state that one lacks counts 0."""
    o, s = read(spark, sf_dir, "orders"), F.col("o_orderstatus")
    side = lambda k, status, name: o.where(F.col("o_custkey") % 2 == k).groupBy(status.alias("status")).agg(F.count("*").alias(name))
    j = side(0, s, "before").join(side(1, F.when(s == "P", "X").otherwise(s), "after"), "status", "full").select("status", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return j.withColumn("same", F.col("before") == F.col("after"))


@query("""WITH r AS (SELECT o_custkey % 60 AS family, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS last FROM orders GROUP BY 1), n AS (SELECT max(o_orderdate) AS now FROM orders), c AS (SELECT unnest(range(0, 70)) AS family)
SELECT c.family, CASE WHEN r.family IS NULL THEN 'never_run' WHEN r.last IS NULL THEN 'never_succeeded' ELSE 'stale' END AS why FROM c LEFT JOIN r ON r.family = c.family, n WHERE r.family IS NULL OR r.last IS NULL OR r.last < now - INTERVAL 7 DAY""")
def stale_families(spark, sf_dir):
    """Configured families that never ran, never succeeded, or last did so more than a week before the newest run."""
    o = read(spark, sf_dir, "orders")
    now = F.broadcast(o.agg(F.max("o_orderdate").alias("now")))
    r = o.groupBy((F.col("o_custkey") % 60).alias("family")).agg(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("last")).withColumn("seen", F.lit(True))
    j = spark.range(70).select(F.col("id").alias("family")).join(r, "family", "left").crossJoin(now)
    why = F.when(F.col("seen").isNull(), "never_run").when(F.col("last").isNull(), "never_succeeded").when(F.datediff("now", "last") > 7, "stale")
    return j.select("family", why.alias("why")).where("why is not null")


@query("""WITH p AS (SELECT page_id, url, coalesce(CASE WHEN contains(url, '/1') THEN 'one' WHEN contains(url, '/2') THEN 'two' END, 'other') AS root FROM pages), k AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY url, page_id) AS k FROM p)
SELECT root, page_id, url, CAST(k AS INTEGER) AS k FROM k WHERE k <= 5""")
def staged_files(spark, sf_dir):
    """Files by content root, the first five of each."""
    u = F.col("url")
    root = F.coalesce(F.when(F.contains(u, F.lit("/1")), "one").when(F.contains(u, F.lit("/2")), "two"), F.lit("other"))
    w = Window.partitionBy("root").orderBy("url", "page_id")
    return read(spark, sf_dir, "pages").select("page_id", "url", root.alias("root")).withColumn("k", F.row_number().over(w)).where("k <= 5").select("root", "page_id", "url", "k")


@query("""SELECT doc_id, substr(sha256(concat_ws(':', source, lang, coalesce(text, ''))), 1, 16) AS example_id, substr(sha256(coalesce(text, '')), 1, 16) AS provenance, sha256(concat('{"lang":"', lang, '","source":"', source, '"}')) AS request FROM documents""")
def stable_hashes(spark, sf_dir):
    """Ids of examples, of code and of requests: hashes over fixed orders of fields, JSON with sorted keys."""
    text = F.coalesce("text", F.lit(""))
    short = lambda x: F.substring(F.sha2(x, 256), 1, 16)
    return read(spark, sf_dir, "documents").select("doc_id", short(F.concat_ws(":", "source", "lang", text)).alias("example_id"), short(text).alias("provenance"), F.sha2(F.to_json(F.struct("lang", "source")), 256).alias("request"))


@query("""WITH k AS (SELECT conv_id, turn, sha256(concat(conv_id, ':', turn)) AS key, text FROM conversations), c AS (SELECT DISTINCT sha256(concat(conv_id, ':', turn)) AS key, min(text) OVER (PARTITION BY conv_id, turn) AS answer FROM conversations WHERE turn % 2 = 0)
SELECT k.conv_id, k.turn, c.answer, c.key IS NULL AS miss FROM k LEFT JOIN c ON c.key = k.key""")
def cassette_replay(spark, sf_dir):
    """Recorded answers by request key, and the requests that have none."""
    c = read(spark, sf_dir, "conversations").withColumn("key", F.sha2(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")), 256))
    tape = c.where("turn % 2 = 0").groupBy("key").agg(F.min("text").alias("answer")).withColumn("hit", F.lit(True))
    return c.select("conv_id", "turn", "key").join(tape, "key", "left").select("conv_id", "turn", "answer", F.col("hit").isNull().alias("miss"))


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN NULL ELSE text END AS code FROM documents), p AS (SELECT page_id, html FROM pages)
SELECT doc_id, coalesce(nullif(code, ''), html, '') AS code, CASE WHEN nullif(code, '') IS NOT NULL THEN 'own' WHEN html IS NOT NULL THEN 'backfilled' ELSE 'missing' END AS origin FROM d LEFT JOIN p ON page_id = doc_id""")
def code_backfill(spark, sf_dir):
    """Examples without code get what was fetched for them. Only those that need it are joined."""
    k = F.col("doc_id")
    d = read(spark, sf_dir, "documents").select("doc_id", F.nullif(F.when(k % 4 == 0, "").when(k % 4 == 1, None).otherwise(F.col("text")), F.lit("")).alias("code"))
    got = read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "html")
    filled = d.where("code is null").join(got, "doc_id", "left").select("doc_id", F.coalesce("html", F.lit("")).alias("code"), F.when(F.col("html").isNull(), "missing").otherwise("backfilled").alias("origin"))
    return d.where("code is not null").select("doc_id", "code", F.lit("own").alias("origin")).unionByName(filled)


@query("""WITH u AS (SELECT vec_id, label, CASE WHEN label % 3 = 0 THEN 'fixed_examples' ELSE 'original_examples' END AS c FROM embeddings UNION ALL SELECT vec_id, label + 1, 'fixed_examples' FROM embeddings WHERE vec_id % 5 = 0)
SELECT vec_id, min(c) AS collection, count(*) AS copies, CAST(max(label) AS BIGINT) AS label FROM u GROUP BY 1""")
def vector_lookup(spark, sf_dir):
    """Two collections of vectors as one: the first hit by collection, the number of copies and the highest label of each id."""
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"))
    u = e.withColumn("c", F.when(F.col("label") % 3 == 0, "fixed_examples").otherwise("original_examples")).unionByName(e.where("vec_id % 5 = 0").select("vec_id", (F.col("label") + 1).alias("label"), F.lit("fixed_examples").alias("c")))
    return u.groupBy("vec_id").agg(F.min("c").alias("collection"), F.count("*").alias("copies"), F.max("label").alias("label"))


@query("""WITH r AS (SELECT o_custkey % 20 AS run, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS verified, count(*) FILTER (o_orderstatus = 'O') AS failed FROM orders GROUP BY 1)
SELECT run, total, verified, failed, greatest(0, total - verified - failed) AS skipped, round((verified / total)::DOUBLE, 4) AS rate FROM r""")
def evidence_manifest(spark, sf_dir):
    s, n = F.col("o_orderstatus"), F.count("*")
    r = read(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 20).alias("run")).agg(n.alias("total"), F.count_if(s == "F").alias("verified"), F.count_if(s == "O").alias("failed"))
    return r.select("run", "total", "verified", "failed", F.greatest(F.lit(0), F.col("total") - F.col("verified") - F.col("failed")).alias("skipped"), F.round(F.col("verified") / F.col("total"), 4).alias("rate"))


@query("""WITH a AS (SELECT user_id, count(*) AS attempts, max_by(event_type, struct_pack(ts := ts, id := event_id)) AS last, max_by(substr(props, 1, 1000), struct_pack(ts := ts, id := event_id)) AS output FROM events GROUP BY 1)
SELECT c_custkey, coalesce(attempts, 0) AS attempts, last, output FROM customer LEFT JOIN a ON user_id = c_custkey""")
def failure_export(spark, sf_dir):
    """Each example with its attempts and the last one, cut to 1,000 characters: max_by in place of a query a row."""
    at = F.struct("ts", "event_id")
    a = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("attempts"), F.max_by("event_type", at).alias("last"), F.max_by(F.substring("props", 1, 1000), at).alias("output"))
    return read(spark, sf_dir, "customer").select("c_custkey").join(a, "c_custkey", "left").select("c_custkey", F.coalesce("attempts", F.lit(0)).alias("attempts"), "last", "output")


@query("""WITH c AS (SELECT n_nationkey AS family, n_nationkey * 3 % 50 AS claimed FROM nation), r AS (SELECT s_nationkey AS family, count(*) AS n FROM supplier GROUP BY 1) SELECT c.family, claimed, coalesce(n, 0) AS reported, abs(claimed - coalesce(n, 0)) <= 2 AS holds FROM c LEFT JOIN r ON r.family = c.family""")
def claims_checked(spark, sf_dir):
    """Claimed figures against the report's, within a tolerance of 2."""
    c = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("family"), (F.col("n_nationkey") * 3 % 50).cast("long").alias("claimed"))
    r = read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").cast("long").alias("family")).agg(F.count("*").alias("n"))
    j = c.join(r, "family", "left").select("family", "claimed", F.coalesce("n", F.lit(0)).alias("reported"))
    return j.withColumn("holds", F.abs(F.col("claimed") - F.col("reported")) <= 2)


@query("SELECT doc_id, source FROM documents d WHERE lang = 'en' AND NOT EXISTS (SELECT 1 FROM pages p WHERE p.page_id = d.doc_id)")
def missing_files(spark, sf_dir):
    """Verified rows whose file is gone."""
    d = read(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", "source")
    return d.join(read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id")), "doc_id", "left_anti")


@query("""WITH a AS (SELECT user_id, count(*) AS n, max_by(event_type, struct_pack(ts := ts, id := event_id)) AS last, bool_or(event_type = 'error') AS failed FROM events GROUP BY 1)
SELECT user_id, CASE WHEN n = 1 THEN 'first_try' WHEN last = 'purchase' THEN 'llm' WHEN last = 'click' THEN 'fixture' WHEN failed THEN 'deterministic' ELSE 'other' END AS outcome, n FROM a""")
def commit_outcome(spark, sf_dir):
    """How an example was mended: at the first try, or by what its last attempt was."""
    at = F.struct("ts", "event_id")
    a = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.max_by("event_type", at).alias("last"), F.bool_or(F.col("event_type") == "error").alias("failed"))
    return a.select("user_id", F.when(F.col("n") == 1, "first_try").when(F.col("last") == "purchase", "llm").when(F.col("last") == "click", "fixture").when(F.col("failed"), "deterministic").otherwise("other").alias("outcome"), "n")


@query("SELECT conv_id, turn, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, lower(text) ORDER BY turn, role) = 1")
def distinct_issues(spark, sf_dir):
    """Issues with the same description count once, as the first."""
    first = F.min(F.struct("turn", "role", "text"))
    g = read(spark, sf_dir, "conversations").groupBy("conv_id", F.lower("text")).agg(first.alias("x"))
    return g.select("conv_id", "x.turn", "x.text")


@query("""WITH s AS (SELECT user_id, event_id, event_type = 'error' AS bad, value AS ms, row_number() OVER w AS i FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
x AS (SELECT *, avg(CASE WHEN bad THEN 1.0 ELSE 0.0 END) OVER v AS rate, count(*) OVER v AS n, avg(ms) OVER v AS latency, min(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 1 AND i >= 3 AS row3 FROM s WINDOW v AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT event_id, row3 OR (rate > 0.5 AND n >= 5) OR (latency > 30 AND n >= 2) AS open FROM x""")
def rolling_error_rate(spark, sf_dir):
    """The breaker's three rules over the last ten calls: three failures in a row, over half of five or more, or a mean latency above 30 in two or more."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    v, three = w.rowsBetween(-9, 0), w.rowsBetween(-2, 0)
    bad = (F.col("event_type") == "error").cast("int")
    e = read(spark, sf_dir, "events").select("event_id", F.avg(bad).over(v).alias("rate"), F.count("*").over(v).alias("n"), F.avg("value").over(v).alias("latency"), (F.sum(bad).over(three) == 3).alias("row3"))
    return e.select("event_id", (F.col("row3") | ((F.col("rate") > 0.5) & (F.col("n") >= 5)) | ((F.col("latency") > 30) & (F.col("n") >= 2))).alias("open"))


@query("""WITH c AS (SELECT o_custkey % 200 AS example, o_orderkey, o_orderpriority LIKE '1%' AS cs_file, substr(coalesce(CAST(o_totalprice AS VARCHAR), ''), 1, 500) AS code FROM orders) SELECT example, o_orderkey, code FROM c WHERE cs_file QUALIFY row_number() OVER (PARTITION BY example ORDER BY o_orderkey) <= 2""")
def few_shots(spark, sf_dir):
    """The first two examples that come from source files, each cut to 500 characters."""
    o = read(spark, sf_dir, "orders").where(F.col("o_orderpriority").startswith("1")).select((F.col("o_custkey") % 200).alias("example"), "o_orderkey", F.substring(F.col("o_totalprice").cast("string"), 1, 500).alias("code"))
    return t.newest(o, ["example"], [F.col("o_orderkey")], 2)


@query(f"""SELECT doc_id, list_filter(n, lambda z: z IN ('Acme.Docs', 'Acme.Codes') OR starts_with(z, 'System') OR starts_with(z, 'Microsoft') OR starts_with(z, 'Newtonsoft')) AS kept FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN ['System.IO', 'Acme.Gone', 'Acme.Docs'] WHEN 1 THEN ['Newtonsoft.Json', 'Other'] ELSE CAST([] AS VARCHAR[]) END AS n FROM documents)""")
def default_usings(spark, sf_dir):
    """Configured namespaces that the catalogue has, or that begin like a platform's."""
    k = F.col("doc_id") % 3
    n = F.when(k == 0, F.array(*map(F.lit, ("System.IO", "Acme.Gone", "Acme.Docs")))).when(k == 1, F.array(F.lit("Newtonsoft.Json"), F.lit("Other"))).otherwise(F.array().cast("array<string>"))
    kept = F.filter(n, lambda z: z.isin("Acme.Docs", "Acme.Codes") | z.rlike("^(?:System|Microsoft|Newtonsoft)"))
    return read(spark, sf_dir, "documents").select("doc_id", kept.alias("kept"))


@query("""WITH s AS (SELECT o_custkey % 40 AS run, o_orderkey AS key, o_orderstatus AS status FROM orders), c AS (SELECT run, status, count(*) AS n FROM s GROUP BY 1, 2)
SELECT s.run, count(*) AS total, sha256(string_agg(CAST(key AS VARCHAR), chr(10) ORDER BY CAST(key AS VARCHAR))) AS selection_hash, (SELECT string_agg(concat(c.status, '=', c.n), ',' ORDER BY c.status) FROM c WHERE c.run = s.run) AS statuses, round((count(*) FILTER (status = 'F') / count(*))::DOUBLE, 4) AS rate FROM s GROUP BY 1""")
def results_summary(spark, sf_dir):
    """A run's examples in one line: how many, their selection's hash, their states and the share verified."""
    o = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("run"), F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderstatus").alias("status"))
    c = o.groupBy("run", "status").agg(F.count("*").alias("n"))
    told = c.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("status", F.concat_ws("=", "status", F.col("n").cast("string")).alias("s")))).alias("s"))
    g = o.groupBy("run").agg(F.count("*").alias("total"), F.round(F.avg((F.col("status") == "F").cast("double")), 4).alias("rate"))
    return g.join(told, "run").join(t.ordered_hash(o, "run", "key", "selection_hash"), "run").select("run", "total", "selection_hash", F.array_join(F.transform("s", lambda x: x["s"]), ",").alias("statuses"), "rate")


@query("""WITH e AS (SELECT user_id, event_type AS phase, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS done FROM events)
SELECT phase, count(*) AS n, count(*) FILTER (done IS NULL) AS unfinished, CAST(sum(coalesce(date_diff('millisecond', ts, done), 0)) AS BIGINT) AS total_ms, max(date_diff('millisecond', ts, done)) AS longest_ms FROM e GROUP BY 1""")
def phase_timing(spark, sf_dir):
    """How long phases took, those without an end included: a phase ends where the next one of its run begins."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("phase"), "ts", F.lead("ts").over(w).alias("done"))
    ms = lambda x: F.unix_millis(x.cast("timestamp"))
    took = ms(F.col("done")) - ms(F.col("ts"))
    return e.groupBy("phase").agg(F.count("*").alias("n"), F.count_if(F.col("done").isNull()).alias("unfinished"), F.sum(F.coalesce(took, F.lit(0))).alias("total_ms"), F.max(took).alias("longest_ms"))


@query("""WITH v AS (SELECT user_id % 8 AS family, value / 100.0 AS x FROM events), h AS (SELECT family, count(*) FILTER (x < 0.1) AS low, count(*) FILTER (x >= 0.1 AND x < 0.7) AS mid, count(*) FILTER (x >= 0.7 AND x <= 1.0) AS high FROM v GROUP BY 1)
SELECT v.family, count(*) AS n, round(avg(x)::DOUBLE, 6) AS mean, round(quantile_cont(x, 0.5)::DOUBLE, 6) AS median, round(quantile_cont(x, 0.95)::DOUBLE, 6) AS p95, max(low) AS low, max(mid) AS mid, max(high) AS high FROM v JOIN h ON h.family = v.family GROUP BY 1""")
def drift_metrics(spark, sf_dir):
    """Statistics and a coarse histogram of a family's drift in one row."""
    v = read(spark, sf_dir, "events").select((F.col("user_id") % 8).alias("family"), (F.col("value") / 100.0).alias("x"))
    x = F.col("x")
    q = t.quantiles(v, "family", "x", {"median": 0.5, "p95": 0.95})
    g = v.groupBy("family").agg(F.count("*").alias("n"), F.round(F.avg(x), 6).alias("mean"), F.count_if(x < 0.1).alias("low"), F.count_if((x >= 0.1) & (x < 0.7)).alias("mid"), F.count_if((x >= 0.7) & (x <= 1.0)).alias("high"))
    return g.join(q, "family").select("family", "n", "mean", F.round("median", 6).alias("median"), F.round("p95", 6).alias("p95"), "low", "mid", "high")


@query("""WITH g AS (SELECT page_id AS id, unnest(['main.cs', concat('part', page_id % 3, '.cs')]) AS file, html FROM pages), a AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('part', doc_id % 3, '.cs') ELSE NULL END AS wanted FROM documents)
SELECT a.doc_id, a.wanted, coalesce(e.file, f.file) AS file, strlen(coalesce(e.html, f.html)) AS bytes, f.id IS NULL AS missing FROM a LEFT JOIN g e ON e.id = a.doc_id AND e.file = a.wanted LEFT JOIN (SELECT id, min(file) AS file, any_value(html) AS html FROM g GROUP BY 1) f ON f.id = a.doc_id""")
def gist_resolution(spark, sf_dir):
    """Shared files from a local table of them: the named one, else the first; what isn't there is missing."""
    p = read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.octet_length("html").alias("bytes"), F.array(F.lit("main.cs"), F.concat(F.lit("part"), (F.col("page_id") % 3).cast("string"), F.lit(".cs"))).alias("files"))
    k = F.col("doc_id")
    d = read(spark, sf_dir, "documents").select("doc_id", F.when(k % 2 == 0, F.concat(F.lit("part"), (k % 3).cast("string"), F.lit(".cs"))).alias("wanted")).join(p, "doc_id", "left")
    named = F.when(F.array_contains("files", F.col("wanted")), F.col("wanted"))
    return d.select("doc_id", "wanted", F.coalesce(named, F.array_min("files")).alias("file"), F.col("bytes").cast("long").alias("bytes"), F.col("files").isNull().alias("missing"))


@query("""SELECT doc_id, concat('repo_', source, '_', lower(regexp_replace(concat('File ', lang, ' ', doc_id), '[^A-Za-z0-9]+', '-', 'g'))) AS id, CASE WHEN doc_id % 3 = 0 THEN 'cs_file' ELSE 'markdown' END AS origin, length(coalesce(text, '')) AS chars FROM documents WHERE coalesce(text, '') <> ''""")
def vector_bulk_load(spark, sf_dir):
    """Files as rows of a vector collection: an id from repository, family and stem, and their metadata; empty ones are left out."""
    text = F.coalesce("text", F.lit(""))
    stem = F.lower(F.regexp_replace(F.concat(F.lit("File "), "lang", F.lit(" "), F.col("doc_id").cast("string")), "[^A-Za-z0-9]+", "-"))
    d = read(spark, sf_dir, "documents").where(text != "")
    return d.select("doc_id", F.concat(F.lit("repo_"), "source", F.lit("_"), stem).alias("id"), F.when(F.col("doc_id") % 3 == 0, "cs_file").otherwise("markdown").alias("origin"), F.length(text).cast("long").alias("chars"))


@query("""SELECT key, coalesce(family, overall, fallback) AS value FROM (SELECT n_nationkey AS key, CASE WHEN n_nationkey % 3 = 0 THEN concat('f', n_nationkey) END AS family, CASE WHEN n_nationkey % 2 = 0 THEN concat('g', n_nationkey) END AS overall, 'default' AS fallback FROM nation)""")
def effective_config(spark, sf_dir):
    """A setting from the family, else the global one, else the default."""
    k = F.col("n_nationkey")
    return read(spark, sf_dir, "nation").select(k.alias("key"), F.coalesce(F.when(k % 3 == 0, F.concat(F.lit("f"), k.cast("string"))), F.when(k % 2 == 0, F.concat(F.lit("g"), k.cast("string"))), F.lit("default")).alias("value"))


@query("""SELECT c_custkey, coalesce(nullif(c_name, ''), nullif(c_mktsegment, ''), '') AS current, c_acctbal > 0 AS verified FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END, ''), c_mktsegment, ''), false FROM customer WHERE c_custkey % 2 = 1""")
def current_code(spark, sf_dir):
    """The best version there is of each example; an empty one counts as missing."""
    k = F.col("c_custkey")
    first = F.when((k % 2 == 1) & (k % 3 == 0), "").otherwise(F.col("c_name"))
    return read(spark, sf_dir, "customer").select("c_custkey", F.coalesce(F.nullif(first, F.lit("")), F.nullif("c_mktsegment", F.lit("")), F.lit("")).alias("current"), ((k % 2 == 0) & (F.col("c_acctbal") > 0)).alias("verified"))
