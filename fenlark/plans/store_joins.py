"""Reads of a store that join its tables, and the changes and reports that rest on them, over all runs at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tabular as t
from ..operators.scratch import folder
from ..store import Store
from .base import query
from .store_reads import _duck, _rows, _stored

# The records, as projections of the given tables that both dialects read.
_EXAMPLES = """SELECT CAST(p_partkey AS VARCHAR(12)) AS example_id, p_brand AS family, p_name AS example_key, concat(p_type, '/', CAST(p_size AS VARCHAR(9))) AS file_path,
 CASE p_size % 5 WHEN 0 THEN 'aspnet_core_minimal' WHEN 1 THEN 'aspnet_core_mvc' WHEN 2 THEN 'console' WHEN 3 THEN 'aspnet_core_webapi' END AS app_context, CASE p_size % 4 WHEN 0 THEN 'gist' ELSE 'inline' END AS source_type,
 CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 11 <> 0 THEN p_name END AS code_block_signature, CASE p_size % 3 WHEN 0 THEN -1 ELSE p_size END AS block_index, CASE WHEN p_size % 13 = 0 THEN 'short' END AS extraction_warning,
 CASE p_size % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'A' ELSE p_name END AS original_code FROM {part}"""
_STATES = """SELECT CAST(l_suppkey AS VARCHAR(9)) AS run_id, CAST(l_partkey AS VARCHAR(12)) AS example_id,
 CASE concat(l_returnflag, l_linestatus) WHEN 'RF' THEN 'COMPILE_FAILED' WHEN 'RO' THEN 'RUNTIME_FAILED' WHEN 'AF' THEN 'VERIFIED' WHEN 'AO' THEN 'COMMITTED' WHEN 'NF' THEN 'FINAL_REVIEW_PASSED' ELSE 'NEEDS_REVIEW' END AS status,
 CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_quantity > 40 THEN 'context_drift_detected' ELSE 'other' END END AS failure_reason,
 CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN l_returnflag END AS compilable_code, l_extendedprice AS updated_at FROM {lineitem}"""
_RUNS = "SELECT CAST(s_suppkey AS VARCHAR(9)) AS run_id, CAST(s_nationkey % 5 AS VARCHAR(9)) AS family, s_acctbal AS started_at FROM {supplier}"
_REVIEWS = "SELECT CAST(c_custkey AS VARCHAR(12)) AS review_id, c_mktsegment AS file_path, c_acctbal > 0 AS approved FROM {customer}"
_ISSUES = "SELECT CAST(o_orderkey AS VARCHAR(12)) AS issue_id, CAST(o_custkey AS VARCHAR(12)) AS review_id, o_orderpriority AS severity, o_totalprice AS created_at FROM {orders}"
_PATTERNS = "SELECT CAST(p_partkey AS VARCHAR(12)) AS pattern_id, p_brand AS family, CASE p_size % 9 WHEN 0 THEN 'retired_low' ELSE 'mined' END AS source, p_size % 6 = 0 AS auto_approved FROM {part}"

# Rows that repeat a key: the latest counts, as in the store.
_ER = _duck(_EXAMPLES)
_ERS = f"(SELECT * FROM {_duck(_STATES)} QUALIFY row_number() OVER (PARTITION BY run_id, example_id ORDER BY updated_at DESC, status DESC, failure_reason DESC NULLS LAST, compilable_code DESC NULLS LAST) = 1)"
FAILED = ["COMPILE_FAILED", "RUNTIME_FAILED", "INFRA_BLOCKED"]
ASPNET = ["aspnet_core_minimal", "aspnet_core_mvc", "aspnet_core_webapi"]


def _states(spark, sf_dir, examples: bool = True) -> Store:
    store = _stored(spark, sf_dir, "example_run_state", _STATES, "updated_at")
    if examples:
        store.write("example", _rows(spark, sf_dir, _EXAMPLES))
    return store


@query(f"SELECT ers.run_id, ers.example_id, status, family, file_path, original_code FROM {_ERS} ers JOIN {_ER} er ON ers.example_id = er.example_id WHERE status = 'NEEDS_REVIEW' AND family IN ('Brand#13', 'Brand#25')")
def stored_states_of_families(spark, sf_dir):
    """States of some families' examples that wait for a review, with what is recorded of the examples."""
    found = _states(spark, sf_dir).joined("run_states_by_family", status="NEEDS_REVIEW", family=["Brand#13", "Brand#25"])
    return found.select("run_id", "example_id", "status", "family", "file_path", "original_code")


@query(f"SELECT run_id, ers.example_id, status, failure_reason, compilable_code, original_code, source_type FROM {_ERS} ers JOIN {_ER} er ON ers.example_id = er.example_id WHERE status IN ('COMPILE_FAILED', 'RUNTIME_FAILED', 'INFRA_BLOCKED')")
def stored_failed_examples(spark, sf_dir):
    return _states(spark, sf_dir).joined("run_examples", status=FAILED).select("run_id", "example_id", "status", "failure_reason", "compilable_code", "original_code", "source_type")


@query(f"SELECT run_id, ers.example_id, family, original_code, compilable_code FROM {_ERS} ers JOIN {_ER} er ON ers.example_id = er.example_id WHERE compilable_code IS NOT NULL AND compilable_code <> '' AND original_code IS NOT NULL AND original_code <> compilable_code")
def stored_fixed_examples(spark, sf_dir):
    """Examples whose code a fix changed."""
    found = _states(spark, sf_dir).joined("run_examples").where("compilable_code <> '' and original_code <> compilable_code")
    return found.select("run_id", "example_id", "family", "original_code", "compilable_code")


@query(f"SELECT run_id, family, status, count(*) AS n, count(*) FILTER (coalesce(original_code, '') <> '') AS with_original, count(*) FILTER (coalesce(compilable_code, '') <> '') AS with_compilable FROM {_ERS} ers JOIN {_ER} er ON ers.example_id = er.example_id GROUP BY 1, 2, 3")
def stored_run_artifacts(spark, sf_dir):
    """A run's examples by family and state, and how many have code."""
    has = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    found = _states(spark, sf_dir).joined("run_examples").groupBy("run_id", "family", "status")
    return found.agg(F.count("*").alias("n"), has("original_code").alias("with_original"), has("compilable_code").alias("with_compilable"))


@query(f"""WITH s AS (SELECT run_id, file_path LIKE '%/1%' OR file_path LIKE '%/2%' AS real FROM {_ERS} ers JOIN {_ER} er ON ers.example_id = er.example_id WHERE status = 'COMMITTED')
SELECT run_id, count(*) AS committed, count(*) FILTER (NOT real) AS phantoms, count(*) FILTER (real) AS remaining FROM s GROUP BY 1""")
def stored_phantom_commits(spark, sf_dir):
    """Commits of examples whose files no commit holds are taken back to the review they passed: how many there were, how
    many were phantoms, and how many the table holds afterwards."""
    store = _states(spark, sf_dir)
    files = _rows(spark, sf_dir, _EXAMPLES).where("file_path like '%/1%' or file_path like '%/2%'").select("file_path").distinct()
    before = store.joined("run_examples", status="COMMITTED")
    gone = before.join(files, "file_path", "left_anti").select(store.columns("example_run_state"))
    counts = before.groupBy("run_id").agg(F.count("*").alias("committed")).join(gone.groupBy("run_id").agg(F.count("*").alias("phantoms")), "run_id", "left")
    store.write("example_run_state", gone.withColumn("status", F.lit("FINAL_REVIEW_PASSED")))
    after = store.joined("run_examples", status="COMMITTED").groupBy("run_id").agg(F.count("*").alias("remaining"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return counts.join(after, "run_id", "left").select("run_id", "committed", zero("phantoms"), zero("remaining"))


@query(f"""WITH r AS (SELECT r.family, r.run_id, started_at, count(*) FILTER (status = 'FINAL_REVIEW_PASSED') AS verified, count(*) AS total FROM {_duck(_RUNS)} r JOIN {_ERS} ers ON r.run_id = ers.run_id GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY started_at DESC, run_id DESC) AS k FROM r)
SELECT a.family, a.run_id AS latest, b.run_id AS previous, a.verified - b.verified AS improvement, round(100.0 * a.verified / a.total - 100.0 * b.verified / b.total, 6) AS rate_delta FROM k a JOIN k b ON a.family = b.family AND a.k = 1 AND b.k = 2""")
def stored_run_comparison(spark, sf_dir):
    """A family's last two runs that have examples: how many more passed, and by how much the rate changed."""
    store = _states(spark, sf_dir, examples=False)
    store.write("run", _rows(spark, sf_dir, _RUNS))
    runs = store.joined("states_of_runs").groupBy("family", "run_id", "started_at").agg(F.count_if(F.col("status") == "FINAL_REVIEW_PASSED").alias("verified"), F.count("*").alias("total"))
    two = t.newest(runs, ["family"], [F.desc("started_at"), F.desc("run_id")], 2)
    ends = two.groupBy("family").agg(*(f(F.struct("started_at", "run_id", "verified", "total")).alias(n) for n, f in (("a", F.max), ("b", F.min))), F.count("*").alias("n")).where("n = 2")
    share = lambda x: 100.0 * F.col(f"{x}.verified") / F.col(f"{x}.total")
    return ends.select("family", F.col("a.run_id").alias("latest"), F.col("b.run_id").alias("previous"), (F.col("a.verified") - F.col("b.verified")).alias("improvement"), F.round(share("a") - share("b"), 6).alias("rate_delta"))


@query(f"""WITH s AS (SELECT run_id, app_context, status, failure_reason FROM {_ERS} ers LEFT JOIN {_ER} er ON ers.example_id = er.example_id), c AS (SELECT *, coalesce(app_context IN ('aspnet_core_minimal', 'aspnet_core_mvc', 'aspnet_core_webapi'), false) AS web FROM s)
SELECT run_id, count(*) AS examples, count(*) FILTER (web) AS aspnet, count(*) FILTER (web AND status IN ('VERIFIED', 'RUNTIME_FAILED')) AS compiled, count(*) FILTER (web AND status = 'COMPILE_FAILED') AS not_compiled,
 count(*) FILTER (failure_reason = 'context_drift_detected' AND app_context IS NOT NULL) AS violations, count(*) FILTER (failure_reason = 'context_drift_detected') AS rejections FROM c GROUP BY 1""")
def stored_context_checks(spark, sf_dir):
    """Each run's checks of contexts: web examples that compile, contexts that changed, fixes refused for that. States
    without a recorded example count for what their own row says."""
    web, drift = F.coalesce(F.col("app_context").isin(*ASPNET), F.lit(False)), F.coalesce(F.col("failure_reason") == "context_drift_detected", F.lit(False))
    n = {"examples": F.lit(True), "aspnet": web, "compiled": web & F.col("status").isin("VERIFIED", "RUNTIME_FAILED"), "not_compiled": web & (F.col("status") == "COMPILE_FAILED"), "violations": drift & F.col("app_context").isNotNull(), "rejections": drift}
    return _states(spark, sf_dir).joined("states_in_context").groupBy("run_id").agg(*(F.count_if(hit).alias(name) for name, hit in n.items()))


@query(f"""WITH s AS (SELECT run_id, source_type = 'inline' AS inline, coalesce(code_block_signature, '') <> '' AS signed, coalesce(block_index, -1) >= 0 AS placed, coalesce(extraction_warning, '') <> '' AS warned FROM {_ERS} ers JOIN {_ER} er ON ers.example_id = er.example_id WHERE status = 'VERIFIED')
SELECT run_id, count(*) AS verified, count(*) FILTER (NOT inline OR (signed AND placed)) AS valid, count(*) FILTER (inline AND NOT signed) AS missing_signature, count(*) FILTER (inline AND NOT placed) AS missing_block_index, count(*) FILTER (warned) AS warned, bool_and(NOT inline OR (signed AND placed)) AS all_valid FROM s GROUP BY 1""")
def stored_signature_checks(spark, sf_dir):
    """Whether a run's verified examples can be found again in their files: inline ones need a signature and a place."""
    inline, signed, placed = F.col("source_type") == "inline", F.coalesce("code_block_signature", F.lit("")) != "", F.coalesce("block_index", F.lit(-1)) >= 0
    fine, warned = ~inline | (signed & placed), F.coalesce("extraction_warning", F.lit("")) != ""
    n = {"valid": fine, "missing_signature": inline & ~signed, "missing_block_index": inline & ~placed, "warned": warned}
    found = _states(spark, sf_dir).joined("run_examples", status="VERIFIED").groupBy("run_id")
    return found.agg(F.count("*").alias("verified"), *(F.count_if(hit).alias(name) for name, hit in n.items()), F.bool_and(fine).alias("all_valid"))


@query(f"SELECT run_id, n FROM (SELECT run_id, count(*) AS n FROM {_ERS} GROUP BY 1) QUALIFY row_number() OVER (ORDER BY n DESC, run_id) = 1")
def stored_primary_run(spark, sf_dir):
    """The run with the most examples; of several the first by name."""
    return _states(spark, sf_dir, examples=False).count_by("example_run_state", "run_id").orderBy(F.desc("n"), "run_id").limit(1)


@query(f"""SELECT r.review_id, file_path, approved, CAST(coalesce(list(issue_id ORDER BY created_at, issue_id) FILTER (issue_id IS NOT NULL), []) AS VARCHAR[]) AS issues FROM {_duck(_REVIEWS)} r LEFT JOIN {_duck(_ISSUES)} i ON i.review_id = r.review_id GROUP BY 1, 2, 3""")
def stored_reviews(spark, sf_dir):
    """Reviews with their issues in the order they were found; those without any have an empty list."""
    store = _stored(spark, sf_dir, "review_result", _REVIEWS)
    store.write("review_issue", _rows(spark, sf_dir, _ISSUES))
    lists = store.find("issues_of_review").groupBy("review_id").agg(F.array_sort(F.collect_list(F.struct("created_at", "issue_id"))).alias("found"))
    none = F.array().cast("array<string>")
    return store.table("review_results").join(lists, "review_id", "left").select("review_id", "file_path", "approved", F.coalesce(F.col("found.issue_id"), none).alias("issues"))


@query(f"""WITH p AS (SELECT CAST(l_partkey AS VARCHAR) AS pattern_id, count(*) AS applied, count(*) FILTER (l_linestatus = 'F') AS worked FROM lineitem WHERE l_partkey % 3 > 0 GROUP BY 1),
s AS (SELECT lp.pattern_id, family, coalesce(applied, 0) AS applied, coalesce(worked, 0) AS worked, coalesce(round(worked / applied, 6), 0.0) AS rate FROM {_duck(_PATTERNS)} lp LEFT JOIN p ON p.pattern_id = lp.pattern_id WHERE NOT auto_approved AND NOT starts_with(source, 'retired_'))
SELECT *, CASE WHEN applied >= 3 AND rate >= 0.8 THEN 'approve' WHEN applied >= 10 AND rate <= 0.1 THEN 'retire' ELSE 'review' END AS decision FROM s""")
def stored_pattern_reviews(spark, sf_dir):
    """Pending patterns with what came of them, their rates written by an update, and what is to be done with each."""
    store = _stored(spark, sf_dir, "learned_pattern", _PATTERNS)
    name = "SELECT CAST(l_partkey AS VARCHAR(12)) AS pattern_id, l_linestatus AS status FROM {lineitem}"
    uses = _rows(spark, sf_dir, name).where("cast(pattern_id as long) % 3 > 0").groupBy("pattern_id").agg(F.count("*").alias("applied"), F.count_if(F.col("status") == "F").alias("worked"))
    store.write("pattern_result", uses.withColumn("rate", F.lit(0.0)))
    store.update("pattern_performance", F.col("applied") > 0, rate=F.round(F.col("worked") / F.col("applied"), 6))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    found = store.joined("pattern_results").where("not auto_approved and not startswith(source, 'retired_')").select("pattern_id", "family", zero("applied"), zero("worked"), F.coalesce("rate", F.lit(0.0)).alias("rate"))
    decision = F.when((F.col("applied") >= 3) & (F.col("rate") >= 0.8), "approve").when((F.col("applied") >= 10) & (F.col("rate") <= 0.1), "retire")
    return found.withColumn("decision", decision.otherwise("review"))
