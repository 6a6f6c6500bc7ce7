"""Reads and writes that the store declares, put to work on whole tables: what is written is found again by key, state and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.scratch import folder
from ..store import Store
from .base import query, read

# The records, as projections of the given tables that both dialects read.
_FAILURES = "SELECT event_id AS failure_id, CAST(user_id % 50 AS VARCHAR(9)) AS run_id, CAST(user_id AS VARCHAR(9)) AS example_id, CASE WHEN event_type = 'error' THEN 'timeout' WHEN event_type = 'view' THEN 'compile_error' ELSE 'other' END AS failure_category, 'pending' AS resolution, ts AS timestamp FROM {events}"
_STATES = "SELECT CAST(o_custkey % 50 AS VARCHAR(9)) AS run_id, CAST(o_orderkey AS VARCHAR(12)) AS example_id, CASE o_orderstatus WHEN 'F' THEN 'VERIFIED' WHEN 'O' THEN 'COMPILE_FAILED' ELSE 'NEEDS_REVIEW' END AS status, o_totalprice AS drift_score FROM {orders}"
_ATTEMPTS = "SELECT CAST(l_suppkey AS VARCHAR(9)) AS run_id, CAST(l_orderkey AS VARCHAR(12)) AS example_id, l_linenumber AS attempt_id, l_returnflag = 'N' AS success, l_shipdate AS timestamp FROM {lineitem}"
_RUNS = "SELECT CAST(c_custkey AS VARCHAR(12)) AS run_id, c_mktsegment AS family, CASE WHEN c_acctbal > 0 THEN 'completed' ELSE 'running' END AS status, c_acctbal AS started_at FROM {customer}"
_TIMINGS = "SELECT CAST(user_id AS VARCHAR(9)) AS run_id, event_type AS phase, ts AS started_at, value AS duration FROM {events}"
_PRINTS = "SELECT CAST(user_id AS VARCHAR(9)) AS run_id, event_type AS config_hash, CAST(event_id % 97 AS VARCHAR(9)) AS selection_hash, event_id AS created_at FROM {events}"
_REVIEWS = "SELECT CONCAT(conv_id, '-', turn) AS review_id, CAST(conv_id AS VARCHAR(12)) AS run_id, role AS file_path, length(text) AS issues, turn AS created_at FROM {conversations}"
_DRIFT = "SELECT CAST(doc_id AS VARCHAR(12)) AS example_id, source AS run_id, lang AS reason, n_chars AS created_at FROM {documents}"
_EXAMPLES = "SELECT CAST(p_partkey AS VARCHAR(12)) AS example_id, p_brand AS family, p_name AS example_key, p_type AS file_path, p_size AS created_at FROM {part}"
_PAGES = "SELECT CAST(page_id AS VARCHAR(12)) AS edit_id, split_part(url, '/', 3) AS file_path, length(html) AS size, page_id AS timestamp FROM {pages}"


def _rows(spark, sf_dir, text: str):
    name = text[text.rindex("{") + 1 : text.rindex("}")]
    return spark.sql(text, **{name: read(spark, sf_dir, name)})


def _duck(text: str) -> str:
    return "(" + text.replace("{", "").replace("}", "") + ")"


def _stored(spark, sf_dir, name: str, text: str, order: str | None = None) -> Store:
    store = Store(spark, folder(spark))
    store.write(name, _rows(spark, sf_dir, text), order)
    return store


@query(f"SELECT * FROM {_duck(_FAILURES)} WHERE failure_category = 'timeout'")
def stored_timeouts(spark, sf_dir):
    """Failures by a time-out, of all runs, newest first."""
    return _stored(spark, sf_dir, "failure_detail", _FAILURES).find("timeout_failures", failure_category="timeout")


@query(f"SELECT * FROM {_duck(_FAILURES)} WHERE run_id IN ('3', '5', '8', '13', '21', '34')")
def stored_failures_by_run(spark, sf_dir):
    return _stored(spark, sf_dir, "failure_detail", _FAILURES).find("failure_details_by_run", run_id=["3", "5", "8", "13", "21", "34"])


@query(f"SELECT failure_category, CASE WHEN failure_category = 'timeout' THEN 'fixed' ELSE resolution END AS resolution, count(*) AS n FROM {_duck(_FAILURES)} GROUP BY 1, 2")
def stored_resolutions(spark, sf_dir):
    """A resolution written over the pending ones of a category, and counted."""
    store = _stored(spark, sf_dir, "failure_detail", _FAILURES)
    store.update("failure_details", F.col("failure_category") == "timeout", resolution="fixed")
    return store.count_by("failure_details", "failure_category", "resolution")


@query(f"SELECT * FROM {_duck(_STATES)} WHERE status IN ('COMPILE_FAILED', 'NEEDS_REVIEW')")
def stored_run_states(spark, sf_dir):
    """States of all runs' examples that failed or wait for a review."""
    return _stored(spark, sf_dir, "example_run_state", _STATES).find("run_states_by_status", status=["COMPILE_FAILED", "NEEDS_REVIEW"])


@query(f"SELECT * FROM {_duck(_ATTEMPTS)} UNION ALL SELECT run_id, example_id, attempt_id + 100, NOT success, timestamp FROM {_duck(_ATTEMPTS)} WHERE NOT success")
def stored_attempts(spark, sf_dir):
    """Attempts appended twice: all, and once more those that failed."""
    store, rows = Store(spark, folder(spark)), _rows(spark, sf_dir, _ATTEMPTS)
    store.write("compile_attempt", rows)
    store.write("compile_attempt", rows.where("not success").withColumns({"attempt_id": F.col("attempt_id") + 100, "success": ~F.col("success")}))
    return store.find("compile_attempts")


@query(f"SELECT run_id, family, CASE WHEN status = 'running' THEN 'completed' ELSE status END AS status, started_at FROM {_duck(_RUNS)}")
def stored_completed_runs(spark, sf_dir):
    """Runs that were going on, completed by an upsert, which keeps when they began."""
    store, rows = Store(spark, folder(spark)), _rows(spark, sf_dir, _RUNS)
    store.write("run", rows)
    store.write("run", rows.where("status = 'running'").withColumns({"status": F.lit("completed"), "started_at": F.lit(-1e9)}))
    return store.find("recent_runs")


@query(f"SELECT DISTINCT ON (family) family, run_id, status, started_at FROM {_duck(_RUNS)} ORDER BY family, started_at DESC, run_id DESC")
def stored_latest_runs(spark, sf_dir):
    """The latest run of each family."""
    return _stored(spark, sf_dir, "run", _RUNS).newest("run_records", ["family"], "started_at").select("family", "run_id", "status", "started_at")


@query(f"SELECT run_id, phase, count(*) AS calls, round(sum(duration), 2) AS total FROM {_duck(_TIMINGS)} GROUP BY 1, 2")
def stored_phase_timings(spark, sf_dir):
    """Calls and time of each phase of a run."""
    return _stored(spark, sf_dir, "phase_timing", _TIMINGS).find("phase_timings").groupBy("run_id", "phase").agg(F.count("*").alias("calls"), F.round(F.sum("duration"), 2).alias("total"))


@query(f"SELECT DISTINCT ON (run_id) run_id, config_hash, selection_hash, created_at FROM {_duck(_PRINTS)} ORDER BY run_id, created_at DESC")
def stored_fingerprints(spark, sf_dir):
    """One fingerprint a run, the last that was written."""
    return _stored(spark, sf_dir, "run_fingerprint", _PRINTS, "created_at").find("fingerprints_by_config_hash")


@query(f"SELECT * FROM {_duck(_REVIEWS)} WHERE file_path = 'user'")
def stored_reviews_by_file(spark, sf_dir):
    return _stored(spark, sf_dir, "review_result", _REVIEWS).find("review_results_by_file", file_path="user")


@query(f"SELECT run_id, reason, count(*) AS n FROM {_duck(_DRIFT)} GROUP BY 1, 2")
def stored_drift_rejections(spark, sf_dir):
    return _stored(spark, sf_dir, "drift_rejection", _DRIFT).count_by("drift_rejections", "run_id", "reason")


@query(f"SELECT example_id, family, example_key, CASE WHEN family LIKE '%1' THEN 'moved' ELSE file_path END AS file_path, created_at FROM {_duck(_EXAMPLES)} WHERE family NOT LIKE '%2'")
def stored_examples(spark, sf_dir):
    """Examples that moved, and some deleted: location updates by family."""
    store = _stored(spark, sf_dir, "example", _EXAMPLES)
    store.update("example_records", F.col("family").like("%1"), file_path="moved")
    store.delete("example_records", F.col("family").like("%2"))
    return store.find("examples_by_family")


@query(f"SELECT file_path, count(*) AS edits, CAST(max(timestamp) AS BIGINT) AS last FROM {_duck(_PAGES)} GROUP BY 1")
def stored_edits(spark, sf_dir):
    """Edits by site, and the last one."""
    return _stored(spark, sf_dir, "markdown_edit", _PAGES).find("edits_by_file").groupBy("file_path").agg(F.count("*").alias("edits"), F.max("timestamp").alias("last"))


@query(f"SELECT run_id, example_id, status, drift_score FROM {_duck(_STATES)} WHERE run_id = '7' UNION ALL SELECT run_id, example_id, 'OLD', drift_score FROM {_duck(_STATES)} WHERE run_id = '8'")
def stored_run_copies(spark, sf_dir):
    """Runs copied to another store: one replaces what is there, the other one ignores it."""
    store, other = _stored(spark, sf_dir, "example_run_state", _STATES), Store(spark, folder(spark))
    other.write("example_run_state", store.table("example_run_state").where("run_id in ('7', '8')").withColumn("status", F.lit("OLD")))
    store.copy_run(other, "7", {"example_run_state": ("replace", ["run_id", "example_id"])})
    store.copy_run(other, "8", {"example_run_state": ("ignore", ["run_id", "example_id"])})
    return other.table("example_run_state")


BATCH = 200


@query(f"""SELECT o_orderkey AS work_id, CASE (k - 1) // {BATCH} % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS worker, CASE WHEN (k - 1) // {BATCH} = 0 THEN 'done' ELSE 'claimed' END AS status
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS k FROM orders WHERE o_orderstatus = 'P') WHERE k <= 4 * {BATCH}""")
def worker_claims(spark, sf_dir):
    """Four claims of a batch each by three workers in turn; the first one is finished. Who has what."""
    store = Store(spark, folder(spark))
    store.write("work_item", read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("work_id"), F.col("o_orderpriority").alias("priority"), F.lit("pending").alias("status")))
    for i, worker in enumerate("abca"):
        got = store.claim("work_queue", ["priority", "work_id"], worker, BATCH, now=float(i))
        if not i:
            store.finish("work_queue", [r["work_id"] for r in got], worker)
    return store.table("work_queue").where("worker is not null").select("work_id", "worker", "status")
