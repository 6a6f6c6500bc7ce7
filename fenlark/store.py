"""A store of record tables in Parquet, with the verbs that a run needs: look up, list, count, insert, update, claim, copy, migrate.

A table is a folder of data and of versions. A version is a small file that names the data folders of each
bucket of keys; a write adds data beside what there is and then the next version, which only one
writer can create. So a change reads and writes the buckets it touches, readers keep the version they
opened, and a write that is lost leaves nothing that a version names.
What is read and written by whom is declared in READS and WRITES.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .operators import tabular

# Named reads, as (table, key columns, order). A trailing - turns an order round.
READS = {
    "example": ("example_records", ["example_id"], []),
    "examples_by_family": ("example_records", ["family"], ["example_key", "example_id"]),
    "examples_by_file": ("example_records", ["file_path"], ["example_key", "example_id"]),
    "example_run_state": ("example_run_state", ["run_id", "example_id"], []),
    "run_states_by_status": ("example_run_state", ["run_id", "status"], ["example_id"]),
    "compile_attempts": ("compile_attempts", ["run_id", "example_id"], ["timestamp", "attempt_id"]),
    "runtime_attempts": ("runtime_attempts", ["run_id", "example_id"], ["timestamp", "attempt_id"]),
    "failure_details": ("failure_details", ["example_id"], ["timestamp-"]),
    "failure_details_by_run": ("failure_details", ["run_id"], ["timestamp-"]),
    "timeout_failures": ("failure_details", ["run_id", "failure_category"], ["timestamp-"]),
    "edits_by_file": ("markdown_edits", ["file_path"], ["timestamp-"]),
    "commit_records": ("commit_records", ["family"], ["timestamp-"]),
    "run": ("run_records", ["run_id"], []),
    "recent_runs": ("run_records", ["family"], ["started_at-"]),
    "telemetry_run": ("telemetry_runs", ["telemetry_id"], []),
    "telemetry_runs_by_run": ("telemetry_runs", ["run_id"], ["started_at-"]),
    "phase_timings": ("phase_timings", ["run_id"], ["started_at"]),
    "run_fingerprint": ("run_fingerprints", ["run_id"], []),
    "fingerprints_by_config_hash": ("run_fingerprints", ["config_hash"], ["created_at-"]),
    "fingerprints_by_selection_hash": ("run_fingerprints", ["selection_hash"], ["created_at-"]),
    "review_results": ("review_results", ["run_id"], ["created_at"]),
    "review_results_by_file": ("review_results", ["file_path"], ["created_at-"]),
    "drift_rejections": ("drift_rejections", ["example_id", "run_id"], ["created_at-"]),
    "semantic_signatures": ("semantic_signatures", ["example_id", "run_id"], ["created_at-"]),
    "run_manifest": ("run_manifests", ["run_id"], []),
    "issues_of_review": ("review_issues", ["review_id"], ["created_at", "issue_id"]),
    "learned_patterns": ("learned_patterns", ["family", "pattern_id"], ["pattern_id"]),
}
# Named reads of two tables, as (table, other, columns both have, how, key columns, order).
JOINS = {
    "run_examples": ("example_run_state", "example_records", ["example_id"], "inner", ["run_id", "status", "family"], ["file_path", "example_id"]),
    "run_states_by_family": ("example_run_state", "example_records", ["example_id"], "inner", ["run_id", "status", "family"], ["example_key", "example_id"]),
    "states_in_context": ("example_run_state", "example_records", ["example_id"], "left", ["run_id", "status", "app_context"], []),
    "states_of_runs": ("example_run_state", "run_records", ["run_id"], "inner", ["run_id", "family"], []),
    "pattern_results": ("learned_patterns", "pattern_performance", ["pattern_id"], "left", ["family", "pattern_id"], []),
}
# Named writes, as (table, verb, key columns, columns that keep their first value).
WRITES = {
    "example": ("example_records", "upsert", ["example_id"], ["created_at"]),
    "example_run_state": ("example_run_state", "upsert", ["run_id", "example_id"], []),
    "semantic_signature": ("semantic_signatures", "upsert", ["signature_id"], []),
    "review_result": ("review_results", "upsert", ["review_id"], []),
    "run": ("run_records", "upsert", ["run_id"], ["started_at"]),
    "run_fingerprint": ("run_fingerprints", "upsert", ["run_id"], []),
    "run_manifest": ("run_manifests", "upsert", ["run_id"], []),
    "telemetry_run": ("telemetry_runs", "upsert", ["telemetry_id"], []),
    "compile_attempt": ("compile_attempts", "append", [], []),
    "runtime_attempt": ("runtime_attempts", "append", [], []),
    "failure_detail": ("failure_details", "append", [], []),
    "markdown_edit": ("markdown_edits", "append", [], []),
    "commit_record": ("commit_records", "append", [], []),
    "phase_timing": ("phase_timings", "append", [], []),
    "telemetry_event": ("telemetry_events", "append", [], []),
    "drift_rejection": ("drift_rejections", "append", [], []),
    "authority_decision": ("authority_decisions", "append", [], []),
    "status_transition": ("status_transitions", "append", [], []),
    "work_item": ("work_queue", "insert_ignore", ["work_id"], []),
    "gist": ("gists", "upsert", ["gist_id"], ["created_at"]),
    "review_issue": ("review_issues", "upsert", ["issue_id"], []),
    "learned_pattern": ("learned_patterns", "upsert", ["pattern_id"], []),
    "pattern_result": ("pattern_performance", "upsert", ["pattern_id"], []),
    "migration": ("schema_migrations", "insert_ignore", ["version"], []),
}


BUCKETS = 16  # of a table with keys, chosen when it is made
KEPT = 20  # versions that are kept for readers
TRIES = 50  # times that a change starts anew because another writer was first


class Conflict(RuntimeError):
    """Other writers were first, TRIES times in a row."""


class Store:
    """Tables under root, a folder that driver and executors share, on a file system whose rename doesn't replace a file."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, kept: int = KEPT):
        self.spark, self.root, self.buckets, self.kept = spark, root.rstrip("/"), buckets, kept

    # versions

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def versions(self, name: str) -> list[int]:
        fs, path = self._fs()
        folder = path(f"{self.root}/{name}/versions")
        if not fs.exists(folder):
            return []
        return sorted(int(n[1:9]) for s in fs.listStatus(folder) if (n := s.getPath().getName()).startswith("v") and n.endswith(".json"))

    def _manifest(self, name: str, version: int | None = None) -> dict | None:
        found = self.versions(name)
        if not found or version is not None and version not in found:
            return None
        fs, path = self._fs()
        stream = fs.open(path(f"{self.root}/{name}/versions/v{version or found[-1]:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _publish(self, name: str, manifest: dict) -> bool:
        """Creates the version's file; false if another writer has done so."""
        fs, path = self._fs()
        final = f"{self.root}/{name}/versions/v{manifest['version']:08d}.json"
        draft = f"{self.root}/{name}/versions/.{uuid.uuid4().hex}"
        out = fs.create(path(draft))
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        if fs.getScheme() != "file":
            won = not fs.exists(path(final)) and fs.rename(path(draft), path(final))
        else:  # a local rename replaces; a link doesn't
            local = lambda p: path(p).toUri().getPath()
            try:
                os.link(local(draft), local(final))
                won = True
            except FileExistsError:
                won = False
        fs.delete(path(draft), False)
        return bool(won)

    def _change(self, name: str, make: Callable[[dict | None], dict | None], result: Callable[[], object] = lambda: None):
        """make(last manifest) gives the next one, or null for no change; anew where another writer was first."""
        for _ in range(TRIES):
            last = self._manifest(name)
            new = make(last)
            if new is None or self._publish(name, new | {"version": (last["version"] if last else 0) + 1, "made": time.time()}):
                self._expire(name)
                return result()
            self._drop(name, set(_folders(new)) - set(_folders(last)))
        raise Conflict(name)

    def _drop(self, name: str, folders: set[str]) -> None:
        fs, path = self._fs()
        for f in folders:
            fs.delete(path(f"{self.root}/{name}/{f}"), True)

    def _expire(self, name: str) -> None:
        """Versions before the last `kept` go, and data that only they name."""
        found = self.versions(name)
        old = found[: -self.kept]
        if not old:
            return
        named = [set(_folders(m)) for v in found if (m := self._manifest(name, v))]
        gone = set().union(*named[: len(old)]) - set().union(*named[len(old) :])
        fs, path = self._fs()
        for v in old:
            fs.delete(path(f"{self.root}/{name}/versions/v{v:08d}.json"), False)
        self._drop(name, gone)

    # data

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def table(self, name: str, version: int | None = None) -> DataFrame:
        """The table as it was at a version, or is now. A version that is gone, or a table that isn't there, is a KeyError."""
        m = self._manifest(name, version)
        if m is None:
            raise KeyError(f"no table {name}" if version is None else f"no version {version} of {name}")
        return self._read(name, m, _folders(m))

    def _read(self, name: str, m: dict, folders: list[str]) -> DataFrame:
        schema = StructType.fromJson(m["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{name}/{f}" for f in folders))

    def columns(self, name: str) -> list[str]:
        return self.table(name).columns

    def _bucket(self, keys: list[str], n: int) -> Column:
        return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in keys)), F.lit(n)).cast("int") if keys else F.lit(0)

    def _put(self, name: str, df: DataFrame, keys: list[str], n: int) -> dict[str, list[str]]:
        """Writes rows, a folder a bucket; gives the folders by bucket. Rows without keys are written where they are, large
        buckets by several tasks."""
        data, df = f"data/{uuid.uuid4().hex}", df.withColumn("_b", self._bucket(keys, n))
        (df.hint("rebalance", "_b") if keys else df).write.partitionBy("_b").parquet(f"{self.root}/{name}/{data}")
        fs, path = self._fs()
        found = [s.getPath().getName() for s in fs.listStatus(path(f"{self.root}/{name}/{data}")) if s.isDirectory()]
        return {f.removeprefix("_b="): [f"{data}/{f}"] for f in found if f.startswith("_b=")}

    def _new(self, df: DataFrame, keys: list[str]) -> dict:
        return {"keys": keys, "n": self.buckets if keys else 1, "schema": json.loads(df.schema.json()), "buckets": {}}

    def create(self, name: str, schema: StructType | str, keys: list[str] = ()) -> None:
        empty = self.spark.createDataFrame([], schema)
        self._change(name, lambda m: None if m else self._new(empty, list(keys)))

    def _rewrite(self, name: str, m: dict, touched: list[str], merge: Callable[[DataFrame], DataFrame]) -> dict:
        """The manifest with these buckets' rows replaced by what merge makes of them."""
        rows = merge(self._read(name, m, [f for b in touched for f in m["buckets"].get(b, [])]))
        return m | {"buckets": {b: f for b, f in m["buckets"].items() if b not in touched} | self._put(name, rows, m["keys"], m["n"])}

    def _touched(self, m: dict, rows: DataFrame) -> list[str]:
        return [str(r[0]) for r in rows.select(self._bucket(m["keys"], m["n"])).distinct().collect()]  # no more than buckets

    def _fitting(self, m: dict, rows: DataFrame) -> tuple[dict, DataFrame]:
        """The manifest with the rows' new columns, and the rows with all columns of the table."""
        schema = StructType.fromJson(m["schema"])
        for f in rows.schema:
            if f.name not in schema.fieldNames():
                schema = schema.add(f.name, f.dataType, True)
        full = rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
        return m | {"schema": json.loads(schema.json())}, full

    # reads

    def find(self, name: str, limit: int | None = None, where: Column | None = None, version: int | None = None, **keys) -> DataFrame:
        """A named read: rows with the given keys (None: any), in the read's order."""
        table, columns, order = READS[name]
        df = self.table(table, version)
        for k in columns:
            if keys.get(k) is not None:
                v = keys[k]
                df = df.where(F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == v)
        df = df if where is None else df.where(where)
        if order:
            df = df.orderBy(*_ordered(order))
        return df if limit is None else df.limit(limit)

    def joined(self, name: str, **keys) -> DataFrame:
        """A named read of two tables: rows with the given keys (None: any), in the read's order. Keys are told before the
        tables meet where one of them alone has the column; columns that both have are the first one's."""
        table, other, on, how, columns, order = JOINS[name]
        a, b = self.table(table), self.table(other)
        b = b.select(*on, *(c for c in b.columns if c not in a.columns))
        df = a.join(b, on, how)
        for k in columns:
            if keys.get(k) is not None:
                v = keys[k]
                df = df.where(F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == v)
        return df.orderBy(*_ordered(order)) if order else df

    def newest(self, name: str, keys: list[str], order: str) -> DataFrame:
        """The last row of each key: one max_by, no sort."""
        return tabular.latest(self.table(name), keys, order)

    def count_by(self, name: str, *keys: str) -> DataFrame:
        return self.table(name).groupBy(*keys).agg(F.count("*").alias("n"))

    # writes

    def write(self, name: str, rows: DataFrame, order: str | None = None) -> None:
        """A named write. Of rows that repeat a key the last by `order` counts, and the greatest row where that doesn't decide; null is a key like any other."""
        table, verb, keys, keep = WRITES[name]
        rows = tabular.latest(rows, keys, order) if keys else rows

        def make(m: dict | None) -> dict:
            m, full = self._fitting(m or self._new(rows, keys), rows)
            if verb == "append" or not m["buckets"]:
                more = self._put(table, full, m["keys"], m["n"])
                return m | {"buckets": {b: m["buckets"].get(b, []) + more.get(b, []) for b in {*m["buckets"], *more}}}
            merge = (lambda old: tabular.upsert(old, full, keys, keep)) if verb == "upsert" else (lambda old: tabular.insert_ignore(old, full, keys))
            return self._rewrite(table, m, self._touched(m, full), merge)

        self._change(table, make)

    def update(self, name: str, where: Column, **values) -> None:
        """Sets columns of the rows for which where holds; None leaves a column as it is."""
        new = {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items() if v is not None}

        def merge(df: DataFrame) -> DataFrame:
            return df.select(*(F.when(where, new[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c in new else c for c in df.columns))

        def make(m: dict | None) -> dict | None:
            touched = self._touched(m, self._read(name, m, _folders(m)).where(where))
            return self._rewrite(name, m, touched, merge) if touched else None

        self._change(name, make)

    def delete(self, name: str, where: Column) -> None:
        def make(m: dict | None) -> dict | None:
            touched = self._touched(m, self._read(name, m, _folders(m)).where(where))
            return self._rewrite(name, m, touched, lambda df: df.where(~F.coalesce(where, F.lit(False)))) if touched else None

        self._change(name, make)

    def claim(self, name: str, order: list[str], worker: str, n: int = 1, lease: float = 600.0, now: float | None = None) -> list[Row]:
        """The first n rows that are pending, or whose lease is over, marked as the worker's; fewer where there are no more.

        Any number of workers may claim: a claim counts only if its version is the first after the one it
        read, and is made anew if not, so that no row is given twice.
        """
        key, taken = WRITES["work_item"][2], []

        def make(m: dict | None) -> dict | None:
            at = time.time() if now is None else now
            if m is None:
                return None
            m, df = self._fitting(m, self._read(name, m, _folders(m)).limit(0).withColumn("worker", F.lit("")).withColumn("leased_until", F.lit(0.0)))
            free = (F.col("status") == "pending") | ((F.col("status") == "claimed") & (F.col("leased_until") < at))
            rows = self._read(name, m, _folders(m)).where(free).orderBy(*_ordered(order), *key).limit(n)
            taken[:] = rows.collect()  # n rows
            if not taken:
                return None
            mine = self.spark.createDataFrame([tuple(r[k] for k in key) for r in taken], StructType([df.schema[k] for k in key]))
            values = {"status": F.lit("claimed"), "worker": F.lit(worker), "leased_until": F.lit(at + lease)}

            def merge(old: DataFrame) -> DataFrame:
                hit = old.join(F.broadcast(mine), key, "left_semi")
                return old.join(F.broadcast(mine), key, "left_anti").unionByName(hit.withColumns(values).select(old.columns))

            return self._rewrite(name, m, self._touched(m, mine) if set(m["keys"]) == set(key) else list(m["buckets"]), merge)

        return self._change(name, make, lambda: list(taken))

    def finish(self, name: str, ids: list, worker: str, status: str = "done") -> None:
        """Marks the worker's own claims; what has been given to another one meanwhile stays that one's."""
        key = WRITES["work_item"][2][0]
        self.update(name, F.col(key).isin(ids) & (F.col("worker") == worker) & (F.col("status") == "claimed"), status=status)

    def copy_run(self, other: Store, run_id: str, tables: dict[str, tuple[str, list[str]]]) -> dict[str, int]:
        """Copies a run's rows to another store; tables maps a name to ("replace" or "ignore", keys). Returns how many."""
        out = {}
        for name, (verb, keys) in tables.items():
            rows = self.table(name).where(F.col("run_id") == run_id)
            out[name] = rows.count()
            merge = tabular.upsert if verb == "replace" else tabular.insert_ignore

            def make(m: dict | None, rows=rows, keys=keys, merge=merge, name=name) -> dict:
                m, full = other._fitting(m or other._new(rows, keys), rows)
                touched = other._touched(m, full) if m["keys"] == keys else list(m["buckets"])
                return other._rewrite(name, m, touched, lambda old: merge(old, full, keys))

            other._change(name, make)
        return out

    # schema

    def tables(self) -> list[str]:
        """The names of the tables that have a version."""
        fs, path = self._fs()
        if not fs.exists(path(self.root)):
            return []
        return sorted(n for s in fs.listStatus(path(self.root)) if self.exists(n := s.getPath().getName()))

    def empty(self) -> bool:
        """Whether no run and no example was ever recorded; other tables may hold what they like."""
        return all(not self.exists(n) or self.table(n).isEmpty() for n in ("run_records", "example_records"))

    def verify(self, expected: dict[str, list[str]], forbidden: dict[str, list[str]] | None = None) -> None:
        """A ValueError that names every table and column that is missing, and every column that should be gone."""
        wrong, there = [], set(self.tables())
        for name, columns in expected.items():
            if name not in there:
                wrong.append(f"no table {name}")
            elif lack := [c for c in columns if c not in self.columns(name)]:
                wrong.append(f"{name} lacks {', '.join(lack)}")
        for name, columns in (forbidden or {}).items():
            if name in there and (left := [c for c in columns if c in self.columns(name)]):
                wrong.append(f"{name} still has {', '.join(left)}")
        if wrong:
            raise ValueError("; ".join(wrong))

    def add_column(self, name: str, column: str, kind: str, default=None) -> None:
        """Adds a column; nothing happens where it is there. Without a default no data is written."""

        def make(m: dict | None) -> dict | None:
            if column in StructType.fromJson(m["schema"]).fieldNames():
                return None
            m, _ = self._fitting(m, self._read(name, m, []).withColumn(column, F.lit(None).cast(kind)))
            return m if default is None else self._rewrite(name, m, list(m["buckets"]), lambda df: df.withColumn(column, F.lit(default).cast(kind)))

        self._change(name, make)

    def migrate(self, steps: list[tuple[int, str, str, str]]) -> list[int]:
        """Applies (version, table, column, type) in order; versions recorded before are skipped. Returns what was new."""
        done = {r["version"] for r in self.table("schema_migrations").collect()} if self.exists("schema_migrations") else set()
        new = []
        for version, table, column, kind in sorted(steps):
            if version not in done:
                self.add_column(table, column, kind)
                self.write("migration", self.spark.createDataFrame([(version, table)], "version int, name string"))
                new.append(version)
        return new

    def export(self, name: str, path: str) -> None:
        """One JSON object a row, keys sorted, in the table's own distribution."""
        df = self.table(name)
        df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value")).write.mode("overwrite").text(path)


def _folders(m: dict | None) -> list[str]:
    return [f for folders in (m["buckets"] if m else {}).values() for f in folders]


def _ordered(order: list[str]) -> list[Column]:
    return [F.desc(o[:-1]) if o.endswith("-") else F.col(o) for o in order]


def config_hash(*sections: dict) -> str:
    import hashlib

    return hashlib.sha256(json.dumps(sections, sort_keys=True).encode()).hexdigest()
