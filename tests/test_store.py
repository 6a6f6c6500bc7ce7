import threading

import pytest
from pyspark.sql import functions as F

from fenlark.store import READS, WRITES, Store


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def rows(spark, *values):
    return spark.createDataFrame(list(values), "run_id string, example_id string, status string, created_at int")


def test_upsert_replaces_and_keeps(spark, store):
    e = lambda *v: spark.createDataFrame(list(v), "example_id string, family string, example_key string, file_path string, created_at int")
    store.write("example", e(("a", "f", "k1", "p", 1), ("b", "f", "k0", "p", 2)))
    store.write("example", e(("a", "g", "k2", "q", 9), ("c", "f", "k3", "p", 3)))
    assert [tuple(r) for r in store.find("example", example_id="a").collect()] == [("a", "g", "k2", "q", 1)]
    assert [r["example_id"] for r in store.find("examples_by_family", family="f").collect()] == ["b", "c"]
    assert [r["example_id"] for r in store.find("examples_by_file", file_path=["p", "q"], limit=2).collect()] == ["b", "a"]


def test_append_update_delete_count(spark, store):
    store.write("example_run_state", rows(spark, ("r", "a", "OK", 1), ("r", "b", "BAD", 2), ("s", "a", "OK", 3)))
    store.write("example_run_state", rows(spark, ("r", "b", "OK", 5)))
    store.update("example_run_state", F.col("example_id") == "a", status="DONE", created_at=None)
    assert {tuple(r) for r in store.count_by("example_run_state", "status").collect()} == {("DONE", 2), ("OK", 1)}
    store.delete("example_run_state", F.col("run_id") == "s")
    assert store.table("example_run_state").count() == 2
    assert [tuple(r) for r in store.newest("example_run_state", ["run_id"], "created_at").collect()] == [("r", "b", "OK", 5)]
    f = spark.createDataFrame([("r", "a", "x", 1)], "run_id string, example_id string, failure_category string, timestamp int")
    store.write("failure_detail", f)
    store.write("failure_detail", f.drop("failure_category").withColumn("timestamp", F.lit(3)))
    assert len(store.versions("failure_details")) == 2 and len(store._manifest("failure_details")["buckets"]["0"]) == 2  # files are added, none written anew
    store.write("failure_detail", f.withColumn("timestamp", F.lit(7)).withColumn("more", F.lit("y")))
    assert [(r["timestamp"], r["failure_category"], r["more"]) for r in store.find("failure_details", example_id="a").collect()] == [(7, "x", "y"), (3, None, None), (1, "x", None)]


def test_readers_keep_what_they_opened(spark, store):
    store.write("example_run_state", rows(spark, ("r", "a", "OK", 1)))
    before = store.table("example_run_state")
    store.write("example_run_state", rows(spark, ("r", "b", "OK", 2)))
    assert before.count() == 1 and store.table("example_run_state").count() == 2


def test_claim_copy_migrate(spark, store, tmp_path):
    w = spark.createDataFrame([(1, 5, "pending", ""), (2, 9, "pending", ""), (3, 9, "done", "")], "work_id int, priority int, status string, worker string")
    store.write("work_item", w)
    store.write("work_item", w)  # known ids are ignored
    assert store.claim("work_queue", ["priority-", "work_id"], "me")[0]["work_id"] == 2
    assert store.claim("work_queue", ["priority-", "work_id"], "me")[0]["work_id"] == 1 and store.claim("work_queue", ["priority-"], "me") == []
    store.write("example_run_state", rows(spark, ("r", "a", "OK", 1), ("s", "b", "OK", 2)))
    other = Store(spark, str(tmp_path / "other"))
    plan = {"example_run_state": ("replace", ["run_id", "example_id"])}
    assert store.copy_run(other, "r", plan) == {"example_run_state": 1} and other.table("example_run_state").count() == 1
    store.update("example_run_state", F.lit(True), status="NEW")
    store.copy_run(other, "r", plan)
    assert [r["status"] for r in other.table("example_run_state").collect()] == ["NEW"]
    steps = [(2, "work_queue", "note", "string"), (1, "work_queue", "tries", "int")]
    assert store.migrate(steps) == [1, 2] and store.migrate(steps) == []
    assert store.columns("work_queue") == ["work_id", "priority", "status", "worker", "leased_until", "tries", "note"]


def test_empty_store(spark, store):
    assert not store.exists("nothing")
    with pytest.raises(KeyError):
        store.table("nothing")
    store.create("run_records", "run_id string, family string, started_at int")
    assert store.find("run", run_id="r").count() == 0 and set(READS) and set(WRITES)


def _files(path):
    return {f: f.stat().st_size for f in path.rglob("*.parquet")}


def test_versions_are_snapshots(spark, store):
    store.write("example_run_state", rows(spark, ("r", "a", "OK", 1), ("r", "b", "OK", 2)))
    pinned = store.versions("example_run_state")[-1]
    store.write("example_run_state", rows(spark, ("r", "a", "BAD", 3)))
    store.delete("example_run_state", F.col("example_id") == "b")
    at = lambda v: sorted((r["example_id"], r["status"]) for r in store.table("example_run_state", v).collect())
    assert at(pinned) == [("a", "OK"), ("b", "OK")] and at(pinned + 1) == [("a", "BAD"), ("b", "OK")] and at(None) == [("a", "BAD")]
    assert [r["status"] for r in store.find("example_run_state", version=pinned, example_id="a").collect()] == ["OK"]
    with pytest.raises(KeyError):
        store.table("example_run_state", 99)


def test_old_versions_go_with_their_data(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), kept=2)
    for i in range(5):
        store.write("example_run_state", rows(spark, ("r", "a", f"S{i}", i), ("r", f"e{i}", "OK", i)))
    assert store.versions("example_run_state") == [4, 5] and store.table("example_run_state").count() == 6
    assert store.table("example_run_state", 4).count() == 5
    named = {f for v in (4, 5) for b in store._manifest("example_run_state", v)["buckets"].values() for f in b}
    assert {str(f.parent.relative_to(tmp_path / "s" / "example_run_state")) for f in _files(tmp_path / "s")} == named


def test_a_change_writes_what_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=32)
    store.write("example_run_state", spark.range(20_000).select(F.lit("r").alias("run_id"), F.col("id").cast("string").alias("example_id"), F.sha2(F.col("id").cast("string"), 256).alias("status"), F.lit(1).alias("created_at")))
    before = _files(tmp_path)
    store.write("example_run_state", rows(spark, ("r", "7", "NEW", 2)))
    new = {f: n for f, n in _files(tmp_path).items() if f not in before}
    assert 0 < sum(new.values()) < sum(before.values()) / 16 and store.table("example_run_state").count() == 20_000
    store.update("example_run_state", F.col("example_id") == "8", status="DONE")
    assert sum(_files(tmp_path).values()) < 1.2 * sum(before.values())
    states = {r["example_id"]: r["status"] for r in store.table("example_run_state").where("example_id in ('7', '8')").collect()}
    assert states == {"7": "NEW", "8": "DONE"}
    versions = store.versions("example_run_state")
    store.update("example_run_state", F.col("example_id") == "none", status="X")
    assert store.versions("example_run_state") == versions  # nothing touched, nothing written


def test_repeated_and_null_keys_follow_one_rule(spark, store):
    twice = rows(spark, ("r", "a", "FIRST", 1), ("r", "a", "LAST", 2), (None, "n", "A", 1), (None, "n", "B", 0))
    for _ in range(2):  # the first write and later ones
        store.write("example_run_state", twice, order="created_at")
        assert sorted((r["run_id"] or "", r["status"]) for r in store.table("example_run_state").collect()) == [("", "A"), ("r", "LAST")]
    store.write("example_run_state", rows(spark, (None, "n", "C", 9)))
    assert sorted((r["run_id"] or "", r["status"]) for r in store.table("example_run_state").collect()) == [("", "C"), ("r", "LAST")]


def test_workers_never_share_an_item(spark, store):
    store.write("work_item", spark.range(24).select(F.col("id").cast("int").alias("work_id"), (F.col("id") % 3).cast("int").alias("priority"), F.lit("pending").alias("status")))
    given: dict[str, list] = {}

    def work(worker):
        mine = Store(spark, store.root)
        given[worker] = []
        while got := mine.claim("work_queue", ["priority-", "work_id"], worker, n=3):
            given[worker] += [r["work_id"] for r in got]

    threads = [threading.Thread(target=work, args=(w,)) for w in ("a", "b", "c")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(x for g in given.values() for x in g) == list(range(24))
    assert {(r["worker"], r["work_id"]) for r in store.table("work_queue").collect()} == {(w, x) for w, g in given.items() for x in g}


def test_leases_end(spark, store):
    store.write("work_item", spark.createDataFrame([(1, 5, "pending"), (2, 4, "pending")], "work_id int, priority int, status string"))
    claim = lambda worker, now: [r["work_id"] for r in store.claim("work_queue", ["priority-"], worker, 1, 100.0, now)]
    assert claim("a", 1000.0) == [1] and claim("b", 1050.0) == [2] and claim("c", 1099.0) == [] and claim("c", 1101.0) == [1]
    store.finish("work_queue", [1], "a")  # a was too late
    assert claim("d", 1102.0) == []
    store.finish("work_queue", [1], "c")
    store.finish("work_queue", [2], "b")
    assert claim("d", 9999.0) == [] and {r["status"] for r in store.table("work_queue").collect()} == {"done"}


def test_a_lost_race_starts_anew(spark, store, monkeypatch):
    store.write("example_run_state", rows(spark, ("r", "a", "OK", 1)))
    publish, lost = Store._publish, []

    def late(self, name, manifest):
        if not lost:
            lost.append(1)
            Store(spark, store.root).write("example_run_state", rows(spark, ("r", "b", "OK", 2)))
        return publish(self, name, manifest)

    monkeypatch.setattr(Store, "_publish", late)
    store.write("example_run_state", rows(spark, ("r", "c", "OK", 3)))
    assert sorted(r["example_id"] for r in store.table("example_run_state").collect()) == ["a", "b", "c"]


def test_reads_of_two_tables(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    s.write("example", spark.createDataFrame([("a", "f", "x", "k2"), ("b", "g", "y", "k1"), ("c", "f", "z", "k0")], "example_id string, family string, file_path string, example_key string"))
    states = [("1", "a", "VERIFIED", "own"), ("1", "b", "VERIFIED", None), ("1", "gone", "VERIFIED", None), ("2", "c", "FAILED", None), (None, "c", "VERIFIED", None)]
    s.write("example_run_state", spark.createDataFrame(states, "run_id string, example_id string, status string, file_path string"))
    assert [(r["example_id"], r["family"]) for r in s.joined("run_states_by_family", run_id="1").collect()] == [("b", "g"), ("a", "f")]
    assert [r["example_id"] for r in s.joined("run_states_by_family", status=["VERIFIED", "FAILED"], family="f").collect()] == ["c", "c", "a"]
    assert {(r["example_id"], r["file_path"]) for r in s.joined("run_examples", run_id="1").collect()} == {("a", "own"), ("b", None)}
    s.add_column("example_records", "app_context", "string", "console")
    assert {(r["example_id"], r["app_context"]) for r in s.joined("states_in_context", run_id="1").collect()} == {("a", "console"), ("b", "console"), ("gone", None)}
    assert s.joined("states_in_context", app_context="mvc").count() == 0


def test_a_schema_is_verified_by_name(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    assert s.tables() == [] and s.empty()
    s.create("run_records", "run_id string, family string", ["run_id"])
    s.write("commit_record", spark.createDataFrame([("a", 1)], "family string, timestamp int"))
    assert s.tables() == ["commit_records", "run_records"] and s.empty()
    s.verify({"run_records": ["run_id", "family"]}, {"commit_records": ["old"], "never": ["x"]})
    with pytest.raises(ValueError, match="run_records lacks started_at, status; no table example_records; commit_records still has timestamp"):
        s.verify({"run_records": ["started_at", "family", "status"], "example_records": []}, {"commit_records": ["timestamp"]})
    s.write("run", spark.createDataFrame([("1", "f", 2)], "run_id string, family string, started_at int"))
    assert not s.empty()
