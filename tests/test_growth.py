"""Queries whose work grew faster than their input, or that failed on rows that small tables lack."""

import difflib
import pathlib
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fenlark.operators import blocks, catalogue, diff, fuzzy, repairs, rules, scratch
from fenlark.plans import catalog, sources
from fenlark.sources import files, sinks
from fenlark.store import Store

SF = "/root/testdata/sf0.001"


def _sql(name, **tables):
    con = duckdb.connect()
    for table, rows in tables.items():
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{rows}'")
    return sorted(con.sql(catalog.ORACLES[name]).fetchall(), key=repr)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_score_tells_the_category_once(spark):
    plan = catalog.QUERIES["tier_histogram"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") < 10


def test_trends_from_zero_and_from_missing_values(spark, tmp_path):
    rows = [(1, 1, 0.0, 1), (2, 1, 5.0, 2), (3, 2, 10.0, 1), (4, 2, 20.0, 2), (5, 3, 0.0, 1), (6, 4, None, 1), (7, 4, 3.0, 2), (8, 5, None, 1)]
    spark.createDataFrame(rows, "event_id long, user_id long, value double, ts long").write.parquet(f"{tmp_path}/events.parquet")
    found = _rows(catalog.QUERIES["trend_direction"](spark, str(tmp_path)))
    assert found == _sql("trend_direction", events=f"{tmp_path}/events.parquet/*.parquet")
    assert found == [(1, "stable"), (2, "up"), (3, "stable"), (4, "stable"), (5, "down")]


def test_texts_are_not_dealt_out_to_rules(spark):
    docs = spark.range(5).select(F.col("id"), F.lit("some abc text").alias("text"), F.lit("b").alias("blob"), F.lit("kb").alias("type"))
    listed = [(f"r{i}", "e", "x", w, None, None, [], [], []) for i, w in enumerate(["abc", "[st]", "zzz", "text$"])]
    found = rules.findings(docs, spark.createDataFrame(listed, rules.FIELDS), 5)
    assert sorted((r["id"], r["rule"]) for r in found.collect()) == [(i, f"r{k}") for i in range(5) for k in (0, 1, 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_names_of_one_character_more_or_less_meet_few_words(spark):
    words = [f"LongPartName{i}" for i in range(10_000, 12_000)]
    asked = [w + "s" for w in words[:50]] + [w[:3] + w[4:] for w in words[50:100]] + ["LongPartXame1100", "nothing alike", "", None, words[7]]
    a, b = spark.createDataFrame([(x,) for x in asked], "name string"), spark.createDataFrame([(x,) for x in words], "name string")
    found = {r["name"]: r["word"] for r in fuzzy.closest(a, b, 0.7).collect()}
    assert found == {x: m[0] for x in asked if x and (m := difflib.get_close_matches(x, words, 1, 0.7))}
    near = fuzzy._next(a.where("length(name) > 0"), b.withColumnRenamed("name", "word"))
    assert near.select("name").distinct().count() >= 101 and near.count() < 1000


def test_small_rows_of_much_work_are_spread(spark):
    d = spark.range(50).withColumn("k", F.col("id") % 7)
    both = scratch.spread(d.join(d.groupBy("k").count().hint("merge"), "k"), "id")
    assert both.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_appended_rows_are_written_where_they_are(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.write("compile_attempt", spark.range(0, 1000, 1, 5).select(F.col("id").alias("attempt_id"), F.lit("r").alias("run_id")))
    assert store.table("compile_attempts").groupBy(F.input_file_name()).count().count() == 5


def test_a_batch_of_texts_is_not_held_as_objects(monkeypatch):
    sizes, texts = [], pa.array([f"a\n{i}" if i % 5 else None for i in range(1000)])
    real = pa.array
    monkeypatch.setattr(diff.pa, "array", lambda x, *more: sizes.append(len(x)) or real(x, *more))
    patches = diff._each(diff.unified, texts, texts[::-1])
    assert max(sizes) <= diff.TOGETHER and diff._each(diff.patched, texts, patches).to_pylist() == [x or "" for x in texts[::-1].to_pylist()]


def _pairs(held, least):
    out = []
    for a in held:
        for b in held:
            common, n = len(held[a] & held[b]), min(len(held[a]), len(held[b]))
            if a < b and common and common / n >= least:
                out.append((a, b, common, round(common / n, 6)))
    return sorted(out, key=repr)


def test_pairs_of_short_and_long_documents_in_cells(spark, monkeypatch):
    monkeypatch.setattr(blocks, "SHARERS", 3)
    monkeypatch.setattr(blocks, "HOLDERS", 5)
    r = random.Random(5)
    held = {i: {"common"} | {f"u{i}"} for i in range(12)} | {i: {"common"} for i in range(12, 16)}
    held |= {i: {f"w{int(r.random() ** 2 * 40)}" for _ in range(r.randint(1, 12))} for i in range(16, 80)}
    held |= {i: {f"l{k}" for k in range(i - 80, 100)} | {f"s{i}-{k}" for k in range(i)} for i in range(80, 90)} | {90: {"l99", "common"}, 91: {f"l{k}" for k in range(40, 104)}, 92: {f"l{k}" for k in range(120)}}
    units = spark.createDataFrame([(k, u) for k, us in held.items() for u in us for _ in range(2)], "doc long, unit string")
    for least in (0.5, 0.6, 0.55, 1.0):
        assert _rows(blocks.overlap(units, "doc", "unit", least)) == _pairs(held, least)


def test_a_share_just_over_a_whole_number_loses_no_pair(spark):
    held = {1: {f"c{k}" for k in range(55)} | {f"a{k}" for k in range(45)}, 2: {f"c{k}" for k in range(55)} | {f"b{k}" for k in range(45)}}
    held |= {3: {f"c{k}" for k in range(11)} | {f"d{k}" for k in range(9)}, 4: {f"a{k}" for k in range(45)}}
    units = spark.createDataFrame([(k, u) for k, us in held.items() for u in us], "doc long, unit string")
    assert _rows(blocks.overlap(units, "doc", "unit", 0.55)) == _pairs(held, 0.55)


def test_pairs_are_not_shuffled(spark):
    plan = catalog.QUERIES["prose_overlap"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan.split("SortMergeJoin")[0]


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"f{i}.md").write_text(f"text {i}")
    found = files.text_files(spark, str(tmp_path), "*.md", "/f1[^/]*$")
    assert found.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _rows(found.select(F.regexp_extract("path", "/f([^/]+).md$", 1), "text")) == sorted([(str(i), f"text {i}") for i in range(300) if str(i)[0] != "1"], key=repr)


def test_a_catalogue_is_not_gathered_by_the_driver(spark):
    read = sources._sources(spark, SF)
    d = scratch.written(catalogue.declarations(read))
    types, members = d.where("member is null").select("type", "namespace"), d.where("member is not null").select("type", "member", "member_kind")
    cases = scratch.written(sources._cases(spark, SF))
    names = cases.select(F.concat("code", F.lit("s")).alias("name"))
    words = scratch.written(types.select(F.col("type").alias("word")))
    for df in (read, fuzzy._next(names, words), fuzzy.candidates(names, words.toDF("name"), 0.7), repairs.repaired(cases, types, members, d.where("member_kind = 'constructor'").select("type", "params"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # that of characters is no larger than the alphabet
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == plan.count("BroadcastHashJoin [c#")


@pytest.mark.parametrize("local", [True, False])
def test_files_are_listed_in_rounds(spark, tmp_path, monkeypatch, local):
    seen, real = [], files.text_files
    monkeypatch.setattr(files, "text_files", lambda s, folders, *more: seen.append(sum(f.is_file() and f.suffix in (".md", ".txt") for x in folders for f in pathlib.Path(x).rglob("*"))) or real(s, folders, *more))
    monkeypatch.setattr(files, "FOLDERS", 2)
    monkeypatch.setattr(sinks, "FILES", 5)
    rows = [(i, None if i % 7 == 0 else f"é{i}\n" * (i % 4)) for i in range(60)] + [(None, "no id"), (-3, "x")]
    if local:
        rows += [(8, "again"), (8, "again")]
    else:
        monkeypatch.setattr(sinks, "_local", lambda spark, path: None)
    spark.createDataFrame(rows, "page_id long, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    found = _rows(catalog.QUERIES["file_scan"](spark, str(tmp_path)))
    assert found == _sql("file_scan", pages=f"{tmp_path}/pages.parquet/*.parquet")
    assert sum(seen) == len(rows) and len(seen) > 3 and max(seen) <= (10 if local else 30)
    spark.createDataFrame([], "page_id long, html string").write.parquet(f"{tmp_path}/none/pages.parquet")
    assert _rows(catalog.QUERIES["file_scan"](spark, f"{tmp_path}/none")) == []
