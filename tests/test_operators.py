from pyspark.sql import functions as F

from fenlark.functions import errors, markdown
from fenlark.operators import blocks, diff, rewrite, tabular
from fenlark.sources import files, sinks
from fenlark.streaming import windows


def test_fences_toggle_and_unclosed_blocks_drop(spark):
    md = "a\n```py\nx = 1\n\ny\n```\n# h\n```\nlost"
    found = spark.createDataFrame([(md,)], "t string").select(markdown.blocks(F.col("t")).alias("b")).first()["b"]
    assert [tuple(b)[:5] for b in found] == [(0, 2, 6, "py", "x = 1\n\ny")]
    assert spark.createDataFrame([(None,), ("",), ("```",)], "t string").select(F.size(markdown.blocks(F.col("t"))).alias("n")).where("n > 0").count() == 0


def test_islands(spark):
    rows = blocks.lines(spark.createDataFrame([(1, "x\ny\n\nz")], "k int, t string"), "k", F.col("t"))
    assert sorted((r["first"], r["n"]) for r in blocks.islands(rows, "k", F.col("line") != "").collect()) == [(0, 2), (3, 1)]


def test_repair_is_idempotent(spark):
    md = spark.createDataFrame([("```\na\n  # h\nb\n```\nc\n",), ("",), ("x\n ```\n",)], "md string")
    once = md.select(markdown.repaired(F.col("md")).alias("r")).select("r.*")
    assert [tuple(r) for r in once.collect()] == [("```\na\n```\n  # h\nb\n```\nc\n```\n", 2), ("", 0), ("x\n ```\n```\n", 1)]
    assert [r[0]["repairs"] for r in once.select(markdown.repaired(F.col("text"))).collect()] == [0, 0, 0]


def test_registered_transformers_and_diffs(spark):
    rewrite.register_all(spark)
    spark.createDataFrame([("a  \nb\t",), (None,)], "t string").createOrReplaceTempView("t")
    assert [r[0] for r in spark.sql("select strip_trailing_space(t) from t").collect()] == ["a\nb", None]
    d = spark.createDataFrame([("x\ny", "x\nz"), ("same", "same"), (None, "new")], "a string, b string")
    found = [r[0] for r in d.select(diff.unified_diff(F.col("a"), F.col("b"))).collect()]
    assert found[0].split("\n")[2:] == ["@@ -1,2 +1,2 @@", " x", "-y", "+z"] and found[1] == "" and "+new" in found[2]
    assert d.limit(1).select(rewrite.collapse_blank_lines(F.lit("a\n\n\n\nb"))).first()[0] == "a\n\nb"


def test_sessions_and_sliding_windows_of_a_stream(spark, tmp_path):
    df = _events(spark, str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    _drain(windows.sliding(stream, "2 hours", "1 hour"), "slid", "complete")
    assert sorted(map(tuple, spark.table("slid").collect())) == sorted(map(tuple, windows.sliding(df, "2 hours", "1 hour").collect()))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    _drain(windows.distinct_events(stream.withColumn("k", F.col("event_type")), "k"), "firsts", "append")
    assert sorted(r["k"] for r in spark.table("firsts").collect()) == ["error", "view"]


def test_upsert_keeps_and_replaces(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, at int")
    new = spark.createDataFrame([(2, "c", 99), (3, "d", 30)], "k int, v string, at int")
    assert sorted(map(tuple, tabular.upsert(old, new, ["k"], keep=["at"]).collect())) == [(1, "a", 10), (2, "c", 20), (3, "d", 30)]


def test_ladder_takes_first_match(spark):
    d = spark.createDataFrame([("CS0246 the type 'X' or namespace",), ("CS0246 namespace",), ("?",)], "m string")
    assert [r[0] for r in d.select(errors.category(F.col("m"))).collect()] == ["missing_type", "missing_namespace", "unknown"]


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "a.md").write_text("# t\nx")
    (tmp_path / "in" / "b.txt").write_text("no")
    assert [r["text"] for r in files.text_files(spark, str(tmp_path / "in")).collect()] == ["# t\nx"]
    assert {r["extension"]: r["files"] for r in files.inventory(spark, str(tmp_path / "in")).collect()} == {"md": 1, "txt": 1}
    sinks.export_json(spark.createDataFrame([(1, "x")], "b int, a string"), str(tmp_path / "out"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"a":"x","b":1}']


def _events(spark, folder):
    rows = [(1, "2024-01-01 00:00:00", "error"), (1, "2024-01-01 00:00:10", "error"), (1, "2024-01-01 00:00:20", "error"), (1, "2024-01-01 00:05:00", "view"), (2, "2024-01-01 01:30:00", "view")]
    df = spark.createDataFrame(rows, "user_id long, ts string, event_type string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(folder)
    return df


def _drain(stream, name, mode):
    stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def test_stream_equals_batch(spark, tmp_path):
    df = _events(spark, str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    _drain(windows.tumbling(stream, "1 hour"), "tumbled", "complete")
    assert sorted(map(tuple, spark.table("tumbled").collect())) == sorted(map(tuple, windows.tumbling(df, "1 hour").collect()))


def test_circuit_breaker(spark, tmp_path):
    df = _events(spark, str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    _drain(windows.circuit_breaker(stream), "broken", "append")
    assert [r["state"] for r in spark.table("broken").orderBy("ts").collect()] == ["OPEN", "CLOSED"]
