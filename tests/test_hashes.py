"""Hashes of selections that stream by, and blocks of hot keys."""

import hashlib

from pyspark.sql import functions as F

from fenlark.operators import blocks, tabular


def test_ordered_hash_equals_the_joined_keys(spark):
    rows = [(i % 3, str(i * 7919 % 1000)) for i in range(5000)] + [(None, "b"), (None, "a"), (7, None), (8, "é"), (8, "z")]
    got = {r["g"]: r["h"] for r in tabular.ordered_hash(spark.createDataFrame(rows, "g int, k string"), "g", "k", "h").collect()}
    want = {g: hashlib.sha256("\n".join(sorted((k for x, k in rows if x == g and k is not None), key=str.encode)).encode()).hexdigest() for g in (0, 1, 2, None, 8)}
    assert got == want
    assert tabular.ordered_hash(spark.createDataFrame([], "g int, k string"), "g", "k").count() == 0


def test_a_hot_text_resolves_row_by_row(spark):
    d = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("own "), F.col("id").cast("string"))).alias("text"))
    n = {r["n"]: r["count"] for r in blocks.resolve(d, d, "id", "text").groupBy("n").count().collect()}
    assert n == {1000: 1000, 1: 2000}
