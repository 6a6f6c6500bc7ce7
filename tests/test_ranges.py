"""Operators that carry what earlier ranges of a key hold into later ones, against plain Python, with a key on many ranges."""

import random

import pytest
from pyspark.sql import functions as F

from fenlark.operators import tabular
from fenlark.plans import catalog


@pytest.fixture(autouse=True)
def _many_ranges(spark):
    """Small ranges are not put together again, as the tables here would be one."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def _rows(n, hot):
    r = random.Random(n)
    return [(i, 7 if r.random() < hot else r.choice([1, 2, 3, None]), r.choice([None, *range(200)]) if i % 9 == 0 else r.randrange(10_000)) for i in range(n)]


def _by_hand(left, right):
    out = set()
    for i, k, t in left:
        fit = [(rt, v) for v, rk, rt in right if rk == k and rt is not None and t is not None and rt <= t]
        out.add((i, k, max(fit)[1] if fit else None))
    return out


def test_as_of_carries_over_the_borders_of_a_hot_key(spark):
    left, right = _rows(900, 0.7), _rows(60, 0.5)
    a = spark.createDataFrame(left, "id long, k long, t long")
    b = spark.createDataFrame(right, "v long, k long, at long")
    found = tabular.as_of(a, b, "k", "t", "at", ["v"])
    assert found.columns == ["id", "k", "t", "v"]
    assert {(r["id"], r["k"], r["v"]) for r in found.collect()} == _by_hand(left, right)
    none = spark.createDataFrame([], "v long, k long, at long")
    assert tabular.as_of(a, none, "k", "t", "at", ["v"]).where("v is null").count() == 900
    assert tabular.as_of(a.limit(0), b, "k", "t", "at", ["v"]).count() == 0


def test_a_hot_key_lies_in_many_ranges(spark):
    a = spark.range(20_000).select("id", F.lit(1).alias("k"))
    spread = tabular._dealt(a, "k", ["id"]).groupBy("_p").count().collect()
    assert len(spread) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in spread) < 10_000


def test_running_counts_go_on_over_ranges(spark):
    rows = [(i, 1 if i % 3 else i % 5, i % 4 == 0) for i in range(3000)] + [(i, None, True) for i in range(3000, 3010)]
    d = spark.createDataFrame(rows, "i long, k long, yes boolean")
    seen, expected = {}, set()
    for i, k, yes in rows:
        seen[k] = seen.get(k, 0) + yes
        expected.add((i, k, seen[k]))
    found = tabular.running_count(d, "k", ["i"], F.col("yes"), "n")
    assert found.columns == ["i", "k", "yes", "n"] and {(r["i"], r["k"], r["n"]) for r in found.collect()} == expected


def test_failures_in_a_row_of_one_user(spark, tmp_path):
    kinds = ["error" if (i // 3) % 2 or i % 11 == 0 else "view" for i in range(2000)]
    spark.createDataFrame(list(zip(range(2000), [5] * 2000, kinds, range(2000), strict=True)), "event_id long, user_id long, event_type string, ts long").write.parquet(f"{tmp_path}/events.parquet")
    runs, n = [], 0
    for kind in [*kinds, "end"]:
        if kind == "error":
            n += 1
        elif n:
            runs.append(n)
            n = 0
    found = catalog.QUERIES["consecutive_failures"](spark, str(tmp_path)).collect()
    assert sorted(r["n"] for r in found) == sorted(x for x in runs if x >= 2)
