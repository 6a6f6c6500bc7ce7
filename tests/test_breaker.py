"""Breakers of streams, tables and a plain loop; buckets composed over blocks and a plain loop."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fenlark.streaming import breaker

SCHEMA = "key string, id long, ts timestamp, failed boolean"


def _calls(r, n, keys="aaab", step=40):
    t, out = 1_700_000_000, []
    for i in range(n):
        t += r.choice([0, 1, 5, step])
        out.append((r.choice(keys), i, t, r.random() < 0.6))
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(k, i, t, f) for k, i, t, f in rows], "key string, id long, t long, failed boolean").select("key", "id", F.timestamp_seconds("t").alias("ts"), "failed")


def _changes(rows, failures, rest):
    out = []
    for key in sorted({r[0] for r in rows}):
        state, run, opened = "CLOSED", 0, 0
        for _, _, t, failed in sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[3])):
            if state == "OPEN" and t >= opened + rest:
                state = "HALF_OPEN"
                out.append((key, opened + rest, state))
            if state == "OPEN":
                continue
            run = run + 1 if failed else 0
            new = "OPEN" if failed and (state == "HALF_OPEN" or run >= failures) else state if failed else "CLOSED"
            if new != state:
                out.append((key, t, new))
                state, opened = new, t
        if state == "OPEN":
            out.append((key, opened + rest, "HALF_OPEN"))
    return sorted(out)


def _seen(df):
    return sorted((r["key"], r["t"], r["state"]) for r in df.select("key", F.unix_seconds("ts").alias("t"), "state").collect())


def test_a_table_equals_the_loop(spark):
    rows = _calls(random.Random(1), 600)
    assert _seen(breaker.breaker_changes(_frame(spark, rows + [(None, 1, 5, True)]), 2, 60)) == _changes(rows, 2, 60)
    assert breaker.breaker_changes(_frame(spark, []), 2, 60).count() == 0


def test_a_stream_with_a_restart_equals_the_table(spark, tmp_path):
    """Files in any order within the watermark; the query ends after each and goes on from its checkpoint."""
    rows = _calls(random.Random(2), 90)
    end = rows[-1][2]
    parts = [rows[i : i + 30] for i in range(0, 90, 30)] + [[("z", 1000, end + 100_000, False)]]
    for part in parts[:3]:
        random.Random(3).shuffle(part)
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for part in parts:
        _frame(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        q = breaker.breaker_changes(stream, 2, 60, "30 minutes", 600).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    assert _seen(spark.read.schema(breaker.CHANGES).parquet(out)) == _changes(rows, 2, 60)


def _admitted(rows, capacity, every):
    out, held = {}, {}
    for key, i, t, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        credit, last = held.get(key, (capacity * every, t))
        credit = min(capacity * every, credit + t - last)
        out[i] = credit >= every
        held[key] = (credit - every * out[i], t)
    return out


@pytest.mark.parametrize("block", [3, 50, breaker.BLOCK])
def test_buckets_over_blocks_equal_the_loop(spark, block):
    rows = _calls(random.Random(block), 700, step=17)
    got = {r["id"]: r["admitted"] for r in breaker.admitted(_frame(spark, rows + [(None, 9999, 1, True)]), 3, 7, block).collect()}
    assert got == _admitted(rows, 3, 7) and {True, False} == set(got.values())


def test_composed_functions_for_every_credit():
    r = random.Random(6)
    for _ in range(60):
        cost, capacity = r.randint(1, 9), r.randint(1, 4)
        full = cost * capacity
        times = np.cumsum([r.choice([0, 1, 2, cost, 3 * cost]) for _ in range(r.randint(1, 40))])
        pieces = breaker.composed(times, cost, full)
        assert pieces[0, 0] == 0 and pieces[-1, 1] == full + 1 and (pieces[1:, 0] == pieces[:-1, 1]).all()
        for start in range(full + 1):
            credit, last = start, times[0]
            for t in times:
                credit, last = min(full, credit + t - last), t
                credit -= cost * (credit >= cost)
            _, _, shift, fixed = pieces[np.searchsorted(pieces[:, 0], start, "right") - 1]
            assert (fixed if fixed >= 0 else start + shift) == credit


def test_dense_calls_are_composed_in_few_steps(monkeypatch):
    steps, after = [], breaker._after
    monkeypatch.setattr(breaker, "_after", lambda *a: steps.append(1) or after(*a))
    r = random.Random(7)
    for cost, full in ((50, 200), (50, 100), (50, 50)):
        times = np.cumsum([r.choice([0, 1, 3, 49, 50]) for _ in range(2000)] + [51] + [r.choice([0, 7]) for _ in range(500)] + [260, 0, 1])
        steps.clear()
        pieces = breaker.composed(times, cost, full)
        assert len(steps) < 30 or full < 2 * cost
        for start in range(full + 1):
            credit, last = start, times[0]
            for t in times:
                credit, last = min(full, credit + t - last), t
                credit -= cost * (credit >= cost)
            _, _, shift, fixed = pieces[np.searchsorted(pieces[:, 0], start, "right") - 1]
            assert (fixed if fixed >= 0 else start + shift) == credit
