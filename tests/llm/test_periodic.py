"""Runs of periodic words against a quadratic search."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fenlark.llm import periodic


def _runs(w):
    """Every period, every maximal stretch; smaller periods of the same stretch win."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - s + q
            if n >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(s, s + n - p)) for p in range(1, q)):
                out.append((s, n, q))
    return sorted(out)


def _expected(doc_id, text, plant):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    if plant and doc_id is not None:
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = _runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    text = b" ".join(x for i, x in enumerate(w) if i not in drop)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(text).hexdigest())


def _texts(r, n):
    for i in range(n):
        w = []
        while len(w) < r.randint(0, 90):
            u = [r.choice(["a", "b", "é", "a,"]) for _ in range(r.randint(1, 7))]
            w += (u * 9)[: r.randint(1, 40)]
        yield i, r.choice([" ", "\n", "\t \v"]).join(w)


def test_documents_equal_brute_force(spark):
    rows = [*_texts(random.Random(4), 400), (400, None), (401, ""), (402, " \r\n"), (None, "x " * 9), (403, "x " * 9), (403, "x " * 9), (404, "y z " * 20_000)]
    for plant in (False, True):
        got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string"), plant, False).collect()
        key = lambda r: (r[0] is None, r[0] or 0, r)
        want = sorted((_expected(i, t, plant) for i, t in rows[:-1]), key=key)
        assert sorted((tuple(r) for r in got if r[0] != 404), key=key) == want
    last = next(r for r in periodic.periodic_runs(spark.createDataFrame(rows[-1:], "doc_id long, text string")).collect())
    assert (last["n_runs"], last["length"], last["period"], last["exponent_milli"], bytes(last["collapsed"])) == (1, 40_000, 2, 20_000_000, b"y z")


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["doc_id"]: _expected(r["doc_id"], r["text"], True) for r in docs.where("length(text) < 4000").collect()}
    got = {r[0]: tuple(r) for r in periodic.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(want) > 50 and {i: got[i] for i in want} == want and any(w[1] for w in want.values())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80))
def test_any_words(w):
    assert periodic.runs_of(np.array(w, np.int64)) == _runs(w)


def test_edge_cases(odd, nothing):
    rows = periodic.periodic_runs(odd).collect()
    of = {r["doc_id"]: r for r in rows}
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == 11 and all(of[i]["n_runs"] == 0 and of[i]["start"] is None and of[i]["collapsed_sha256"] == empty for i in (1, 2, 3))
    assert of[6]["n_runs"] == 1 and of[6]["period"] == 2 and bytes(of[6]["collapsed"]) == b"lorem ipsum"
    assert periodic.periodic_runs(nothing).count() == 0


def test_blocks_of_ordered_sets(monkeypatch):
    monkeypatch.setattr(periodic, "WIDE", 4)
    r = random.Random(2)
    for _ in range(200):
        w = np.array([r.randrange(2) for _ in range(r.randint(0, 200))] + [0, 1, 1] * r.randint(0, 30), np.int64)
        assert periodic.runs_of(w) == _runs(w.tolist())
