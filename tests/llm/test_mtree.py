"""The M-tree against exhaustive search: results, bounds, blocks, odd vectors."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from fenlark.llm import mtree


def _vectors(r, n, dim=8, clusters=12):
    middle = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(clusters)]
    return [[x + r.gauss(0, 0.1) for x in r.choice(middle)] for _ in range(n)]


def _brute(rows, k, every):
    x = {i: [math.floor(256 * c) for c in v] for i, v in rows}
    out = []
    for q in x:
        if q % every == 0:
            near = sorted((-sum(a * b for a, b in zip(x[q], x[c], strict=False)), c) for c in x if c != q)
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(near[:k])]
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("cell", [mtree.CELL, 100])
def test_equals_exhaustive_search(spark, monkeypatch, cell):
    r = random.Random(cell)
    rows = list(enumerate(_vectors(r, 700)))
    rows += [(700 + i, rows[13][1]) for i in range(40)]  # copies, and so ties
    monkeypatch.setattr(mtree, "CELL", cell)
    got = mtree.exact_nearest(_frame(spark, rows), 5, 7)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 5, 7)


def test_blocks_of_subtrees_and_queries_change_nothing(spark, monkeypatch):
    rows = list(enumerate(_vectors(random.Random(3), 400)))
    monkeypatch.setattr(mtree, "CELL", 150)
    monkeypatch.setattr(mtree, "BLOCK", 40)
    assert sorted(map(tuple, mtree.exact_nearest(_frame(spark, rows), 5, 3).collect())) == _brute(rows, 5, 3)


def test_few_candidates_and_ties(spark):
    rows = [(0, [0.5, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 1.0]), (50, [0.0, 0.0])]
    assert sorted(map(tuple, mtree.exact_nearest(_frame(spark, rows)).collect())) == _brute(rows, 5, 50)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (None, [9.0, 9.0]), (5, []), (6, [3.0]), (7, [-1.0, -1.0]), (7, [-1.0, -1.0])]
    got = mtree.exact_nearest(_frame(spark, rows), 5, 50).collect()
    # a shorter vector counts as if zeros followed
    assert [tuple(r) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 6, 256 * 768), (0, 2, 5, 0), (0, 3, 7, -256 * 256 - 512 * 256)]
    assert mtree.exact_nearest(_frame(spark, [(1, None)])).count() == 0
    assert mtree.exact_nearest(_frame(spark, [])).count() == 0
    clash = spark.createDataFrame([(0, [1.0], 3, 4.0), (1, [2.0], 3, 4.0)], "vec_id long, embedding array<float>, rank int, score double")
    assert [tuple(r) for r in mtree.exact_nearest(clash).collect()] == [(0, 1, 1, 256 * 512)]


def test_large_components_are_exact(spark):
    rows = [(i, [1e6 + i, -2e6, 1e6 * (i % 3)]) for i in range(8)] + [(8, [1e300, 0.0, 0.0])]
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in mtree.exact_nearest(_frame(spark, rows), 3, 4).collect()}
    assert got[0, 8] == (1 << 63) - 1
    ints = {i: [math.floor(256 * c) for c in v] for i, v in rows[:8]}
    assert all(s == sum(a * b for a, b in zip(ints[q], ints[c], strict=True)) for (q, c), s in got.items() if c != 8 and q != 8)


def test_stored_bounds_save_computations():
    r = random.Random(1)
    x = np.floor(256 * np.array(_vectors(r, 5000, 4, 40))).astype(np.int64)
    space = mtree.Space(float(np.sqrt((x.astype(float) ** 2).sum(1)).max()), int(np.abs(x).max()), 4)
    tree = mtree.opened(mtree.paged(np.arange(5000), x, space, space.rows(x[:1])[0]), space, 4)
    leaves = [p for p in tree.values() if p[0]]
    assert sorted(c for p in leaves for c in p[1].tolist()) == list(range(5000)) and max(len(p[1]) for p in leaves) <= mtree.PAGE
    seen, asked = Counter(), np.arange(0, 5000, 50)
    for some in np.array_split(asked, 100):
        best, ids = space.unknown(len(some), 6)
        mtree.searched(tree, space, x[some], best, ids, seen)
        for q, s, c in zip(some, best, ids, strict=True):
            want = sorted((-int(v), i) for i, v in enumerate(x @ x[q]))[:6]
            assert [(-int(v), int(i)) for v, i in zip(s, c, strict=True)] == want
    assert seen["computed"] < 0.5 * seen["entries"] and seen["entries"] < 0.5 * 100 * 5000
