"""Operators that once did a part of their job: what the part left out."""

import difflib

import numpy as np

from fenlark.operators import blocks, fuzzy, nearest
from fenlark.plans import catalog


def save(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_blocks_are_resolved_by_their_whole_text(spark, tmp_path):
    same = "a shared header that is longer than forty characters\n"
    texts = [same + "one", same + "two", "twice", " twice\n", *["often"] * 4, None]
    sf = save(spark, tmp_path, "documents", list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["resolution"] for r in catalog.QUERIES["block_resolution"](spark, sf).collect()}
    assert found == {0: "unique", 1: "unique", 2: "ambiguous", 3: "ambiguous", 4: "rejected", 5: "rejected", 6: "rejected", 7: "rejected", 8: "missing"}


def test_heads_count_only_where_no_text_matches(spark):
    five = "a;\n\n b\nc\nd\n"
    there = spark.createDataFrame([(0, five + "x"), (1, five.upper() + "y"), (2, "whole"), (3, "whole\nmore"), (4, "Alone ;\r\nlast")], "k int, t string")
    asked = spark.createDataFrame([(0, five + "z"), (1, "whole"), (2, "alone \nLAST;"), (3, "a\nb"), (4, " \n"), (5, None)], "k int, t string")
    assert dict(map(tuple, blocks.resolve(asked, there, "k", "t").collect())) == {0: 2, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0}
    asked = spark.createDataFrame([(6, "alone ;;\nLAST;")], "k int, t string")
    assert [r["n"] for r in blocks.resolve(asked, there, "k", "t").collect()] == [1]


def test_a_pinned_reader_holds_every_row_of_its_version(spark, tmp_path):
    sf = save(spark, tmp_path, "events", [(i, "a" if i % 2 else "b") for i in range(1, 1201)], "event_id long, event_type string")
    # b: the even ids, written first and deleted last; a: the odd ones, which came after the version was pinned
    assert sorted((r["event_type"], r["n"], r["later"]) for r in catalog.QUERIES["pattern_snapshot"](spark, sf).collect()) == [("a", 0, 600), ("b", 600, 0)]


def _brute(rows, every, k):
    unit = {i: v / n if (n := np.linalg.norm(v)) else v for i, _, v in rows}
    out = set()
    for q in unit:
        if q % every == 0:
            near = sorted((-round(float(unit[q] @ unit[i]), 6), label, i) for i, label, _ in rows if i != q)
            out |= {(q, i, label, -s) for s, label, i in near[:k]}
    return out


def test_every_hundredth_row_asks(spark, tmp_path, monkeypatch):
    r = np.random.default_rng(3)
    v = r.standard_normal((730, 8)).astype(np.float32)
    v[40:120], v[500] = v[300], 0
    rows = [(i, int(i % 7), v[i].astype(float)) for i in range(len(v)) if i != 7]
    spark.createDataFrame([(i, b, a.tolist()) for i, b, a in rows], "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    expected = _brute(rows, 100, 10)
    assert {(r["query_id"], r["vec_id"], r["label"], r["similarity"]) for r in catalog.QUERIES["knn_topk"](spark, str(tmp_path)).collect()} == expected
    monkeypatch.setattr(nearest, "LIMIT", 64)
    monkeypatch.setattr(nearest, "ROWS", 50)
    assert {(r["query_id"], r["vec_id"], r["label"], r["similarity"]) for r in catalog.QUERIES["knn_topk"](spark, str(tmp_path)).collect()} == expected


def test_admission_goes_by_drift(spark, tmp_path):
    near, far = [1.0, 0.0], [0.0, 1.0]
    rows = [(8, 1, near), (9, 1, near), (10, 2, near), (11, 2, far), (12, 3, [0.0, 0.0]), (13, 3, far), (20, 4, far)]
    sf = save(spark, tmp_path, "embeddings", rows, "vec_id long, label int, embedding array<float>")
    # 8 and 9 resemble the next; 10 and 11 don't, 12 has no direction; 13 and 20 have no next
    assert sorted(map(tuple, catalog.QUERIES["vector_admission"](spark, sf).collect())) == [(1, "original_examples", 2), (3, "fixed_examples", 1), (4, "original_examples", 1)]


def test_boost_keeps_every_row(spark, tmp_path):
    rows = [(u, 30.0 if i <= u % 3 else 1.0) for u in range(60) for i in range(3)]
    sf = save(spark, tmp_path, "events", rows, "user_id long, value double")
    found = catalog.QUERIES["history_boost"](spark, sf).collect()
    assert [r["user_id"] for r in found] == sorted(range(60), key=lambda u: (-(u % 3), u))


def test_keys_of_many_words_match_in_blocks(spark, tmp_path, monkeypatch):
    names = [f"Brand#{i:04d}" for i in range(1300)]
    sf = save(spark, tmp_path, "part", [(0, None), *((i, names[i]) for i in range(1, 1300, 1))], "p_partkey long, p_brand string")
    monkeypatch.setattr(fuzzy, "SHARERS", 50)
    last = {r["p_partkey"]: r["match"] for r in catalog.QUERIES["fuzzy_match"](spark, sf).where("p_partkey in (0, 5, 1299)").collect()}
    near = {i: difflib.get_close_matches(f"Brnad#{i:04d}", names[1:], 1, 0.7)[0] for i in (5, 1299)}
    assert last == {0: None, **near}
