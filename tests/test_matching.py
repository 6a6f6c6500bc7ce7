"""Patches and rule indexes against their plain forms."""

import difflib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fenlark.operators import diff, rules

LINES = st.lists(st.sampled_from(["a", "b", "c", "", " x", "-y", "+z", "@@ -1 +1 @@"]), max_size=25).map("\n".join)


@settings(max_examples=500, deadline=None)
@given(LINES, LINES)
def test_a_patch_gives_the_other_text(a, b):
    patch = diff.unified(a, b)
    assert diff.patched(a, patch) == b and (patch == "") == (a == b)
    kept = diff.common(a.split("\n"), b.split("\n"))
    assert all(a.split("\n")[i] == b.split("\n")[j] for i, j in kept) and kept == sorted(set(kept)) and [j for _, j in kept] == sorted({j for _, j in kept})


def test_patches_are_small_and_read_like_others():
    r = random.Random(1)
    for _ in range(50):
        a = [f"line {r.randrange(400)}" for _ in range(r.randint(0, 300))]
        b = [x for x in a if r.random() > 0.1]
        for _ in range(r.randint(0, 20)):
            b.insert(r.randrange(len(b) + 1), f"new {r.random()}")
        mine = sum(i1 - i0 + j1 - j0 for i0, i1, j0, j1 in diff.changes(a, b))
        ours = sum(i2 - i1 + j2 - j1 for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, a, b, False).get_opcodes() if tag != "equal")
        assert mine <= 1.2 * ours + 4
    a, b = "a\nb\nc\nd\ne\nf\ng\nh\ni\nj\nk", "a\nB\nc\nd\ne\nf\ng\nh\ni\nj\nk\nl"
    assert diff.unified(a, b).split("\n") == list(difflib.unified_diff(a.split("\n"), b.split("\n"), lineterm=""))
    assert diff.patched("x\ny", diff.unified("a\nb", "a\nc")) is None


def test_repeated_lines_beyond_the_table(monkeypatch):
    monkeypatch.setattr(diff, "CELLS", 4)
    a, b = "\n".join("ab" * 40), "\n".join("ba" * 50)
    assert diff.patched(a, diff.unified(a, b)) == b
    long = "\n".join(["same"] * 50_000)
    assert diff.patched(long, diff.unified(long, "x\n" + long)) == "x\n" + long


def test_patch_columns(spark):
    d = spark.createDataFrame([("x\ny", "x\nz"), ("same", "same"), (None, "new"), ("gone", None)], "a string, b string")
    p = d.withColumn("p", diff.unified_diff(F.col("a"), F.col("b"))).withColumn("back", diff.apply_patch(F.col("a"), F.col("p")))
    rows = p.select("back", diff.added(F.col("p")).alias("more"), diff.removed(F.col("p")).alias("less")).collect()
    assert [r["back"] for r in rows] == ["x\nz", "same", "new", ""]
    assert [(r["more"], r["less"]) for r in rows] == [(["z"], ["y"]), ([], []), (["new"], [""]), ([""], ["gone"])]


def test_literals_that_all_matches_hold():
    found = {p: rules.literal(p) for p in (r"\.Save\(", r"Console\.WriteLine\([^)]*\)", "(?i)ABC|d", "(?:abcd)+x?yz", "a{0,3}bc", "[abc]de*f", r"\Qx", "(?=zzz)q", "")}
    assert found == {r"\.Save\(": ".save(", r"Console\.WriteLine\([^)]*\)": "console.writeline(", "(?i)ABC|d": "", "(?:abcd)+x?yz": "abcd", "a{0,3}bc": "bc", "[abc]de*f": "d", r"\Qx": "", "(?=zzz)q": "q", "": ""}
    assert all(x in re.search(p, t).group().lower() for p, t, x in ((r"(ab|cd)efg?h", "cdefh", rules.literal(r"(ab|cd)efg?h")), (r"x(?:yy){2,}z+", "xyyyyzz", rules.literal(r"x(?:yy){2,}z+"))))


def _rules(r, words, n):
    out = []
    for i in range(n):
        a, b, c = r.choice(words), r.choice(words), r.choice(words)
        code, required = (rf"{a}\s+{b}", None) if i % 4 < 2 else (f"(?i){a}.{{0,9}}{b}?", None) if i % 4 == 2 else (None, a)
        out.append((f"R{i:05d}", "error", "x", code, c if i % 3 == 0 else None, required, [b] if required or i % 5 == 0 else [], [c] if i % 7 == 0 else [], ["kb"] if i % 6 == 0 else []))
    out += [("always", "error", "x", "[qz]", None, None, [], [], []), ("never", "error", "x", None, None, None, [], [], []), ("java", "info", "x", r"\Q.Go(\E", None, None, None, None, None), ("blank", "info", "x", None, None, "zq", [""], [], [])]
    return out


@pytest.mark.parametrize("bound", [rules.BYTES, 2000])
def test_rules_by_literals_equal_all_against_all(spark, bound):
    r = random.Random(bound)
    words = ["".join(r.choices("abcdefghij", k=r.randint(3, 7))) for _ in range(3000)]
    docs = [(i, " ".join(r.choices(words[:400], k=40)).replace("a", "A" if i % 3 == 0 else "a") + (" .Go(" if i == 3 else ""), " ".join(r.choices(words[:400], k=5)), r.choice(["kb", "blog"])) for i in range(60)] + [(60, None, None, "kb"), (61, "", "", None)]
    d = spark.createDataFrame(docs, "id long, text string, blob string, type string")
    listed = _rules(r, words, 400 if bound == 2000 else 2000)
    table = spark.createDataFrame(listed, rules.FIELDS)
    got = sorted(map(tuple, rules.findings(d, table, bound).select("id", "rule", "matched").collect()), key=str)
    every = d.select("id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("blob", F.lit("")).alias("blob"), "type").join(table.withColumnRenamed("id", "rule"), (F.size(F.coalesce("types", F.array().cast("array<string>"))) == 0) | F.array_contains("types", F.col("type")))
    want = every.where(rules.speaks()).select("id", "rule", F.when(F.col("required").isNull(), F.substring(F.regexp_substr("text", F.concat(F.lit("(?ms)"), F.col("code"))), 1, 120)).alias("matched"))
    assert got == sorted(map(tuple, want.collect()), key=str) and len(got) > 20


def test_ten_thousand_rules_are_tried_where_their_literals_are(spark):
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(6, 9))) for _ in range(20_000)]
    docs = spark.createDataFrame([(i, " ".join(r.choices(words, k=100)), "b", "kb") for i in range(100)], "id long, text string, blob string, type string")
    listed = [dict(zip(("id", "severity", "issue", "code", "missing", "required", "intent", "context", "types"), (f"{i}", "e", "x", words[i], None, None, [], [], []), strict=True)) for i in range(10_000)]
    assert rules.candidates(docs, listed).count() < 100 * 10_000 / 100


def test_no_rules_and_no_texts(spark):
    docs = spark.createDataFrame([(1, "x", "y", "kb")], "id long, text string, blob string, type string")
    none = spark.createDataFrame([], rules.FIELDS)
    assert rules.findings(docs, none).count() == 0 and rules.findings(docs.limit(0), spark.createDataFrame([("a", "e", "i", "xxx", None, None, [], [], [])], rules.FIELDS)).count() == 0
