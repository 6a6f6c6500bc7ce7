"""The audit against its formulas, term by term."""

import random
import re
from collections import Counter, defaultdict

import pytest

from fenlark.llm import divergence


def _expected(rows, least, top):
    """rows: (text, lang, source)."""
    fold = {i: i + 32 for i in range(65, 91)}
    n, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(fold))
        groups.add((lang, source))
        n[lang, source].update(found)
        df[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, c in df[lang].items() if c >= least]
        v = len(kept)

        def shares(count, kept=kept, v=v):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * v) for t in kept}

        whole = sum((n[g] for g in groups if g[0] == lang), Counter())
        p, q = shares(n[lang, source]), shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = []
        for other in groups:
            if other[0] == lang and other != (lang, source):
                r = shares(n[other])
                pairs.append((-sum(f(p[t], r[t]) for t in kept), other[1].encode()))
        words = [(-f(p[t], q[t]), t.encode()) for t in kept if n[lang, source][t] and p[t] > q[t]]
        out += [(lang, source, "pair", i.decode(), -x, k) for k, (x, i) in enumerate(sorted(pairs), 1)]
        out += [(lang, source, "term", i.decode(), -x, k) for k, (x, i) in enumerate(sorted(words)[:top], 1)]
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


@pytest.mark.parametrize("least", [1, 3, 10])
def test_equals_the_formulas(spark, monkeypatch, least):
    monkeypatch.setattr(divergence, "FLUSH", 50)
    r = random.Random(least)
    words = [f"{c}{d}" for c in "abcÄé漢" for d in ["", "x", "Yy", "ß", "ſ"]]
    rows = []
    for _ in range(300):
        lang, source = r.choice(["en", "de", None]), r.choice(["s0", "s0", "s0", "s1", "s2", "é", None])
        text = r.choice([" ", "1", "\0", "-"]).join(r.choices(words[: r.randint(1, len(words))], k=r.randint(0, 30)))
        rows.append((r.choice([text, text, text, None, ""]), lang, source))
    rows += [("1 2 3", "xx", "alone"), ("", "yy", "a"), (None, "yy", "b")]
    assert sorted(map(tuple, divergence.divergence(_frame(spark, rows), least).collect())) == _expected(rows, least, 10)


def test_many_ties_expand_in_order(spark):
    # 60 terms of equal counts: only their bytes decide
    terms = [f"{c}{d}" for c in "abcdefghij" for d in "klmnop"]
    rows = [(" ".join(terms), "en", "s0")] * 3 + [("other", "en", "s1")] * 3
    got = sorted(map(tuple, divergence.divergence(_frame(spark, rows), 2).collect()))
    assert got == _expected(rows, 2, 10)
    assert [r[3] for r in sorted(got, key=lambda r: r[5]) if r[:3] == ("en", "s0", "term")] == sorted(terms)[:10]


def test_one_source_empty_table_and_clashing_columns(spark):
    rows = [("a b", "en", "s0")] * 12
    assert divergence.divergence(_frame(spark, rows)).count() == 0  # no other source, and no term is too often
    assert divergence.divergence(_frame(spark, [])).count() == 0
    rows = [("one two " * 50_000, "en", "s0", "x", 1, 2), ("two", "en", "s1", "y", 1, 2)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string, term string, n int, value int")
    assert sorted(map(tuple, divergence.divergence(docs, 1).collect())) == _expected([r[:3] for r in rows], 1, 10)


def test_large_counts_stay_exact(spark):
    row = spark.range(1).select(divergence._share(divergence.F.lit(10**17), divergence.F.lit(3 * 10**17), divergence.F.lit(5)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (10**17 + 2) // (3 * 10**17 + 10)
