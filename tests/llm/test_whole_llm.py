"""Training-data operators that once did a part of their job: what the part left out."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fenlark.llm import ann, decontaminate, licenses, minhash, pieces, pii, quality, secrets, suffix_dedup, warc


def test_rounds_share_statistics(spark, monkeypatch):
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(6, 40))) + ". " + " ".join(r.choices(vocabulary, k=4))) for i in range(40)]
    # items with some words exchanged lie on both sides of the threshold
    docs = [(100 * i + k, " ".join(w if r.random() > k / 20 else "other" for w in t.split())) for i, t in items for k in range(12)]
    items, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    found = lambda: sorted(map(tuple, decontaminate.find_leaks(docs, items, 0.5, 0.1).collect()))
    kept = lambda: sorted(r["doc_id"] for r in decontaminate.without_leaks(docs, items, 0.5, 0.1).collect())
    one, left = found(), kept()
    assert 0 < len({x[0] for x in one}) < 480
    monkeypatch.setattr(decontaminate, "LIMIT", 1500)
    assert found() == one and kept() == left


def test_classes_weigh_alike_and_all_columns_count():
    # one document in 50 is bad; 5,000 columns tell it apart, each in every bad document and some good ones
    told = np.arange(5000, dtype=np.int32)
    rows = [told if i % 50 == 0 else np.array([6000 + i % 7], np.int32) for i in range(2000)]
    labels = np.array([0.0 if i % 50 == 0 else 1.0 for i in range(2000)])
    w = quality.fit(rows, labels, steps=20)
    assert (w[told] < 0).all()
    # the same evidence in both classes says nothing, however rare one is
    w = quality.fit([np.zeros(1, np.int32)] * 2000, labels)
    assert abs(w[-1] + quality.value_of(np.zeros(1))[0] * w[0]) < 0.1


def _brute_leaks(docs, items, threshold, overlap):
    """Every window against every item, from the formulas alone."""
    word = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    bags = {i: Counter(word(t)) for i, t in items}
    size = {i: sum(b.values()) for i, b in bags.items()}
    n, mean, step = len(items), sum(size.values()) / len(items), max(size.values())
    df = Counter(w for b in bags.values() for w in b)

    def impact(w, i):
        f = bags[i][w]
        return math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size[i] / mean))

    def share(part, w):
        part = word(part)
        k = min(5, len(part))
        grams = lambda x: {tuple(x[j : j + k]) for j in range(len(x) - k + 1)}
        return len(grams(part) & grams(w)) / len(grams(part)) if part else 1.0

    out = {}
    for d, t in docs:
        w = word(t)
        for low in range(0, len(w), step):
            window = w[low : low + 2 * step]
            for i, text in items:
                score = sum(impact(x, i) for x in bags[i] if x in set(window)) / sum(impact(x, i) for x in bags[i])
                q, a = (share(p, window) for p in decontaminate.split_item(text))
                if score >= threshold and q >= overlap and a >= overlap:
                    out[d, i] = max(out.get((d, i), (0, 0, 0)), (score, q, a))
    return out


@pytest.mark.parametrize("limit", [8 << 20, 900])
def test_leaks_equal_brute_force(spark, monkeypatch, limit):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(5, 30))) + ". " + " ".join(r.choices(vocabulary, k=r.randint(1, 6)))) for i in range(30)]
    docs = []
    for k in range(60):
        w = r.choices(vocabulary, k=r.randint(0, 150))
        for _ in range(3):
            part = [x if r.random() > 0.06 else "zz" for x in r.choice(items)[1].split()]
            at = r.randint(0, len(w))
            w[at:at] = part
        docs.append((k, " ".join(w)))
    monkeypatch.setattr(decontaminate, "LIMIT", limit)
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 0.5, 0.4).collect()
    expected = _brute_leaks(docs, items, 0.5, 0.4)
    got = {(x["doc_id"], x["item_id"]): tuple(x)[2:] for x in found}
    assert len(expected) > 30 and set(got) == set(expected)
    assert all(max(abs(a - b) for a, b in zip(got[k], expected[k], strict=True)) < 1e-9 for k in got)


def test_built_words_do_not_collide(spark):
    one, two = b"a", b"b"
    for _ in range(12):
        one, two = one + two, two + one
    rows = []
    for n in (512, 1024, 2048, 4096):
        for x in (one[:n].decode(), one[:n].decode().translate(str.maketrans("ab", "ba"))):
            rows += [(len(rows), x), (len(rows) + 1, f"some words stand before {x} and some after it")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i for i, _ in rows}


@pytest.mark.parametrize("percent", [80, 85])
def test_large_groups_of_near_copies_equal_brute_force(spark, percent, monkeypatch):
    monkeypatch.setattr(minhash, "SHARERS", 7)
    r = random.Random(percent)
    word = lambda: f"w{r.randrange(10**6)}"
    common, own = [word() for _ in range(60)], [[word() for _ in range(4)] for _ in range(132)]
    texts = [common + own[i] + own[i + 1] + own[i + 2 - i % 2] for i in range(130)]  # parts shared with neighbours
    base = [word() for _ in range(50)]
    for _ in range(120):
        t = list(base)
        for _ in range(r.randint(0, 3)):
            t[r.randrange(50)] = word()
        texts.append(t)
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    of = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and of[a] != of[b]:
                low, high = sorted((of[a], of[b]))
                of = [low if x == high else x for x in of]
    compared = []
    original = minhash._prefix_pairs
    monkeypatch.setattr(minhash, "_prefix_pairs", lambda *x: compared.append((p := original(*x)).count()) or p)
    found = minhash.near_duplicates(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string"), percent).collect()
    assert {x["doc_id"]: x["component_id"] for x in found} == dict(enumerate(of))
    assert compared[0] < 0.05 * 250 * 249 / 2


BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def _personal(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE_PATTERNS.items(), 1):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")[:4]) if kind == "ip" else True, "card": 13 <= len(d) <= 19 and _luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append((rank, m.start(), m.end()))
    return out


def _hostile():
    r = random.Random(8)
    bits = ["@", "a.b", "c-d.org", "x@y.z", "@@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111", "+", "+1 (555) 010-9999", "0", "12", " ", "-", "é", "漢", "😀", ".", "token=", "secret: ", "AKIA", "ABCDEF0123456789", "abcdef0123456789" * 2, "password", '"', "'", "passWD:", "api-key =", "apikey", "K", "cc", "by", "CC-BY", "General Public License", "all rights reserved", "ſ", "İ"]
    texts = ["".join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randint(0, 40))) for _ in range(150)]
    return [None, "", "9" * 20_000, "a" * 20_000 + "@b.c", "1." * 10_000, "+1" * 5_000, *texts]


def test_base_spans_equal_python(spark):
    docs = list(enumerate(_hostile()))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = pii.find_personal(frame, {}, 2.0).select("doc_id", "pii_spans").collect()
    assert {r["doc_id"]: sorted(tuple(s) for s in r["pii_spans"]) for r in found} == {i: sorted(_personal(t or "")) for i, t in docs}
    assign = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    expected = {}
    for i, t in docs:
        t = t or ""
        rows = [(1, m.start(), m.end()) for m in assign.finditer(t) if len(m.group(2)) >= 8 and m.group(1).isascii()]
        rows += [(2, m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 16]
        rows += [(3, m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 32]
        expected[i] = sorted(rows)
    found = secrets.find_secrets(frame, [0.0] * 63 * 63, 9.0).select("doc_id", "secret_spans").collect()
    assert {r["doc_id"]: sorted(tuple(s) for s in r["secret_spans"]) for r in found} == expected


def test_base_labels_equal_python(spark):
    docs = list(enumerate(_hostile()))
    found = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        at = sorted((k, label) for p, label in licenses.PHRASES for k in range(len(w)) if tuple(w[k : k + len(p)]) == p)
        assert (found[i]["n_words"], found[i]["n_base"], found[i]["base_labels"]) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (found[i]["first_word"], found[i]["last_word"]) == ((at[0][0], at[-1][0]) if at else (None, None))


def test_classifier_adds_what_patterns_miss(spark):
    r = random.Random(6)
    filler = lambda: " ".join(r.choice("the of and river stone light paper over near under".split()) for _ in range(r.randint(4, 12)))
    digits = lambda n: "".join(str(r.randint(0, 9)) for _ in range(n))
    good = {
        "person": lambda: (r.choice(["signed ", "contact ", "by ", ""]), f"{r.choice(pii.GIVEN).capitalize()} {r.choice(pii.FAMILY).capitalize()}"),
        "handle": lambda: (r.choice(["mail ", "write to ", ""]), r.choice([f"{r.choice(pii.GIVEN)} (at) mail{digits(2)} (dot) org", f"{r.choice(pii.GIVEN)} at mail{digits(2)} dot com"])),
        "national": lambda: (r.choice(["ssn ", "social security ", ""]), f"{r.randint(100, 650)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"),
        "contact": lambda: (r.choice(["phone ", "call ", ""]), f"({r.randint(200, 989)}) {r.randint(200, 999)}-{digits(4)}"),
    }
    bad = {"national": lambda: ("part ", f"000-{digits(2)}-0000"), "contact": lambda: (r.choice(["serial ", "invoice #", "model "]), f"{r.choice('01')}{digits(2)} {r.choice('01')}{digits(2)} {digits(4)}")}
    docs, truth = [], {}
    for i in range(600):
        text, spans = "", []
        for _ in range(r.randint(0, 3)):
            from_ = good if r.random() < 0.6 else bad
            kind = r.choice(sorted(from_))
            before, match = from_[kind]()
            text += filler() + ". " + before
            if from_ is good:
                spans.append((pii.KINDS.index(kind) + 1, len(text), len(text) + len(match)))
            text += match + ". "
        docs.append((i, text + filler()))
        truth[i] = spans
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    weights = pii.train(frame.where("doc_id % 2 = 0"))
    found = pii.find_personal(frame.where("doc_id % 2 = 1"), weights).collect()
    hit = sum(len({tuple(s) for s in x["pii_spans"]} & set(truth[x["doc_id"]])) for x in found)
    assert hit > 0.85 * sum(len(truth[x["doc_id"]]) for x in found) and hit > 0.9 * sum(len(x["pii_spans"]) for x in found)


def test_models_tell_keys_from_real_identifiers(spark):
    import keyword
    import os
    import random as rnd
    import string
    import tokenize

    names = set()
    for module in (os, rnd, string, tokenize, keyword, re):  # identifiers that people wrote, of 20 characters and more
        with open(module.__file__) as f:
            names |= set(re.findall(r"(?<![A-Za-z0-9_])[A-Za-z][A-Za-z0-9_]{11,}", f.read()))
    r = random.Random(1)
    keys = ["".join(r.choice(string.ascii_letters + string.digits) for _ in range(r.randint(20, 40))) for _ in range(300)]
    ratios = secrets.train(secrets.labelled_sample(spark.createDataFrame([], "doc_id long, text string")))
    rows = [(n, False) for n in sorted(names)] + [(k, True) for k in keys]
    assert secrets.find_secrets(spark.createDataFrame([(k,) for k in keys if re.search("[0-9]", k)], "text string"), ratios).where("size(secret_spans) <> 1").count() < 10
    scored = spark.createDataFrame(rows, "text string, random boolean").select("random", secrets.score(F.col("text"), ratios).alias("s")).collect()
    caught = [x["s"] >= secrets.LEAST for x in scored if x["random"]]
    wrong = [x["s"] >= secrets.LEAST for x in scored if not x["random"]]
    assert len(wrong) > 100 and sum(caught) > 0.97 * len(caught) and sum(wrong) < 0.03 * len(wrong)


def test_warc_files_are_bounded_and_keep_segments_together(spark, tmp_path):
    r = random.Random(2)
    big = "".join(chr(r.randint(32, 0x2FFF)) for _ in range(1_500_000))  # some 4 MB in UTF-8: several segments
    rows = [(i, f"u{i}", "".join(r.choices("abcdef ", k=r.randint(0, 400)))) for i in range(3000)]
    rows += [(5000, "big", big), (5001, "big", big), (5002, None, big[:-1]), (5003, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, str(tmp_path / "w"), most_rows=1)
    sizes = [f.stat().st_size for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    assert len(sizes) > 3 and max(sizes) < 8 << 20
    got = {x["page_id"]: x for x in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        payload = (html or "").encode()
        assert got[i]["payload_bytes"] == len(payload) and got[i]["payload_digest"] == hashlib.sha256(payload).hexdigest()
    assert (got[5001]["record_type"], got[5001]["refers_to"]) == ("revisit", 5000) and got[5002]["record_type"] == "response"


def test_multikey_classes_are_equal_strings():
    r = np.random.default_rng(3)
    base = r.integers(97, 100, 300).astype(np.uint8)
    data = np.concatenate([np.where(r.random(300) < 0.01, r.integers(97, 123, 300), base).astype(np.uint8) for _ in range(60)])
    start = r.integers(0, len(data) - 100, 4000) // 20 * 20
    tag = start % 300
    of = suffix_dedup.multikey(data, start, tag)
    texts = [(t, data[s : s + 100].tobytes()) for t, s in zip(tag.tolist(), start.tolist(), strict=True)]
    assert len(set(zip(texts, of.tolist(), strict=True))) == len(set(texts)) == len(set(of.tolist()))
    assert len(suffix_dedup.multikey(data, start[:0], tag[:0])) == 0


@pytest.mark.parametrize("stage", ["quality", "near_dedup", "decontaminate", "pii", "sentencepiece"])
def test_stages_cope_with_odd_rows(spark, stage):
    import corpus_pipeline

    run = dict(corpus_pipeline.STAGES)[stage]
    names = "doc_id long, text string, lang string, source string, n_chars long, kept int, id string, quality string, pii_spans string, component_id int, score double"
    long = " ".join(f"word{i}" for i in range(40_000))
    texts = [(1, None), (2, ""), (3, " \n"), (4, "a few plain words that stand here alone"), (4, "a few plain words that stand here alone"), (5, "a few plain words that stand here alone"), (None, "words without an id to them"), (None, None), (6, long), (7, "mail me at some.one@mail.org please"), (7, "another text under the same id")]
    docs = spark.createDataFrame([(i, t, None, "s", 3, 9, "x", "q", "p", 1, 0.5) for i, t in texts], names)
    out = run(spark, docs, "/root/testdata/sf0.001")
    if stage != "sentencepiece":
        assert out.schema == docs.schema
    rows = out.collect()
    assert all((r["kept"], r["id"], r["quality"], r["pii_spans"], r["component_id"]) == (9, "x", "q", "p", 1) for r in rows)
    left = Counter((r["doc_id"], r["text"]) for r in rows)
    if stage == "near_dedup":
        assert left == Counter([(1, None), (2, ""), (3, " \n"), (4, texts[3][1]), (None, texts[6][1]), (None, None), (6, long), (7, "another text under the same id")])
    elif stage == "pii":
        assert left == Counter([(i, t.replace("some.one@mail.org", "[EMAIL]") if t else t) for i, t in texts])
        assert all(r["n_chars"] == (len(r["text"]) if "[EMAIL]" in (r["text"] or "") else 3) for r in rows)
    else:
        assert left == Counter(texts)
    nothing = run(spark, docs.limit(0), "/root/testdata/sf0.001")
    assert nothing.count() == 0


def test_stages_against_brute_force(spark):
    """Each stage's rows, one after the other, against the plain rules they stand for."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = corpus_pipeline.table(spark, sf, "documents")
    kept = corpus_pipeline.classify(spark, docs, sf).collect()
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = {i for i, q in labels.items() if q == (1, 0)}
    assert len(good & {r["doc_id"] for r in kept}) > 0.9 * len(good)
    docs = spark.createDataFrame(kept, docs.schema)
    sets = {}
    for r in kept:
        w = (r["text"] or "").encode().lower().split()
        sets[r["doc_id"]] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    of = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and of[a] != of[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((of[a], of[b]))
                of = {k: low if v == high else v for k, v in of.items()}
    once = corpus_pipeline.deduplicate(spark, docs, sf).collect()
    assert sorted(r["doc_id"] for r in once) == sorted(i for i in of if of[i] == i)
    docs = spark.createDataFrame(once, docs.schema)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    held = {r["doc_id"]: " ".join(word(r["text"])) for r in once}
    whole = {d for d, t in held.items() if any(f" {' '.join(word(x))} " in f" {t} " for _, x in items)}
    clean = corpus_pipeline.decontaminated(spark, docs, sf).collect()
    gone = {r["doc_id"] for r in once} - {r["doc_id"] for r in clean}
    assert whole <= gone and len(gone - whole) <= 0.02 * len(once)
    docs = spark.createDataFrame(clean, docs.schema)
    safe = {r["doc_id"]: r["text"] for r in corpus_pipeline.redact(spark, docs, sf).collect()}
    for r in clean:
        text, at = "", 0
        for rank, start, end in sorted(_personal(r["text"] or ""), key=lambda s: (s[1], s[2])):
            if start >= at:
                text += (r["text"] or "")[at:start] + f"[{pii.KINDS[rank - 1].upper()}]"
            at = max(at, end)
        assert safe[r["doc_id"]] == (None if r["text"] is None else text + r["text"][at:])


def test_long_units_are_encoded_alike(monkeypatch):
    loaded = pieces.load_pieces()
    a = pieces.Automaton(loaded)
    r = random.Random(9)
    texts = ["".join(r.choice("abcdeéß漢字😀") for _ in range(r.randint(30, 400))) for _ in range(40)] + ["a" * 3000, "漢" * 500, "x" * 40]
    units = [a.marked(t) for t in texts]
    ids, at = a.encode(units)
    monkeypatch.setattr(pieces, "FEW", 0)
    other, there = a.encode(units)
    assert ids.tolist() == other.tolist() and at.tolist() == there.tolist()
    assert [a.decode(ids[i:j].tolist()) for i, j in zip(at[:-1], at[1:], strict=True)] == texts


def test_nearest_copes_with_odd_rows(spark):
    names = "vec_id long, embedding array<float>, v int, id string, asks string, qid int, cid int, t int, score string"
    row = lambda i, x: (i, x, 1, "a", "b", 2, 3, 4, "c")
    r = np.random.default_rng(4)
    v = r.normal(size=(60, 5)).astype(np.float32)
    v[30:60] = v[0]  # half of all rows are one vector
    rows = [row(i, x.tolist()) for i, x in enumerate(v)] + [row(7, [9.0] * 5), row(7, [9.0] * 5), row(None, [1.0] * 5), row(61, None), row(62, []), row(63, [1.0, None, 0.0, 0.0, 0.0]), row(64, [float("inf")] * 5), row(65, [0.0] * 5), row(66, [1.0, 2.0])]
    least = min(v[7].tolist(), [9.0] * 5)
    v[7] = least
    found = ann.nearest(spark.createDataFrame(rows, names), k=5, every=20).collect()
    exact = v.astype(float) @ v.astype(float).T
    for q in (0, 20, 40):
        best = sorted((-exact[q, i], i) for i in range(60) if i != q)[:5]
        got = sorted((x["rank"], x["vec_id"], x["score"]) for x in found if x["query_id"] == q)
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        assert len({g[1] for g in got} & {i for _, i in best}) >= 4 and all(abs(exact[q, i] - s) < 1e-9 for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
    assert {x["query_id"] for x in found} == {0, 20, 40}
    assert ann.nearest(spark.createDataFrame([row(61, None), row(0, None)], names)).count() == 0
    assert ann.nearest(spark.createDataFrame([row(0, [1.0, 2.0])], names)).count() == 0


def test_built_hash_collisions_link_nothing(spark):
    """Words whose mixed 64-bit hashes are equal: pairs solved for, in texts of one and of six words."""
    a, b = "ieqh524yng5by1a2", "wtxfwpfrwj9?|oa."
    one = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()}
    assert one == {1: 1, 2: 2}
    six = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame([(1, a + " t u v w"), (2, b + " t u v w")], "doc_id long, text string")).collect()}
    assert six == {1: 1, 2: 2}


def test_links_need_no_hash(spark, monkeypatch):
    """Were every word to hash alike, candidates would be many and the links still those of the words."""
    monkeypatch.setattr(minhash.xxhash, "xxh3_64_intdigest", lambda x, seed=0: 7)
    for size in (16, 24, 40):
        x = [("ab" * size)[:size - 1] + c for c in "xyz"]
        assert minhash.in_common(f"{x[0]} b c d e f".encode(), f"{x[1]} b c d e f".encode(), 5) == 1
        assert len(minhash.shingled([minhash.normal(f"{x[0]} b c d e {x[1]} b c d e {x[2]}".encode())], 5, 1)[0]) == 7
    # rows are told apart by words where hashes can't
    sets = minhash.shingled([t.encode().split() for t in ("a b c d e f", "a b c d e g", "a b c d e f a b c d e f")], 5, 3)
    assert [len(s) for s in sets] == [2, 2, 6]


def test_grams_of_many_words_are_told_apart():
    r = np.random.default_rng(1)
    ids = r.integers(0, 300_000, 5000)
    ids[2500:2600] = ids[100:200]
    got, words = minhash.grams(ids, 5), [tuple(ids[i : i + 5].tolist()) for i in range(4996)]
    of = {}
    assert all(of.setdefault(w, g) == g for w, g in zip(words, got.tolist(), strict=True)) and len(set(of.values())) == len(of) == len(set(words))


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 1])
def test_windows_of_equal_polynomial_hash_stay(spark, monkeypatch, crowd):
    """Texts that share no 100-byte string, built to have equal polynomial hashes, lose nothing."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    head, tail = "unbxjegbjccjjxfnsiearbs gsof ywtqbmgldgsvnsgpdvmjqpaktmjafgkzszekngivd", "yxeaaataaaazta mrl vrpyrhcxbceffrgiyktq ilkkdjhtywpesrydkbncmze ekdtszmcsrhsciljsrdo"
    one, two = head + "qfazatahal" + tail, ""
    middle = one[len(head) :][:24]
    two = head + "aamajatawaaaaztsahuvvaaq" + one[len(head) + len(middle) :]
    grams = lambda t: {t[i : i + 100] for i in range(len(t) - 99)}
    assert len(one) == len(two) == 164 and not grams(one) & grams(two)
    rows = suffix_dedup.remove_repeats(spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string"), False).collect()
    assert {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in rows} == {1: (0, 0), 2: (0, 0), 3: (164, 1)}


def _recall(rows, k=20, every=20):
    x = np.array([v for _, v in rows])
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    return {i: set(np.argsort(-score[i], kind="stable")[:k].tolist()) for i in range(0, len(rows), every)}


@pytest.mark.parametrize("kind", ["clustered", "random"])
def test_recall_holds_where_probes_run_out(spark, monkeypatch, kind):
    """With few probes allowed, buckets grow until they are enough; on clustered and on random vectors."""
    r = np.random.default_rng(3)
    middle = r.normal(size=(30, 16))
    x = middle[r.integers(0, 30, 3000)] + 0.3 * r.normal(size=(3000, 16)) if kind == "clustered" else r.normal(size=(3000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x / np.linalg.norm(x, axis=1)[:, None])]
    monkeypatch.setattr(ann, "MOST", 3)
    got: dict = {}
    for q in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(q["query_id"], set()).add(q["vec_id"])
    want = _recall(rows)
    assert np.mean([len(got[i] & want[i]) / 20 for i in want]) >= 0.9


def test_probes_that_are_not_enough_say_so(monkeypatch):
    r = np.random.default_rng(1)
    x = r.normal(size=(2000, 16))
    trial = x[:50], [x[np.argsort(-(x @ q))[1:21]] for q in x[:50]]
    rotations = ann.Rotations(16, 1.0, 9.0, 200_000, 2)
    monkeypatch.setattr(ann, "MOST", 2)
    assert ann.fit_probes(rotations, *trial) is None
    coarse, probes = ann.fitted(16, 1.0, 9.0, 200_000, 2, trial)
    assert coarse.buckets < rotations.buckets and probes <= coarse.buckets


def test_a_document_that_comes_very_often_is_one_of_the_sample(spark, monkeypatch):
    texts = ["one fine day in the quiet old town by the sea", "### $$$ %%% *** ||| ### $$$", "you pathetic moron and worthless scum"]
    rows = [(i, texts[i % 3] + f" number {i}") for i in range(60)] + [(7, texts[0] + f" again {i}") for i in range(5000)] + [(None, "x")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda r, y, *a, **b: (seen.append((len(r), sum(map(len, r)))), fit(r, y, *a, **b))[1])
    quality.train(docs)
    assert max(n for n, _ in seen) == 60
    most = max(size for _, size in seen)
    seen.clear()
    monkeypatch.setattr(quality, "BYTES", 4 * most // 2)
    quality.train(docs)
    assert 0 < max(n for n, _ in seen) < 60 and 4 * max(size for _, size in seen) <= 4 * most // 2


def test_scores_equal_the_formula(spark):
    """Each text alone, feature by feature."""
    r = random.Random(4)
    texts = [" ".join(r.choice(["sea", "Town", "###", "MORON", "a|b", "é", "12", "fine."]) for _ in range(r.randint(1, 40))) for _ in range(80)] + ["", None, "  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = quality.train(docs)
    model.weights = {k: np.random.default_rng(i).normal(size=len(w)) for i, (k, w) in enumerate(model.weights.items())}
    for row in quality.scored(docs, model).collect():
        t = (texts[row["doc_id"]] or "").encode()
        m = quality.measures([t])
        column = set(zip(*(x.tolist() for x in quality.hashed(*m)[1:]), strict=True))
        for name, p in (("quality", row["quality"]), ("clean", row["clean"])):
            w = model.weights["quality" if name == "quality" else "toxic"]
            z = sum(w[c] * v for c, v in column) + w[-1]
            assert p == pytest.approx(1.0 if not t.split() else 1 / (1 + math.exp(-max(-30, min(30, z)))))
