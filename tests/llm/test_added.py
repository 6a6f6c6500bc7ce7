"""What the methods of op6 and op9 add to the fixed patterns, against plain Python over the same models and templates."""

import random
import re
import string

from fenlark.llm import licenses, secrets


def _tokens(r):
    signs = string.ascii_letters + string.digits + "+/_-="
    kind = r.randrange(5)
    if kind == 0:
        return "".join(r.choice(signs) for _ in range(r.randrange(15, 70)))
    if kind == 1:
        return r.choice("_-/").join(r.choice(secrets.PARTS) for _ in range(r.randrange(2, 7))) + str(r.randrange(100))
    if kind == 2:
        return "".join(r.choice(secrets.PARTS).title() for _ in range(r.randrange(2, 6))) + r.choice(["", "2", "Ab3"])
    if kind == 3:
        return r.choice(["token = ", "AKIA", "password: '"]) + "".join(r.choice("ABCDEF0123456789abcdef") for _ in range(r.randrange(4, 45)))
    return r.choice(["é", "word", "\n", "12345", "🙂", ""])


def _looks_random(word, ratios):
    at = [secrets.SIGNS.find(c) + 1 for c in word]
    total = 0.0
    for a, b in zip(at, at[1:], strict=False):
        total += float(f"{ratios[a * (len(secrets.SIGNS) + 1) + b]:.6g}")
    return total / (len(word) - 1) >= secrets.LEAST


def test_random_strings_equal_python(spark):
    r = random.Random(5)
    texts = [r.choice([" ", "", "; "]).join(_tokens(r) for _ in range(r.randrange(12))) for _ in range(300)] + ["", None, "x" * 30_000 + " a1" * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ratios, added = secrets.train(secrets.labelled_sample(docs)), 0
    for row in secrets.find_secrets(docs, ratios).collect():
        found = [(s["start"], s["end"]) for s in row["secret_spans"] if s["rank"] == 4]
        base = [(s["start"], s["end"]) for s in row["secret_spans"] if s["rank"] < 4]
        expected = []
        for m in re.finditer(secrets.WORD, row["text"] or ""):
            w, (a, b) = m[0], m.span()
            if re.search("[0-9]", w) and re.search("[A-Za-z]", w) and _looks_random(w, ratios) and not any(c < b and a < d for c, d in base):
                expected.append((a, b))
        assert sorted(found) == expected, row["text"]
        added += len(found)
    assert added > 100


def _by_hand(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words, labels, best = re.findall(licenses.WORD, low), set(), 0.0
    for label, template in licenses.TEMPLATES:
        own = re.findall(licenses.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), template))
        votes = {}
        for pos in range(len(words) - 2):
            for at in range(len(own) - 2):
                if words[pos : pos + 3] == own[at : at + 3]:
                    votes.setdefault(pos - at, []).append((pos, at))
        groups, last = [], None
        for d in sorted(votes):
            if last is None or d - last > licenses.NEAR:
                groups.append([])
            groups[-1] += votes[d]
            last = d
        for g in groups:
            covered = len({at + j for _, at in g for j in range(3)})
            start, end = min(p for p, _ in g), max(p for p, _ in g) + 3
            if (covered / len(own) >= licenses.COVER or covered >= licenses.LONG) and end - start <= covered * 3 / 2:
                labels.add(label)
                best = max(best, covered / len(own))
    places = [(i, k) for p, k in licenses.PHRASES for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
    return ",".join(sorted(labels | {k for _, k in places})), 1.0 if places else best


def _noisy(r):
    words = []
    for _ in range(r.randrange(1, 4)):
        own = r.choice(licenses.TEMPLATES)[1].split()
        cut = r.randrange(len(own))
        own = own[cut:] + own[:cut] if r.random() < 0.2 else own[: r.randrange(len(own) // 2, len(own) + 1)] if r.random() < 0.4 else own
        for w in own:
            x = r.random()
            words += [] if x < 0.02 else [w, "stray"] if x < 0.04 else [w.upper()] if x < 0.3 else [w]
        words += ["Other", "prose", "stands", "between"] * r.randrange(3)
    return " ".join(words)


def test_labels_of_templates_equal_python(spark):
    r = random.Random(8)
    texts = [_noisy(r) for _ in range(150)] + ["", None, "Licensed under", "Licensed under the MIT License " * 40]
    found = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(found) == len(texts)
    some = 0
    for row in found:
        labels, score = _by_hand(texts[row["doc_id"]])
        assert (row["labels"], round(row["score"], 9)) == (labels, round(score, 9)), texts[row["doc_id"]]
        some += row["labels"] != row["base_labels"]
    assert some > 50
