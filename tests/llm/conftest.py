import random

import pytest

LONG = "lorem ipsum " * 30_000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "one"), (None, "text without an id, long enough to have shingles of its own"), (6, LONG), (7, LONG), (8, "a b c d e f g"), (9, "x\0y ▁ é 漢字")]
    return spark.createDataFrame([(i, t, 7, "x", 1.0, True) for i, t in rows], "doc_id long, text string, n int, key string, score double, kept boolean")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def corpus(spark):
    """Copies, near copies, shared passages and random texts."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    vocabulary = [word() for _ in range(400)]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(8, 120))) for _ in range(40)]
    texts = list(base)
    for t in base[:20]:
        for edits in (0, 1, 2, 5):
            w = t.split()
            for _ in range(edits):
                w[r.randrange(len(w))] = word()
            texts.append(" ".join(w))
    texts += [base[i] + " " + base[30] + " " + base[i + 1] for i in range(10)]
    r.shuffle(texts)
    return list(enumerate(texts))
