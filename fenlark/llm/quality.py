"""Quality classifier: labellers' accuracies by expectation-maximisation, posterior labels, a hashed linear scorer."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MARKS, U, chunks, dropped, mix, smallest, table, texts_of, words, written

SAMPLE = 4000  # documents, those of smallest hash, on which the scorers are fitted
BYTES = 256 << 20  # of their columns that reach the driver; with more, the first documents by hash are the sample
SIZE = 1 << 17  # hashed features of each family
FOLDS, LOST = 4, 0.01  # of the good ones held out in so many folds, the share that may be judged bad
HEAD = 4  # bytes of a word's beginning
# Words that insult, in the languages of the documents.
INSULTS = [
    "moron", "loser", "pathetic", "worthless", "scum", "idiot", "clown", "disgusting", "trash", "stupid",
    "asshole", "bastard", "bitch", "cretin", "dickhead", "dimwit", "dipshit", "dumbass", "fuckwit", "halfwit", "imbecile", "jackass", "nitwit", "scumbag", "shithead", "wanker",
    "abschaum", "arschloch", "dreckskerl", "dummkopf", "hurensohn", "idioten", "missgeburt", "schwachkopf", "trottel", "vollidiot", "vollpfosten", "wichser",
    "abruti", "connard", "connasse", "crétin", "enculé", "imbécile", "minable", "ordure", "salaud", "salope",
    "cabrón", "capullo", "cretino", "escoria", "estúpido", "gilipollas", "imbécil", "malnacido", "pendejo", "subnormal",
]
_CLASS = np.zeros(256, np.int64)
for _i in range(256):
    _c = chr(_i)
    _CLASS[_i] = 1 if _i >= 128 or _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c == " " else 5 if _c == "\n" else 6 if _c in ".,;:" else 7 if _c in "!?" else 8 if _c in "#$%&*@^~" else 9 if _c in "|/\\<>=+_{}[]" else 10
MEASURES = ("words", "symbols", "bars", "shouts", "upper", "distinct", "repeats", "length", "letters", "lines")


def measures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A row of MEASURES for each text, and of its words (letters and digits only) hashes, bounds and hashes of their beginnings."""
    w, first = words(texts)
    size = np.array([len(t) for t in texts])
    at = np.concatenate(([0], np.cumsum(size)))
    kind = _CLASS[np.frombuffer(b"".join(texts), np.uint8)]

    def share(*kinds: int) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(np.isin(kind, kinds))))
        return sums[at[1:]] - sums[at[:-1]]

    n = np.maximum(1, np.diff(first))
    long = np.maximum(1, size)
    same = np.concatenate(([0], np.cumsum(np.concatenate(([False], w[1:] == w[:-1])))))[: len(w) + 1] if len(w) else np.zeros(1, int)
    again = np.array([same[b] - same[min(a + 1, b)] for a, b in zip(first[:-1], first[1:], strict=True)])
    distinct = np.array([len(np.unique(w[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)])
    lines = np.array([len(set(x)) / len(x) if len(x := t.split(b"\n")) > 2 else 1.0 for t in texts])
    cols = [np.diff(first), share(8) / n, share(9) / n, share(7) / n, share(2) / long, distinct / n, again / n, long / n, share(1, 2) / long, lines]
    terms, bounds, heads = words(texts, MARKS, HEAD)
    return np.stack(cols, axis=1).astype(float), terms, bounds, heads


_INSULTS = np.sort(words([x.encode() for x in INSULTS], MARKS)[0])
BAD, GOOD, NONE = 0, 1, 2


def _vote(bad: np.ndarray, good: np.ndarray | None = None) -> np.ndarray:
    return np.where(bad, BAD, GOOD if good is None else np.where(good, GOOD, NONE))


def quality_votes(m: np.ndarray, terms: np.ndarray, bounds: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Overlapping heuristics: symbols on words, bars between them, shouting, repetition, poor vocabulary, few letters, repeated lines, odd word lengths."""
    n, symbols, bars, shouts, upper, distinct, repeats, length, letters, lines = m.T
    none = np.zeros(len(m), bool)
    return np.stack([
        _vote(symbols > 0.3, none), _vote(bars > 0.08, none), _vote((shouts > 0.3) | (upper > 0.35), none), _vote(repeats > 0.2, none),
        _vote((distinct < 0.45) & (n >= 50), distinct > 0.5), _vote((letters < 0.75) & (n >= 20), none), _vote(lines < 0.6, none), _vote((length > 9.5) & (n >= 20), none),
    ], axis=1)


def toxic_votes(m: np.ndarray, terms: np.ndarray, bounds: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Any insult. The list is English: its silence is no vote. (Counts and kinds of insults would only
    repeat this vote, and labellers must not be copies of each other.)"""
    sums = np.concatenate(([0], np.cumsum(np.isin(terms, _INSULTS))))
    return _vote(sums[bounds[1:]] > sums[bounds[:-1]], np.zeros(len(m), bool))[:, None]


HEADS = {"quality": quality_votes, "toxic": toxic_votes}


def all_votes(m: tuple, truth: pa.Array) -> dict[str, list[str]]:
    """Of each head, the votes on each text as digits. People are one more labeller of toxicity, whose
    accuracy is estimated like the others': truth is 1 for toxic, 0 for not, null where nobody looked."""
    out = {name: f(*m) for name, f in HEADS.items()}
    told = truth.fill_null(-1).to_numpy(zero_copy_only=False)
    out["toxic"] = np.column_stack((out["toxic"], np.where(told < 0, NONE, np.where(told > 0, BAD, GOOD))))
    return {name: ["".join(map(str, x)) for x in v] for name, v in out.items()}


def value_of(column: np.ndarray) -> np.ndarray:
    """Words and beginnings weigh half as much as bins."""
    return np.where(column < 2 * SIZE, 0.5, 1.0)


def hashed(m: np.ndarray, terms: np.ndarray, bounds: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features: (row, column, value). Presence of each hashed word and beginning, and hashed bins of the measures."""
    row = np.repeat(np.arange(len(m)), np.diff(bounds))
    both = [np.unique(row * SIZE + (mix(x ^ U(i)) % U(SIZE)).astype(np.int64)) for i, x in enumerate((terms, heads))]
    key = np.concatenate((both[0] // SIZE, both[1] // SIZE))
    named = np.concatenate((both[0] % SIZE, both[1] % SIZE + SIZE))
    bins = np.floor(np.clip(m * np.array([0.02, 8, 8, 8, 20, 20, 20, 2, 25, 10]), 0, 63)).astype(np.int64)
    code = mix((bins + 64 * np.arange(m.shape[1])).astype(U) + U(1 << 40))
    rows = np.repeat(np.arange(len(m)), m.shape[1])
    columns = 2 * SIZE + (code % U(SIZE)).astype(np.int64).ravel()
    column = np.concatenate((named, columns))
    return np.concatenate((key, rows)), column, value_of(column)


LABELLER = np.array([[0.5, 0.1, 0.4], [0.05, 0.55, 0.4]])  # where estimates start: better than chance
PEOPLE = np.array([[0.38, 0.01, 0.61], [0.002, 0.388, 0.61]])  # people seldom call a clean text toxic


def estimate(counts: dict[tuple[int, ...], float], rounds: int = 60, start: list[np.ndarray] | None = None) -> tuple[np.ndarray, dict[tuple[int, ...], float]]:
    """Each labeller's probabilities of a vote given the truth, [labeller, truth, vote], and P(good) of each pattern of votes."""
    if not counts:
        return np.zeros((0, 2, 3)), {}
    patterns, n = np.array(list(counts)), np.array(list(counts.values()), float)
    like = np.stack(start or [LABELLER] * patterns.shape[1])
    start, prior = like * 20, 0.8
    for _ in range(rounds):
        log = np.log([[1 - prior], [prior]]) + np.stack([sum(np.log(like[j, y, patterns[:, j]]) for j in range(patterns.shape[1])) for y in (0, 1)])
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        prior = float((n @ good + 8) / (n.sum() + 10))
        for y, p in ((0, 1 - good), (1, good)):
            for j in range(patterns.shape[1]):
                like[j, y] = np.bincount(patterns[:, j], n * p, 3) + start[j, y]
                like[j, y] /= like[j, y].sum()
    return like, {tuple(map(int, k)): float(g) for k, g in zip(patterns, good, strict=True)}


def fit(rows: list[np.ndarray], labels: np.ndarray, steps: int = 300, least: float = 14.0) -> np.ndarray:
    """Weights of logistic regression on soft labels (the last one is the bias), both classes weighing alike.

    rows holds each document's columns. Columns that don't tell the classes apart (log-likelihood ratio
    of their counts under `least`) keep weight 0; all others are fitted, in sparse form.
    """
    w = np.zeros(3 * SIZE + 1)
    if not len(rows):
        return w
    good, size = np.zeros(3 * SIZE), np.zeros(3 * SIZE)
    for c, y in zip(rows, labels, strict=True):  # a row has a column once at most
        good[c] += y
        size[c] += 1
    share, ratio = labels.mean().clip(1e-6, 1 - 1e-6), np.zeros(3 * SIZE)
    for seen, expected in ((good, size * share), (size - good, size * (1 - share))):
        ratio += 2 * seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))
    told = np.flatnonzero(ratio >= least)
    place = np.full(3 * SIZE, -1, np.int32)
    place[told] = np.arange(len(told))
    some = [place[c[place[c] >= 0]] for c in rows]
    row, column = np.repeat(np.arange(len(rows), dtype=np.int32), [len(c) for c in some]), np.concatenate(some)
    value = value_of(told[column])
    bad = labels <= 0.5
    weight = np.where(bad, 1 / max(1, bad.sum()), 1 / max(1, (~bad).sum())) / 2
    v, speed, square = (np.zeros(len(told) + 1) for _ in range(3))
    for step in range(1, steps + 1):
        z = np.bincount(row, v[column] * value, len(rows)) + v[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        g = np.append(np.bincount(column, error[row] * value, len(told)), error.sum()) + 1e-4 * v
        speed, square = 0.9 * speed + 0.1 * g, 0.99 * square + 0.01 * g * g
        v -= 0.05 * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    w[told], w[-1] = v[:-1], v[-1]
    return w


def allowance(rows: list[np.ndarray], labels: np.ndarray) -> float:
    """What is added to the bias, 0 or more, so that of the good documents, each scored by a fit without
    its fold, all but LOST stay good."""
    at, z = np.arange(len(rows)) % FOLDS, np.zeros(len(rows))
    for fold in range(FOLDS):
        w = fit([r for r, k in zip(rows, at, strict=True) if k != fold], labels[at != fold])
        for i in np.flatnonzero(at == fold):
            z[i] = (w[rows[i]] * value_of(rows[i])).sum() + w[-1]
    good = z[labels > 0.5]
    return max(0.0, -float(np.quantile(good, LOST))) if len(good) else 0.0


@dataclass
class Model:
    """Weights and the labellers' estimated probabilities of each head."""

    weights: dict[str, np.ndarray]
    labellers: dict[str, np.ndarray]


def train(docs: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> Model:
    """Votes are counted over all documents; a row for each pattern of votes (at most 3 ** 8) reaches the
    driver. The posteriors label a bounded sample, whose sparse hashed features fit the scorers there.

    The sample is one row a doc_id (of repeated ones the least text), and BYTES of columns at most.
    labels(doc_id, toxic) is optional: with it, the sample is of labelled documents, and what people said
    of these counts as one more labeller of the toxic head, since no list holds the insults of every
    language. Posteriors alone train both heads. Without documents, all weights are 0.
    """
    docs = docs.select("doc_id", "text")

    def patterns(batches):
        for batch in chunks(batches, "text"):
            for name, votes in all_votes(measures(texts_of(batch)), batch.column("truth")).items():
                p, n = np.unique(votes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(p)), pa.array(p.tolist(), pa.string()), pa.array(n, pa.int64())], names=["head", "votes", "n"])

    def features(batches):
        for batch in chunks(batches, "text"):
            m = measures(texts_of(batch))
            row, column, _ = hashed(*m)
            order = np.argsort(row, kind="stable")
            cut = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            out = {"doc_id": batch.column("doc_id")} | all_votes(m, batch.column("truth"))
            out["columns"] = pa.array([np.unique(column[order[a:b]]).astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    if labels is not None:
        known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("truth"))
        known = F.broadcast(smallest(known, sample, "doc_id"))  # bounded, whatever the table's size
        told = docs.join(known, "doc_id", "left")
        some = docs.join(known, "doc_id")
    if labels is None or known.isEmpty():
        told = docs.withColumn("truth", F.lit(None).cast("int"))
        ids = smallest(docs.where("doc_id is not null").select("doc_id").distinct(), sample, "doc_id")
        some = told.join(F.broadcast(ids), "doc_id")
    counts: dict[str, dict] = {name: {} for name in HEADS}
    for r in told.select("text", "truth").mapInArrow(patterns, "head string, votes string, n long").groupBy("head", "votes").agg(F.sum("n").alias("n")).collect():
        counts[r["head"]][tuple(map(int, r["votes"]))] = r["n"]
    some = some.groupBy("doc_id", "truth").agg(F.min("text").alias("text"))  # a row a document, however often it comes
    held = written(some.mapInArrow(features, f"doc_id {some.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{name} string" for name in HEADS) + ", columns binary"))
    sizes = held.select("doc_id", F.octet_length("columns").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # `sample` rows at most
    fits = [r["doc_id"] for r, total in zip(sizes, np.cumsum([r["n"] for r in sizes]), strict=True) if total <= BYTES]
    rows = sorted((held if len(fits) == len(sizes) else held.where(F.col("doc_id").isin(fits))).collect(), key=lambda r: r["doc_id"])
    dropped(docs.sparkSession, held)
    sparse = [np.frombuffer(r["columns"], np.int32) for r in rows]
    model = Model({}, {})
    for name in HEADS:
        model.labellers[name], posterior = estimate(counts[name], start=[LABELLER, PEOPLE] if name == "toxic" else None)
        soft = np.array([posterior[tuple(map(int, r[name]))] for r in rows])
        model.weights[name] = fit(sparse, soft)
        model.weights[name][-1] += allowance(sparse, soft)
    return model


def _judged(batch: pa.RecordBatch, weights: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities that each text is of quality and clean; 1 for texts without words."""
    m = measures(texts_of(batch))
    row, column, value = hashed(*m)
    p = []
    for name in HEADS:
        z = np.bincount(row, weights[name][column] * value, batch.num_rows) + weights[name][-1]
        p.append(np.where(m[0][:, 0] == 0, 1.0, 1 / (1 + np.exp(-np.clip(z, -30, 30)))))
    return p[0], p[1]


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with quality and clean (probabilities) and kept (both at least one half).

    A null or wordless text says nothing against itself and is kept; repeated rows get equal scores, an
    empty table gives none. Columns of docs that have these names are replaced. The model is a broadcast
    of fixed size.
    """
    docs = docs.drop("quality", "clean", "kept")
    sent = docs.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches):
        for batch in chunks(batches, "text"):
            p = _judged(batch, sent.value)
            kept = (p[0] >= 0.5) & (p[1] >= 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p[0]), pa.array(p[1]), pa.array(kept)], names=[*batch.schema.names, "quality", "clean", "kept"])

    more = [T.StructField("quality", T.DoubleType()), T.StructField("clean", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))


def good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that scored() keeps, with their own columns, whatever these are called."""
    sent = docs.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches):
        for batch in chunks(batches, "text"):
            p = _judged(batch, sent.value)
            yield batch.filter(pa.array((p[0] >= 0.5) & (p[1] >= 0.5)))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with their scores. Null and wordless texts are kept, repeated rows get
    equal scores, an empty table gives none, other columns are ignored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, train(docs, table(spark, sf_dir, "labels"))).where("kept").select("doc_id", "quality", "clean", "kept")
