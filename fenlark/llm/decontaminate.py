"""Benchmark decontamination: block-max WAND over a BM25 index of test items, then overlap of question and answer."""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MARKS, U, chunks, mix, table, texts_of, words

K1, B = 1.2, 0.75
THRESHOLD = 0.5  # of an item's BM25 score with itself
OVERLAP = 0.6  # share of a part's word n-grams in the document, for the question and for the answer
GRAM = 5
RARE = 50  # one item in so many has a rare term at most
BLOCK = 8  # postings under one block maximum
LIMIT = 8 << 20  # bytes of items in one broadcast index; more items are searched in several rounds


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence answers; of a single sentence, the last third of the words."""
    parts = re.split(r"(?<=[.!?])\s+", text.strip())
    if len(parts) > 1:
        return text.strip()[: -len(parts[-1])], parts[-1]
    w = text.split()
    cut = max(1, len(w) - max(1, len(w) // 3))
    return " ".join(w[:cut]), " ".join(w[cut:])


def _grams(w: np.ndarray, n: int) -> np.ndarray:
    if n < 1 or len(w) < n:
        return np.zeros(0, U)
    out = w[: len(w) - n + 1].copy()
    for j in range(1, n):
        out = mix(out * U(0xD6E8FEB86659FD93) + w[j : len(w) - n + 1 + j])
    return out


@dataclass(frozen=True)
class Statistics:
    """Of all items, whatever part of them an index holds: how many, their words and the longest one's; terms and the number of items with each."""

    n: int
    words: int
    longest: int
    terms: np.ndarray
    df: np.ndarray


class _Postings:
    """postings[t]: the (item, impact) pairs of a term."""

    def __init__(self, start: np.ndarray, item: np.ndarray, impact: np.ndarray):
        self.start, self.item, self.impact = start, item, impact

    def __len__(self) -> int:
        return len(self.start) - 1

    def __getitem__(self, t: int) -> list[tuple[int, float]]:
        some = slice(self.start[t], self.start[t + 1])
        return list(zip(self.item[some].tolist(), self.impact[some].tolist(), strict=True))


class Index:
    """BM25 postings of the items, with impacts as shares of the item's score with itself, and block maxima.

    Postings are flat arrays by term and item. Without statistics, the items given are all there are.
    """

    def __init__(self, items: list[tuple[int, str]], known: Statistics | None = None):
        terms, first = words([t.encode() for _, t in items], MARKS)
        self.ids, self.items = [i for i, _ in items], items
        n, size = len(items), np.diff(first)
        self.vocabulary, named = np.unique(terms, return_inverse=True)
        key, often = np.unique(named * max(1, n) + np.repeat(np.arange(n), size), return_counts=True)
        term, item = key // max(1, n), key % max(1, n)
        if known is None:
            known = Statistics(n, len(terms), int(size.max(initial=0)), self.vocabulary, np.bincount(term, minlength=len(self.vocabulary)))
        mean = max(1.0, known.words / max(1, known.n))
        self.longest = max(1, known.longest)
        df = known.df[np.searchsorted(known.terms, self.vocabulary)]
        idf = np.log(1 + (known.n - df + 0.5) / (df + 0.5))
        impact = idf[term] * often * (K1 + 1) / (often + K1 * (1 - B + B * size[item] / mean))
        impact = impact / np.bincount(item, impact, n)[item]
        self.postings = _Postings(np.searchsorted(term, np.arange(len(self.vocabulary) + 1)), item, impact)
        # an item's terms, the rarest first, and what those from each on can give it
        self.order = np.lexsort((term, df[term], item))
        self.by_item = np.searchsorted(item[self.order], np.arange(n + 1))
        total = np.cumsum(impact[self.order])
        before = np.concatenate(([0.0], total))[self.by_item[:-1]]
        self.left = 1 - (total - impact[self.order] - before[item[self.order]])
        self.term, self.rare = term, df[term] <= max(2, known.n // RARE)
        self._needed: dict[float, tuple] = {}
        self._lists: dict[int, tuple] = {}
        self._parts: dict[int, list] = {}

    def _list(self, t: int) -> tuple[list, list, list, list, float]:
        """A term's items and impacts, the last item and the largest impact of each block, and the largest of all."""
        if t not in self._lists:
            p = self.postings
            item, impact = p.item[p.start[t] : p.start[t + 1]], p.impact[p.start[t] : p.start[t + 1]]
            cut = np.arange(0, len(item), BLOCK)
            last = item[np.minimum(cut + BLOCK, len(item)) - 1]
            most = np.maximum.reduceat(impact, cut)
            self._lists[t] = item.tolist(), impact.tolist(), last.tolist(), most.tolist(), float(most.max())
        return self._lists[t]

    def part(self, item: int) -> list[tuple[int, np.ndarray]]:
        """Word n-grams of an item's question and answer."""
        if item not in self._parts:
            out = []
            for x in split_item(self.items[item][1]):
                w, _ = words([x.encode()], MARKS)
                n = min(GRAM, len(w))
                out.append((n, np.unique(_grams(w, n))))
            self._parts[item] = out
        return self._parts[item]

    def needed(self, threshold: float) -> tuple[np.ndarray, ...]:
        """Of each item, its rarest terms without which the others can't give it the threshold, and all
        others of few items, which tighten the bound: by term, (start, item, impact), and by item what
        the rest can give."""
        if threshold not in self._needed:
            key = (self.left >= threshold - 1e-9) | self.rare[self.order]
            owner = self.postings.item[self.order]
            rest = 1 - np.bincount(owner[key], self.postings.impact[self.order][key], len(self.ids))
            some = np.sort(self.order[key])
            start = np.searchsorted(self.term[some], np.arange(len(self.vocabulary) + 2))
            self._needed[threshold] = start, self.postings.item[some], self.postings.impact[some], rest
        return self._needed[threshold]

    def _promising(self, term, start, row, threshold: float) -> np.ndarray:
        """Half passages k such that with the next one an item may reach the threshold.

        Work and memory go with the needed terms that occur, not with passages times items.
        """
        at, owner, impact, rest = self.needed(threshold)
        many = at[term + 1] - at[term]
        hit = np.flatnonzero(many)
        many = many[hit]
        if not len(hit):
            return hit
        half = np.searchsorted(start, hit, "right") - 1
        post = np.arange(many.sum()) + np.repeat(at[term[hit]] - (np.cumsum(many) - many), many)
        n = len(self.ids)
        key, where = np.unique(np.repeat(half, many) * n + owner[post], return_inverse=True)
        score = np.bincount(where, impact[post])
        half, item = key // n, key % n
        out = []
        for step in (1, -1):  # this half with the next one; the one before with this
            beside = half + step
            inside = (beside >= 0) & (beside < len(start))
            inside[inside] = row[beside[inside]] == row[half[inside]]
            other = np.minimum(np.searchsorted(key, key + step * n), len(key) - 1)
            both = score + np.where(inside & (key[other] == key + step * n), score[other], 0.0)
            good = both + rest[item] >= threshold - 1e-9
            out.append(half[good] if step == 1 else beside[good & inside])
        return np.unique(np.concatenate(out))

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose share reaches the threshold, by block-max WAND over the distinct terms given."""
        out = []
        lists = {t: self._list(t) for t in terms}
        heads = [[lists[t][0][0], t, 0] for t in terms]
        end = len(self.ids)
        while True:
            heads.sort()
            bound, pivot = 0.0, -1
            for k, (item, t, _) in enumerate(heads):
                if item >= end:
                    break
                bound += lists[t][4]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return out
            item = heads[pivot][0]
            while pivot + 1 < len(heads) and heads[pivot + 1][0] == item:
                pivot += 1
            # block maxima at the pivot's item bound its score more tightly
            bound, skip = 0.0, end
            for _, t, at in heads[: pivot + 1]:
                last = lists[t][2]
                k = bisect_left(last, item, at // BLOCK)
                if k < len(last):
                    bound += lists[t][3][k]
                    skip = min(skip, last[k] + 1)
            if bound < threshold:
                if pivot + 1 < len(heads):
                    skip = min(skip, heads[pivot + 1][0])
                self._advance(lists, heads[: pivot + 1], max(skip, item + 1), end)
            elif heads[0][0] == item:
                score = sum(lists[t][1][at] for i, t, at in heads[: pivot + 1] if i == item)
                if score >= threshold:
                    out.append((item, score))
                self._advance(lists, heads[: pivot + 1], item + 1, end)
            else:
                self._advance(lists, [h for h in heads[:pivot] if h[0] < item], item, end)

    @staticmethod
    def _advance(lists, heads, to: int, end: int) -> None:
        """Moves on to the first posting at or after an item: over whole blocks first, then within one."""
        for h in heads:
            items, _, last, *_ = lists[h[1]]
            k = bisect_left(last, to, h[2] // BLOCK)
            at = bisect_left(items, to, max(h[2], k * BLOCK), min(len(items), (k + 1) * BLOCK))
            h[0], h[2] = items[at] if at < len(items) else end, at

    def overlap(self, item: int, w: np.ndarray) -> tuple[float, float]:
        """Shares of the question's and the answer's n-grams among those of w; 1 for a part without words."""
        out = []
        for n, grams in self.part(item):
            out.append(float(np.isin(grams, _grams(w, n)).mean()) if len(grams) else 1.0)
        return out[0], out[1]

    def leaks(self, texts: list[bytes], threshold: float, overlap: float) -> list[dict[int, tuple[float, float, float]]]:
        """Of each text, the items confirmed in it: score of the best passage, overlap of question and answer there.

        Passages are windows of twice the longest item's words, half overlapping, so that each item fits
        into one. An item can only be found where one of its needed terms is; WAND searches these
        passages among all items, and question and answer must overlap with the passage found.
        """
        w, first = words(texts, MARKS)
        out: list[dict] = [{} for _ in texts]
        if not len(self.vocabulary) or not len(w):
            return out
        at = np.minimum(np.searchsorted(self.vocabulary, w), len(self.vocabulary) - 1)
        term = np.where(self.vocabulary[at] == w, at, len(self.vocabulary))
        step = self.longest
        many = -(-np.diff(first) // step)  # half passages of each text
        top = np.cumsum(many)
        row = np.repeat(np.arange(len(texts)), many)
        start = first[row] + step * (np.arange(len(row)) - (top - many)[row])
        for k in self._promising(term, start, row, threshold):
            i = row[k]
            stop = min(start[k] + 2 * step, first[i + 1])
            terms = np.unique(term[start[k] : stop])
            terms = terms[terms < len(self.vocabulary)]
            for item, score in self.search(terms.tolist(), threshold - 1e-9):
                q, a = self.overlap(item, w[start[k] : stop])
                if q >= overlap and a >= overlap:
                    out[i][self.ids[item]] = max((score, q, a), out[i].get(self.ids[item], (0.0, 0.0, 0.0)))
        return out


_READY: dict[str, Index] = {}


def _counted(batches):
    """Of each item, its distinct terms; in a row without a term, all its words."""
    for batch in chunks(batches, "text", 1 << 20):
        w, first = words(texts_of(batch), MARKS)
        size = np.diff(first)
        row = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((w, row))
        w, row = w[order], row[order]
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (row[1:] != row[:-1])
        part = batch.column("part")
        yield pa.RecordBatch.from_arrays([part, pa.nulls(len(size), pa.int64()), pa.array(size, pa.int64())], names=["part", "term", "size"])
        terms = w[new].view(np.int64)
        yield pa.RecordBatch.from_arrays([part.take(pa.array(row[new])), pa.array(terms), pa.array(np.zeros(len(terms), np.int64))], names=["part", "term", "size"])


def _rounds(spark: SparkSession, items: DataFrame):
    """(key, broadcast of items and statistics) for each round; one round unless the items are larger than LIMIT.

    The statistics are of all items in every round, so that results don't depend on the rounds; of the
    terms, a round gets those that its items have.
    """
    items = items.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-size // LIMIT))
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(rounds)).cast("int"))
    counted = items.select("part", "text").mapInArrow(_counted, "part int, term long, size long")
    n, total, longest = counted.where("term is null").agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    held = counted.where("term is not null").groupBy("term", "part").agg(F.count("*").alias("df"))
    for i in range(rounds):
        here = F.max(F.col("part") == i)
        df = held.groupBy("term").agg(F.sum("df").alias("df"), here.alias("here")).where("here").select("term", "df").toArrow()
        terms = df.column("term").to_numpy().view(U)
        order = np.argsort(terms)
        known = Statistics(n, total, longest, terms[order], df.column("df").to_numpy()[order])
        rows = sorted((r["item_id"], r["text"]) for r in items.where(F.col("part") == i).select("item_id", "text").collect())
        key = (tuple(rows), n, total, longest, known.terms.tobytes(), known.df.tobytes())
        yield f"{hash(key)}", spark.sparkContext.broadcast((rows, known))


def _index(key: str, sent) -> Index:
    if key not in _READY:
        _READY.clear()
        _READY[key] = Index(*sent.value)
    return _READY[key]


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap), a row for each item confirmed in a document.

    docs needs doc_id and text, items item_id and text; other columns are ignored. Items without id or
    text take no part, repeated ones count once. Null texts and items without words leak nothing; a doc_id may be null; repeated rows give repeated results. The items'
    size is measured before an index is broadcast; beyond LIMIT, parts of them are searched in turn,
    with the statistics of all.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = None
    for key, sent in _rounds(docs.sparkSession, items):

        def run(batches, key=key, sent=sent):
            index = _index(key, sent)
            for batch in chunks(batches, "text", 1 << 20):
                found = index.leaks(texts_of(batch), threshold, overlap)
                rows = [(d, i, *x) for d, f in zip(batch.column("doc_id").to_pylist(), found, strict=True) for i, x in sorted(f.items())]
                cols = list(zip(*rows, strict=True)) or [()] * 5
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        part = docs.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of docs, with all their columns, whose text holds no item."""
    for key, sent in _rounds(docs.sparkSession, items):

        def run(batches, key=key, sent=sent):
            index = _index(key, sent)
            for batch in chunks(batches, "text", 1 << 20):
                found = index.leaks(texts_of(batch), threshold, overlap)
                yield batch.filter(pa.array([not f for f in found]))

        docs = docs.mapInArrow(run, T.StructType(docs.schema.fields))
    return docs


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
