"""Runs of periodic words: suffix classes united by descending LCP, newly adjacent positions seed the runs."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, table, texts_of

TIMES, LEAST = 4, 6  # a run holds its period so many times, and so many words, at least
WIDE = 1024  # positions of a block of an ordered set


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, with a periodic end in every document whose hashed doc_id is divisible by ten."""
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and each one's first place in the order of those that share its first words.

    Prefix doubling: what is already told apart keeps its place and is not sorted again, so that texts
    that repeat nothing cost one sort of their words and a part of a second one.
    """
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    new = np.flatnonzero(np.concatenate(([True], ids[order[1:]] != ids[order[:-1]])))
    rank[order] = np.repeat(new, np.diff(np.append(new, len(ids))))
    live = order[_shared(rank[order])]
    h = 1
    while len(live):
        after = live + h
        second = np.where(after < len(ids), rank[np.minimum(after, len(ids) - 1)], -1)
        first = rank[live]
        place = np.lexsort((second, first))
        live, first, second = live[place], first[place], second[place]
        # within a group, a place is the group's first one and what stands before it there
        head = np.maximum.accumulate(np.where(np.concatenate(([True], first[1:] != first[:-1])), np.arange(len(live)), 0))
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        at = first + np.maximum.accumulate(np.where(new, np.arange(len(live)), 0)) - head
        order[first + np.arange(len(live)) - head] = live
        rank[live] = at
        live, h = live[_shared(at)], 2 * h
    return order, rank


def _shared(key: np.ndarray) -> np.ndarray:
    """Which entries of an ordered key aren't alone."""
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    same[:-1] |= same[1:].copy()
    return same


def neighbours(ids: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(LCP, suffix, next suffix in order) of neighbours that share at least so many words.

    Places are visited from left to right, so that each one's common words are at least the last
    place's less one, and no word is compared twice.
    """
    order, _ = suffix_order(ids)
    n = len(ids)
    # neighbours that don't share their first `least` words are told apart without Python
    both = np.flatnonzero(ids[order[1:]] == ids[order[:-1]])
    for k in range(1, least):
        x, y = order[both] + k, order[both + 1] + k
        ok = np.maximum(x, y) < n
        both = both[ok]
        both = both[ids[x[ok]] == ids[y[ok]]]
    left, right = order[both], order[both + 1]
    by = np.argsort(left, kind="stable")
    out, length, last = [], 0, -2
    w = ids.tolist() if len(by) else []
    for i, j in zip(left[by].tolist(), right[by].tolist(), strict=True):
        length = max(least, length - 1) if i == last + 1 else least
        top = n - max(i, j)
        while length < top and w[i + length] == w[j + length]:
            length += 1
        out.append((length, i, j))
        last = i
    return out


class Places:
    """Ordered positions in blocks, so that neither a place nor its neighbours cost more than a block."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, first: int):
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def add(self, x: int) -> tuple[int, int]:
        """Puts x in; returns what stands before and after it, or -1."""
        k = max(0, bisect_left(self.heads, x) - 1)
        block = self.blocks[k]
        i = bisect_left(block, x)
        before = block[i - 1] if i else -1
        after = block[i] if i < len(block) else self.heads[k + 1] if k + 1 < len(self.heads) else -1
        insort(block, x)
        self.heads[k], self.size = block[0], self.size + 1
        if len(block) > WIDE:
            half = block[WIDE // 2 :]
            del block[WIDE // 2 :]
            self.blocks.insert(k + 1, half)
            self.heads.insert(k + 1, half[0])
        return before, after

    def __iter__(self):
        for block in self.blocks:
            yield from block


def seeds(edges: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, period, LCP) of positions that become adjacent in their class at a distance for which the LCP is enough.

    Kruskal by descending LCP: when two classes unite at l, a member of one and a member of the other
    share l words and no more. The smaller class goes into the larger one from left to right: what then
    stands before a position stays there, what stands after it only until the next one is in.
    """
    head: dict[int, int] = {}
    sets: dict[int, Places] = {}
    found = []

    def root(x: int) -> int:
        while (up := head.setdefault(x, x)) != x:
            head[x] = x = head.setdefault(up, up)
        return x

    for shared, i, j in sorted(edges, key=lambda e: -e[0]):
        a, b = root(i), root(j)
        if a == b:
            continue
        x, y = sets.pop(a, None) or Places(a), sets.pop(b, None) or Places(b)
        if x.size < y.size:
            a, b, x, y = b, a, y, x
        most, last, after = shared // (TIMES - 1), -1, -1
        for at in y:
            before, then = x.add(at)
            if before != last or before < 0:
                if after >= 0 and after - last <= most:
                    found.append((last, after - last, shared))
                if before >= 0 and at - before <= most:
                    found.append((before, at - before, shared))
            last, after = at, then
        if after >= 0 and after - last <= most:
            found.append((last, after - last, shared))
        head[b] = a
        sets[a] = x
    return found


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period.

    The first position of a run and the one a period later are in one class from their LCP on, which is
    the run's length less the period, and nothing of their class is between them, or the period were
    smaller. So they seed the run; a seed that an equal word precedes lies within one.
    """
    out = []
    for start, period, shared in seeds(neighbours(ids, LEAST - 1)):
        if period + shared >= LEAST and (not start or ids[start - 1] != ids[start + period - 1]):
            out.append((start, period + shared, period))
    return sorted(out)


def _report(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best, gone = None, np.zeros(len(words) + 1, np.int64)
    for run in runs:
        start, length, period = run
        if best is None or length * best[2] > best[1] * period:
            best = run
        gone[start + period] += 1
        gone[start + length] -= 1
    left = words if not runs else [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    text = b" ".join(left)
    start, length, period = best or (None, None, None)
    named = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    return len(runs), start, length, period, 1000 * length // period if best else None, hashlib.sha256(named).hexdigest(), hashlib.sha256(text).hexdigest(), text


_LONGS = ["n_runs", "start", "length", "period", "exponent_milli"]
_SQL = "doc_id long, " + ", ".join(f"{c} long" for c in _LONGS) + ", runs_sha256 string, collapsed_sha256 string"


def _audited(plant: bool, keep_text: bool):
    def run(batches):
        for batch in chunks(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            texts = [t.split() for t in texts_of(batch)]  # bytes split at space and \x09-\x0D alone
            if plant:
                texts = [planted(w, i) for w, i in zip(texts, ids, strict=True)]
            # one suffix order for the chunk: a document's words have numbers of their own
            names: dict[bytes, int] = {}
            of = np.fromiter((names.setdefault(w, len(names)) for t in texts for w in t), np.int64)
            sizes = np.array([len(t) for t in texts], np.int64)
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            found = runs_of(of + np.repeat(np.arange(len(texts)), sizes) * len(names))
            where = np.searchsorted(bounds, [r[0] for r in found], "right") - 1
            own: list[list] = [[] for _ in texts]
            for (start, length, period), k in zip(found, where.tolist(), strict=True):
                own[k].append((start - int(bounds[k]), length, period))
            out = list(zip(*(_report(t, r) for t, r in zip(texts, own, strict=True)), strict=True))
            arrays = [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in out[:5]), pa.array(out[5]), pa.array(out[6])]
            named = ["doc_id", *_LONGS, "runs_sha256", "collapsed_sha256"]
            if keep_text:
                arrays.append(pa.array(out[7], pa.binary()))
                named.append("collapsed")
            yield pa.RecordBatch.from_arrays(arrays, names=named)

    return run, _SQL + ", collapsed binary" * keep_text


def periodic_runs(docs: DataFrame, plant: bool = False, keep_text: bool = True) -> DataFrame:
    """A row a document: n_runs, the run of greatest exponent (start, length, period, exponent_milli), runs_sha256,
    collapsed_sha256 and, with keep_text, the collapsed text.

    A run is a stretch of words of smallest period q, at least max(LEAST, TIMES * q) of them, that no
    neighbouring word extends; collapsing drops what follows its first q words. With plant, documents are
    given periodic ends by their doc_id first. Words are compared themselves, by numbers that a chunk of
    documents gives them.

    Null, empty and wordless texts have no runs, four nulls, and the hashes of nothing. Rows without doc_id
    are reported as well (nothing is planted there), repeated rows each time, other columns are ignored, an
    empty table gives an empty result. A text is read whole in its own row: nothing is shuffled, and memory
    goes with 2 MB of text or the longest text.
    """
    run, schema = _audited(plant, keep_text)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents. Null texts have none, rows without doc_id and repeated rows are reported each, an empty
    table gives an empty result, other columns are ignored."""
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True, keep_text=False)
