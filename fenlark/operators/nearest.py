"""Exact nearest neighbours by cosine: blocks of queries against blocks of rows, a running top-k for each query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LIMIT = 8 << 20  # bytes of query vectors in one broadcast; more are searched in several rounds
QUERIES, ROWS = 512, 4096  # of one block
LAST = np.iinfo(np.int64).max  # stands for a null label, which comes last
NONE = -(1 << 40)  # less than any similarity in millionths


def _directions(flat: np.ndarray, n: int) -> np.ndarray:
    """n rows of length 1; zero and not finite ones are 0, without a direction."""
    v = flat.astype(float).reshape(n, -1)
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    fine = np.isfinite(norm) & (norm > 0)
    return np.where(fine, v, 0) / np.where(fine, norm, 1)


def _merged(parts: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The first k of each row of (similarity, label, id), by falling similarity, label, id."""
    s, label, ids = (np.concatenate(p, axis=1) for p in zip(*parts, strict=True))
    first = np.lexsort((ids, label, -s), axis=1)[:, :k]
    return tuple(np.take_along_axis(a, first, axis=1) for a in (s, label, ids))


def _top(asked: np.ndarray, q: np.ndarray, ids: np.ndarray, label: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(similarity in millionths, label, id) of each query's k best rows; rows come in the order of label and id."""
    m = len(ids)
    s = np.floor((q @ v.T) * 1e6 + 0.5).astype(np.int64)
    s[asked[:, None] == ids[None, :]] = NONE
    key = s * m + np.arange(m - 1, -1, -1)
    key = np.partition(key, m - k, axis=1)[:, m - k :] if m > k else key
    at = m - 1 - key % m
    return key // m, label[at], ids[at]


def _search(sent, k: int):
    def run(batches):
        asked, flat = sent.value
        q = _directions(flat, len(asked))
        starts = range(0, len(asked), QUERIES)
        best: list = [None] * len(starts)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                some = batch.slice(low, ROWS)
                ids, label = (some.column(c).fill_null(LAST).to_numpy() for c in ("vec_id", "label"))
                v = _directions(some.column("embedding").flatten().fill_null(np.nan).to_numpy(), some.num_rows)
                order = np.lexsort((ids, label))
                ids, label, v = ids[order], label[order], v[order]
                for b, i in enumerate(starts):
                    found = _top(asked[i : i + QUERIES], q[i : i + QUERIES], ids, label, v, k)
                    best[b] = _merged([best[b], found] if best[b] is not None else [found], k)
        for i, found in zip(starts, best, strict=True):
            if found is not None:
                s, label, ids = (a.ravel() for a in found)
                query = np.repeat(asked[i : i + QUERIES], found[0].shape[1])
                real = s > NONE
                cols = [pa.array(query[real]), pa.array(ids[real]), pa.array(label[real], mask=label[real] == LAST), pa.array(s[real] / 1e6)]
                yield pa.RecordBatch.from_arrays(cols, names=["query_id", "vec_id", "label", "similarity"])

    return run


def nearest(rows: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, vec_id, label, similarity): of each row whose vec_id is divisible by every, the k most alike of all other rows.

    Similarities are cosines rounded to 6 digits; ties go by label and vec_id. vec_id is a key. Rows without
    an id or vector have no part in it; a vector without a direction is 0 alike. The queries' size is
    measured before they are broadcast; beyond LIMIT, parts of them are searched in turn.
    """
    sc = rows.sparkSession.sparkContext
    v = F.col("embedding").cast("array<float>").alias("embedding")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v).where("vec_id is not null and embedding is not null")
    asks = rows.where(F.col("vec_id") % every == 0).select("vec_id", "embedding")
    rounds = max(1, -(-(asks.agg(F.sum(4 * F.size("embedding"))).first()[0] or 0) // LIMIT))
    found = None
    for i in range(rounds):
        part = (asks if rounds == 1 else asks.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == i)).toArrow().combine_chunks()
        asked = part.column("vec_id").to_numpy()
        flat = pa.chunked_array(part.column("embedding")).combine_chunks().flatten().fill_null(np.nan).to_numpy().astype(np.float32)
        one = rows.mapInArrow(_search(sc.broadcast((asked, flat)), k), "query_id long, vec_id long, label long, similarity double")
        found = one if found is None else found.unionByName(one)
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), F.asc_nulls_last("label"), "vec_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")
