"""Nearest neighbours by inner product: cross-polytope hashing with multiprobe tables and exact reranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import dropped, smallest, table, written

TABLES = 12
TRIALS = 128  # queries, those of smallest hash, whose exact neighbours among all rows fit the number of probes
TARGET = 0.96  # share of these neighbours that the probes must find
BUCKET = 16  # rows of a bucket, by which the number of concatenated axes grows with the table
GROUP = 16_384  # rows of the buckets that are dealt together; each group a query visits sends its k best
BLOCK = 20_000  # rows of a group, or queries of it, in one task's block
MOST = 1 << 14  # probes a table; where they don't find TARGET, there are fewer and larger buckets
SPLIT = 500_000  # rows (some 20 MB) of the table of split groups up to which it is broadcast


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def levels(rows: int, dim: int) -> list[int]:
    """Dimensions of the concatenated cross-polytopes: whole ones, and a last one that brings the buckets to one in BUCKET rows."""
    whole = (2 * dim).bit_length() - 1
    bits = max(whole, int(max(1, rows // BUCKET)).bit_length() - 1)
    out = [dim] * (bits // whole)
    return out + [1 << (bits % whole - 1)] if bits % whole else out


class Rotations:
    """Fast pseudo-rotations (signs, then Hadamard, three times over), and the buckets of signed axes next to a vector.

    Rows are lifted by one coordinate to the largest norm, which turns inner products into cosines; it
    is left out where all norms are alike. Vectors are padded to a power of two. A bucket is a signed
    axis of each level's own rotation, as one number.
    """

    def __init__(self, dim: int, low: float, high: float, rows: int, tables: int = TABLES, seed: int = 7):
        self.lift, self.high = low < high * (1 - 1e-6), high
        self.dim = 1 << (dim + self.lift - 1).bit_length()
        self.levels = levels(rows, self.dim)
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, len(self.levels), 3, self.dim))
        self.buckets = int(np.prod([2 * d for d in self.levels], dtype=object))

    def padded(self, x: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.dim))
        norm = np.sqrt((x * x).sum(1))
        scale = np.where(query, norm, self.high)
        out[:, : x.shape[1]] = x / scale[:, None]
        if self.lift and not query:
            out[:, x.shape[1]] = np.sqrt(np.maximum(0, 1 - (norm / self.high) ** 2))
        return out

    def _signed(self, padded: np.ndarray, table: int, level: int) -> np.ndarray:
        """Coordinates along +e_i, then along -e_i."""
        y = padded
        for s in self.signs[table, level]:
            y = _hadamard(y * s)
        y = y[:, : self.levels[level]]
        return np.concatenate((y, -y), 1)

    def bucket(self, padded: np.ndarray, table: int) -> np.ndarray:
        out = np.zeros(len(padded), np.int64)
        for level, d in enumerate(self.levels):
            out = out * (2 * d) + self._signed(padded, table, level).argmax(1)
        return out

    def probes(self, padded: np.ndarray, table: int, n: int) -> np.ndarray:
        """The n buckets that rows near each vector are likeliest in, likeliest first: an axis costs the
        square of what its coordinate lacks to the largest one."""
        cost, out = np.zeros((len(padded), 1)), np.zeros((len(padded), 1), np.int64)
        for level, d in enumerate(self.levels):
            z = self._signed(padded, table, level)
            z = (z.max(1, keepdims=True) - z) ** 2
            axis = np.argsort(z, 1, kind="stable")[:, :n]
            z = np.take_along_axis(z, axis, 1)
            both = (cost[:, :, None] + z[:, None, :]).reshape(len(padded), -1)
            name = (out[:, :, None] * (2 * d) + axis[:, None, :]).reshape(len(padded), -1)
            if both.shape[1] > n:
                some = np.argpartition(both, n - 1, axis=1)[:, :n]
                both, name = np.take_along_axis(both, some, 1), np.take_along_axis(name, some, 1)
            order = np.argsort(both, axis=1, kind="stable")
            cost, out = np.take_along_axis(both, order, 1), np.take_along_axis(name, order, 1)
        return out


def fit_probes(rotations: Rotations, asked: np.ndarray, near: list[np.ndarray], target: float = TARGET, most: int | None = None) -> int | None:
    """The fewest probes a table that find the target share of the vectors near[i] of each query asked[i]; null if `most` (MOST) are not enough."""
    sizes = [len(x) for x in near]
    if not sum(sizes):
        return 1
    most = min(most or MOST, rotations.buckets)
    rank = np.full(sum(sizes), most)
    query, rows = rotations.padded(asked, True), rotations.padded(np.concatenate([x for x in near if len(x)]), False)
    at = np.cumsum([0, *sizes])
    for t in range(len(rotations.signs)):
        bucket = rotations.bucket(rows, t)
        for i in range(0, len(query), 16):
            for j, order in enumerate(rotations.probes(query[i : i + 16], t, most), i):
                some = slice(at[j], at[j + 1])
                place = np.full(sizes[j], most)
                hit = np.argsort(order, kind="stable")
                found = np.minimum(np.searchsorted(order[hit], bucket[some]), len(order) - 1)
                good = order[hit][found] == bucket[some]
                place[good] = hit[found[good]]
                rank[some] = np.minimum(rank[some], place)
    share = np.cumsum(np.bincount(rank, minlength=most + 1)[:most]) / len(rank)
    return int(np.searchsorted(share, target)) + 1 if share[-1] >= target or most == rotations.buckets else None


def fitted(dim: int, low: float, high: float, rows: int, tables: int, trial) -> tuple[Rotations, int]:
    """Rotations and probes that find TARGET of the trial's neighbours: buckets grow until MOST probes are
    enough; of the largest, one an axis and sign, as many are visited as it takes, at most all."""
    while True:
        rotations = Rotations(dim, low, high, rows, tables)
        probes = fit_probes(rotations, *trial, most=rotations.buckets if rows < BUCKET else MOST) if trial else 1
        if probes is not None:
            return rotations, probes
        rows //= 4


def _matrix(column) -> np.ndarray:
    """A column of equally long lists of numbers as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(flat, kind))


def _grouped(k: int, every: int):
    """Equal vectors of a batch: one row with their k + 1 smallest ids. Copies don't pile up beyond that."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = _matrix(batch.column("v")), batch.column("id").to_numpy(zero_copy_only=False)
            key = np.ascontiguousarray(x).view(np.dtype((np.void, 8 * x.shape[1]))).ravel()
            _, first, of = np.unique(key, return_index=True, return_inverse=True)
            order = np.lexsort((ids, of))
            counts = np.bincount(of)
            place = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
            asks = np.bincount(of, ids % every == 0) > 0
            yield pa.RecordBatch.from_arrays([batch.column("v").take(pa.array(first)), _lists(ids[order][place <= k], np.minimum(counts, k + 1), pa.int64()), pa.array(asks)], names=["v", "ids", "asks"])

    return run


def _addressed(rotations: Rotations, probes: int, width: int, query: bool):
    """Rows with their group and bucket a table; queries with the buckets they visit in a group, a row a table and group."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256 if query else 8192):
                part = batch.slice(low, 256 if query else 8192)
                padded = rotations.padded(_matrix(part.column("v")), query)
                for t in range(len(rotations.signs)):
                    if query:
                        b = np.sort(rotations.probes(padded, t, probes), axis=1)
                        group = b // width
                        new = np.ones(b.shape, bool)
                        new[:, 1:] = group[:, 1:] != group[:, :-1]
                        take, g = np.nonzero(new)[0], group[new]
                        subs = _lists((b % width).ravel(), np.diff(np.append(np.flatnonzero(new.ravel()), b.size)), pa.int32())
                    else:
                        b = rotations.bucket(padded, t)
                        take, g, subs = np.arange(len(b)), b // width, pa.array(b % width, pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), t), pa.int32()), pa.array(g), subs, part.column("cid").take(pa.array(take)), part.column("v").take(pa.array(take))], names=["t", "g", "sub", "cid", "v"])

    return run


_FOUND = pa.schema([("qid", pa.int64()), ("cid", pa.int64()), ("score", pa.float64())])


def _best(qid, cid, score, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query, ties to the smaller row."""
    order = np.lexsort((cid, -score, qid))
    qid, cid, score = qid[order], cid[order], score[order]
    keep = np.arange(len(qid)) - np.searchsorted(qid, qid) < k
    return qid[keep], cid[keep], score[keep]


def _scores(q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, row, score) of the pairs that can be among each query's k best. A pair's score is the same sum wherever it is computed."""
    s = q @ x.T
    if s.shape[1] > k:
        least = np.partition(s, -k, axis=1)[:, -k] - 1e-9 * (1 + np.abs(s).max(axis=1))
        a, b = np.nonzero(s >= least[:, None])
    else:
        a, b = np.divmod(np.arange(s.size), s.shape[1])
    return a, b, (q[a] * x[b]).sum(axis=1)


def _ranked(k: int):
    """Of a group, each query's k best rows among the buckets it visits."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if rows.num_rows and queries.num_rows:
            sub = rows.column("sub").to_numpy()
            order = np.argsort(sub, kind="stable")
            x, cid, sub = _matrix(rows.column("v"))[order], rows.column("cid").to_numpy()[order], sub[order]
            there, at = np.unique(sub, return_index=True)
            end = np.append(at[1:], len(sub))
            qv, ids = _matrix(queries.column("v")), queries.column("qid").to_numpy()
            subs = queries.column("sub").combine_chunks()
            visit = np.repeat(np.arange(len(ids)), np.diff(subs.offsets.to_numpy()))
            wanted = subs.flatten().to_numpy()
            known = np.isin(wanted, there)
            visit, wanted = visit[known], wanted[known]
            order = np.argsort(wanted, kind="stable")
            visit, wanted = visit[order], np.searchsorted(there, wanted[order])
            parts = [out]
            for i in np.unique(wanted):
                asking = visit[slice(*np.searchsorted(wanted, (i, i + 1)))]
                low, high = at[i], end[i]
                for j in range(0, len(asking), 512):
                    some = asking[j : j + 512]
                    a, b, score = _scores(qv[some], x[low:high], k)
                    parts.append((ids[some[a]], cid[low + b], score))
            out = _best(*(np.concatenate(c) for c in zip(*parts, strict=True)), k)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _FOUND, strict=True)], schema=_FOUND)

    return run


def _exact(sent, k: int):
    """Each batch's k best rows, with their vectors, for the few queries of a broadcast."""

    def run(batches):
        asked = sent.value
        for batch in batches:
            for low in range(0, batch.num_rows, 8192):
                part = batch.slice(low, 8192)
                x, cid = _matrix(part.column("v")), part.column("cid").to_numpy(zero_copy_only=False)
                a, b, score = _scores(asked, x, k)
                place = np.argsort(cid, kind="stable")  # cids are unique
                a, c, score = _best(a, cid[b], score, k)
                take = place[np.searchsorted(cid[place], c)]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(score), part.column("v").take(pa.array(take))], names=["qid", "cid", "score", "v"])

    return run


def _split(rows: DataFrame, name: str) -> DataFrame:
    """Into how many blocks the groups of more than BLOCK rows go."""
    return rows.groupBy("t", "g").count().where(F.col("count") > BLOCK).select("t", "g", F.ceil(F.col("count") / BLOCK).cast("int").alias(name))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, tables: int = TABLES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found for each queried row.

    vectors needs vec_id and embedding; other columns are ignored. Rows whose vec_id is divisible by
    `every` are the queries, all other rows but the query's own the candidates. Rows without id, and
    null, empty, zero or non-finite vectors take no part; nor do vectors of another length than most.
    Of rows that repeat a vec_id the least vector counts. An empty table gives an empty result.

    Equal vectors become one point with their k + 1 smallest ids (no more can be among the k nearest of
    any row), so copies are never paired. Every point is stored once a table, in the bucket of its
    nearest signed axes; how many axes are concatenated grows with the table. A query visits the
    likeliest buckets, as many as it takes to find TARGET of the neighbours of TRIALS queries, which
    are compared with all rows; where more than MOST a table would be needed, buckets are larger. Groups of buckets and their queries are dealt in blocks of bounded
    size, a query's vector once a group; each block sends k candidates a query.
    """
    spark = vectors.sparkSession
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    v = F.transform("embedding", lambda x: x.cast(kind)).alias("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v).where("id is not null and v is not null")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    result = "query_id long, rank int, vec_id long, score double"
    if length is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("v") == length["n"]).groupBy("id").agg(F.min("v").alias("v"))
    partial = rows.mapInArrow(_grouped(k, every), f"v array<{kind}>, ids array<long>, asks boolean")
    points = partial.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"), F.bool_or("asks").alias("asks"))
    points = written(points.select(F.col("ids")[0].alias("cid"), "v", "ids", "asks"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    low, high, many = points.agg(F.min(norm), F.max(norm), F.count("*")).first()
    rotations, probes = fitted(length["n"], low, high, many, tables, _trials(points, k))
    width = 1
    while width < rotations.buckets // 2 and 2 * width * many <= GROUP * rotations.buckets:
        width *= 2

    index = written(points.select("cid", "v").mapInArrow(_addressed(rotations, 1, width, False), f"t int, g long, sub int, cid long, v array<{kind}>"))
    visits = points.where("asks").select("cid", "v").mapInArrow(_addressed(rotations, probes, width, True), f"t int, g long, sub array<int>, cid long, v array<{kind}>")
    visits = written(visits.withColumnRenamed("cid", "qid"))
    # groups of more than BLOCK rows or queries are split; there is at most one for so many rows of index and visits
    large = _split(index, "rb").join(_split(visits, "qb"), ["t", "g"], "full")
    blocks = F.broadcast(large) if large.count() <= SPLIT else large
    rb, qb = (F.coalesce(c, F.lit(1)) for c in ("rb", "qb"))
    scrap = points, index, visits
    index = index.join(blocks, ["t", "g"], "left").withColumn("i", F.pmod(F.xxhash64("cid"), rb).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), qb - 1)))
    visits = visits.join(blocks, ["t", "g"], "left").withColumn("j", F.pmod(F.xxhash64("qid"), qb).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), rb - 1)))
    key = ["t", "g", "i", "j"]
    found = index.select(*key, "sub", "cid", "v").groupBy(*key).cogroup(visits.select(*key, "sub", "qid", "v").groupBy(*key)).applyInArrow(_ranked(k + 1), "qid long, cid long, score double")

    best = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    found = found.groupBy("qid", "cid").agg(F.max("score").alias("score")).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    members = points.select("cid", "ids")
    entry = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("id")))
    lists = found.join(members, "cid").groupBy("qid").agg(F.slice(F.array_sort(F.flatten(F.collect_list(entry))), 1, k + 1).alias("near"))
    asks = rows.where(F.col("id") % every == 0).join(points.where("asks").select("v", F.col("cid").alias("qid")), "v").select("id", "qid")
    near = asks.join(lists, "qid").select("id", F.slice(F.filter("near", lambda e: e["id"] != F.col("id")), 1, k).alias("near"))
    out = near.select(F.col("id").alias("query_id"), F.posexplode("near").alias("pos", "e"))
    out = written(out.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("e.id").alias("vec_id"), (-F.col("e.s")).alias("score")))
    dropped(spark, *scrap)
    return out


def _trials(points: DataFrame, k: int):
    """Up to TRIALS query vectors and, of each, the vectors of its exact k nearest other points; None without queries."""
    spark = points.sparkSession
    asked = smallest(points.where("asks").select("cid", "v"), TRIALS, "cid").collect()
    if not asked:
        return None
    q = np.array([r["v"] for r in asked], np.float64)
    sent = spark.sparkContext.broadcast(q)
    near = points.select("cid", "v").mapInArrow(_exact(sent, k + 1), f"qid long, cid long, score double, v {points.schema['v'].dataType.simpleString()}")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).select("qid", "cid", "v").collect()
    own = [r["cid"] for r in asked]
    lists: list[list] = [[] for _ in own]
    for r in near:
        if r["cid"] != own[r["qid"]]:
            lists[r["qid"]].append(r["v"])
    return q, [np.array(x, np.float64).reshape(-1, q.shape[1]) for x in lists]


def op10_cross_polytope_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
