"""Exact nearest rows by inner product: an M-tree of paged metric nodes, searched best-first."""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import dropped, smallest, table, written

CELLS = 4096  # subtrees at most; their routing objects and radii are the tree's top page, so its size is bounded
CELL = 8192  # rows of a subtree at which the number of subtrees grows with the table
BLOCK = 20_000  # rows of a subtree, or queries that visit it, in one task; larger ones are dealt in blocks
PAGE = 256  # entries of a leaf
FAN = 32  # entries of an inner page
ASKED = 256  # queries that go through a tree together
SPLIT = 100_000  # rows of the table of split subtrees up to which it is broadcast
_EXACT = float(1 << 53)  # sums of whole numbers below are exact in double precision
_MOST = (1 << 63) - 1
_NONE = _MOST  # the number of a row that isn't there; it loses all ties


def _dense(lists: pa.Array) -> np.ndarray:
    """A column of equally long lists of numbers as rows of doubles or longs."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 1), np.int64)


class Space:
    """Whole-number vectors as points of a metric space in which the nearest is that of largest inner product.

    Rows get one more coordinate, which brings all to the length of the longest one; queries get a zero
    there. Then distance^2 = |q|^2 + longest^2 - 2 q.x. Distances are doubles and only bound; scores are
    exact. slack is more than a distance's rounding error.
    """

    def __init__(self, longest: float, highest: int, dim: int):
        self.top, self.slack = longest * longest, 1e-6 * (1 + longest)
        # products are summed up as doubles, longs or Python's numbers: the fastest kind that holds every sum
        worst = float(highest) * highest * dim
        self.kind = np.float64 if worst < _EXACT else np.int64 if worst < float(1 << 62) else object

    def rows(self, x: np.ndarray) -> np.ndarray:
        y = x.astype(np.float64)
        return np.column_stack((y, np.sqrt(np.maximum(0.0, self.top - (y * y).sum(1)))))

    def queries(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack((x.astype(np.float64), np.zeros(len(x))))

    def exact(self, x: np.ndarray) -> np.ndarray:
        return x.astype(self.kind)

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products of exact(...) arrays; what a long can't hold counts as its bound."""
        out = a @ b
        if self.kind is not object:
            return out
        return np.array([min(max(v, -_MOST), _MOST) for v in out.ravel()], np.int64).reshape(out.shape)

    def limits(self, score: np.ndarray, found: np.ndarray, square: np.ndarray) -> np.ndarray:
        """Distances beyond which rows score less than `score`, of queries whose components' squares sum up to `square`; none where nothing is found yet."""
        d = np.sqrt(np.maximum(0.0, square + self.top - 2.0 * score.astype(np.float64))) + 2 * self.slack
        return np.where(found, d, np.inf)

    def unknown(self, queries: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and numbers of the k best rows of queries that know none."""
        return np.full((queries, k), *((-np.inf, np.float64) if self.kind is np.float64 else (-_MOST, np.int64))), np.full((queries, k), _NONE, np.int64)

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of each row of a to each row of b."""
        square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
        return np.sqrt(np.maximum(0.0, square))


# pages


_PAGE = pa.schema([("cell", pa.int32()), ("i", pa.int32()), ("page", pa.int32()), ("leaf", pa.bool_()), ("child", pa.list_(pa.int64())), ("v", pa.binary()), ("radius", pa.binary()), ("up", pa.binary())])
_PAGE_SQL = "cell int, i int, page int, leaf boolean, child array<long>, v binary, radius binary, up binary"


def _routed(z: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which of up to FAN sampled routing objects each point is nearest to; even parts where they can't tell."""
    take = rng.choice(len(z), min(FAN, max(2, -(-2 * len(z) // PAGE))), replace=False)
    of = Space.distances(z, z[take]).argmin(1)
    return of if np.bincount(of).max() < len(z) else np.arange(len(z)) * len(take) // len(z)


def paged(cid: np.ndarray, x: np.ndarray, space: Space, centre: np.ndarray, seed: int = 7) -> list[tuple]:
    """(page, leaf, children, vectors, radii, distances to the page's routing object) of an M-tree over the rows.

    Page 0 has one entry, the tree's routing object `centre`. Points go to the nearest routing object, page
    by page, until PAGE of them or less are left. A radius covers all that is below.
    """
    z, rng, pages = space.rows(x), np.random.default_rng(seed), []
    own = Space.distances(z, centre[None])[:, 0]
    pages.append((0, False, [1], centre[None].tobytes(), np.array([own.max() + space.slack]).tobytes(), np.zeros(1).tobytes()))
    todo, free = [(1, np.arange(len(x)), centre)], 2
    while todo:
        page, at, o = todo.pop()
        if len(at) <= PAGE:
            pages.append((page, True, cid[at].tolist(), x[at].astype(np.int64).tobytes(), b"", Space.distances(z[at], o[None])[:, 0].tobytes()))
            continue
        of = _routed(z[at], rng)
        routes, radii, children = [], [], []
        for k in np.unique(of):
            part = at[of == k]
            mean = z[part].mean(0)
            route = z[part[Space.distances(z[part], mean[None])[:, 0].argmin()]]  # the member next to the middle
            routes.append(route)
            radii.append(Space.distances(z[part], route[None]).max() + space.slack)
            children.append(free)
            todo.append((free, part, route))
            free += 1
        routes = np.array(routes)
        pages.append((page, False, children, routes.tobytes(), np.array(radii).tobytes(), Space.distances(routes, o[None])[:, 0].tobytes()))
    return pages


def opened(pages: list[tuple], space: Space, dim: int) -> dict[int, tuple]:
    """Pages by number, with arrays for their bytes."""
    out = {}
    for page, leaf, child, v, radius, up in pages:
        up = np.frombuffer(up)
        vectors = space.exact(np.frombuffer(v, np.int64).reshape(-1, dim)) if leaf else np.frombuffer(v).reshape(-1, dim + 1)
        # squares of routing objects' lengths, or nothing
        out[page] = (leaf, np.asarray(child, np.int64), vectors, np.zeros(len(up)) if leaf else np.frombuffer(radius), up, None if leaf else (vectors * vectors).sum(1))
    return out


def _merged(rows, score, cid, best: np.ndarray, ids: np.ndarray) -> None:
    """Takes (row, score, cid) into the rows' k best, ties to the smaller cid; what is there already counts once."""
    k, old = best.shape[1], np.unique(rows)
    rows = np.concatenate((np.repeat(old, k), rows))
    score, cid = np.concatenate((best[old].ravel(), score)), np.concatenate((ids[old].ravel(), cid))
    order = np.lexsort((cid, -score, rows))
    rows, score, cid = rows[order], score[order], cid[order]
    new = np.concatenate(([True], (rows[1:] != rows[:-1]) | (cid[1:] != cid[:-1]) | (cid[1:] == _NONE)))
    rows, score, cid = rows[new], score[new], cid[new]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < k
    best[rows[keep], place[keep]], ids[rows[keep], place[keep]] = score[keep], cid[keep]


def searched(tree: dict[int, tuple], space: Space, q: np.ndarray, best: np.ndarray, ids: np.ndarray, seen: Counter | None = None) -> None:
    """Brings the k best rows of each query (best: scores, descending; ids: their numbers) up to what the tree holds.

    Pages wait in the order of the least distance that they can have to a query that wants them. Entries
    whose stored distance to the page's routing object puts them beyond a query's k-th best (triangle
    inequality) are left out without a computation; so are pages whose radius does. Equal scores may still
    win by their number, so only what is farther goes. seen counts pages, their entries and the distances
    computed, each for every query.
    """
    exact, z = space.exact(q), space.queries(q)
    square = (z * z).sum(1)
    limit = space.limits(best[:, -1], ids[:, -1] != _NONE, square)
    every = np.arange(len(q))
    waiting = [(0.0, 0, every, np.zeros(len(q)), None)]
    while waiting:
        least, page, rows, low, own = heapq.heappop(waiting)
        if least > limit.max():
            break
        wanted = low <= limit[rows]
        rows = rows[wanted]
        if not len(rows):
            continue
        leaf, child, vectors, radius, up, lengths = tree[page]
        cols = np.arange(len(child))
        if own is not None:
            near = np.abs(own[wanted][:, None] - up[None, :]) - radius[None, :] <= limit[rows][:, None]
            cols, rows = np.flatnonzero(near.any(0)), rows[near.any(1)]
        if seen is not None:
            seen.update(pages=len(rows), entries=len(rows) * len(child), computed=len(rows) * len(cols))
        if not len(cols):
            continue
        part = vectors if len(cols) == len(child) else vectors[cols]
        if leaf:
            score, k = space.scores(exact[rows], part.T), best.shape[1]
            floor = best[rows, -1]
            if len(cols) > k:
                floor = np.maximum(floor, np.partition(score, -k, axis=1)[:, -k])
            r, c = np.nonzero(score >= floor[:, None])
            if len(r):
                _merged(rows[r], score[r, c], child[cols[c]], best, ids)
                limit[rows] = space.limits(best[rows, -1], ids[rows, -1] != _NONE, square[rows])
        else:
            d = np.sqrt(np.maximum(0.0, square[rows][:, None] + lengths[cols][None, :] - 2.0 * (z[rows] @ part.T)))
            low = np.maximum(0.0, d - radius[cols][None, :] - space.slack)
            near = low <= limit[rows][:, None]
            for j in np.flatnonzero(near.any(0)).tolist():
                ask = near[:, j]
                heapq.heappush(waiting, (float(low[ask, j].min()), int(child[cols[j]]), rows[ask], low[ask, j], d[ask, j]))


# jobs


def _collapsed(k: int, every: int):
    """Equal vectors of a batch: one row with their k + 1 smallest ids. Copies don't pile up beyond that."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = np.ascontiguousarray(_dense(batch.column("v"))), batch.column("id").to_numpy(zero_copy_only=False)
            key = x.view(np.dtype((np.void, 8 * x.shape[1]))).ravel()
            _, first, of = np.unique(key, return_index=True, return_inverse=True)
            order, counts = np.lexsort((ids, of)), np.bincount(of)
            place = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
            held = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.minimum(counts, k + 1)))), pa.int32()), pa.array(ids[order][place <= k]))
            yield pa.RecordBatch.from_arrays([batch.column("v").take(pa.array(first)), held, pa.array(np.bincount(of, ids % every == 0) > 0)], names=["v", "ids", "asks"])

    return run


def _assigned(centres, space: Space):
    """Each point's subtree, that of the nearest routing object, and its distance to it."""

    def run(batches):
        o = centres.value
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                d = Space.distances(space.rows(_dense(part.column("v"))), o)
                of = d.argmin(1)
                yield pa.RecordBatch.from_arrays([part.column("cid"), part.column("v"), pa.array(of, pa.int32()), pa.array(d[np.arange(len(of)), of])], names=["cid", "v", "cell", "d"])

    return run


def _pages(centres, space: Space):
    """The pages of a block of a subtree."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        cell, i = key[0].as_py(), key[1].as_py()
        order = np.argsort(rows.column("cid").to_numpy(), kind="stable")
        pages = paged(rows.column("cid").to_numpy()[order], _dense(rows.column("v"))[order], space, centres.value[cell])
        cols = list(zip(*pages, strict=True))
        return pa.Table.from_arrays([pa.array([cell] * len(pages), pa.int32()), pa.array([i] * len(pages), pa.int32()), *(pa.array(c, f.type) for c, f in zip(cols, list(_PAGE)[2:], strict=True))], schema=_PAGE)

    return run


_VISIT = "qid long, v array<long>, cell int, known array<struct<s:long,c:long>>"
_KNOWN = pa.list_(pa.struct([("s", pa.int64()), ("c", pa.int64())]))


def _known(lists: list, space: Space, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of {s, c} as arrays of scores and numbers."""
    best, ids = space.unknown(len(lists), k)
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    if len(rows):
        _merged(rows, np.array([e["s"] for x in lists for e in x], best.dtype), np.array([e["c"] for x in lists for e in x], np.int64), best, ids)
    return best, ids


def _visits(top, space: Space, k: int, nearest: bool):
    """The subtrees that each query must visit, by their radii and the k-th best score it knows: the nearest one, or all others."""

    def run(batches):
        cids, x, o, radius, live = top.value
        exact = space.exact(x)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                q = _dense(part.column("v"))
                z = space.queries(q)
                d = np.where(live[None, :], Space.distances(z, o), np.inf)
                first = d.argmin(1)
                if nearest:
                    # the routing objects are rows themselves: what they score is known at once
                    best, ids = space.unknown(len(q), k)
                    score = space.scores(space.exact(q), exact.T)
                    floor = np.partition(score, -min(k, len(cids)), axis=1)[:, -min(k, len(cids))]
                    r, c = np.nonzero(score >= floor[:, None])
                    _merged(r, score[r, c], cids[c], best, ids)
                    known = [[{"s": int(s), "c": int(i)} for s, i in zip(*p, strict=True) if i != _NONE] for p in zip(best.tolist(), ids.tolist(), strict=True)]
                    rows, cells = np.arange(len(q)), first
                else:
                    known = part.column("known").to_pylist()
                    best, ids = _known(known, space, k)
                    limit = space.limits(best[:, -1], ids[:, -1] != _NONE, (z * z).sum(1))
                    far = (d - radius[None, :] <= limit[:, None]) & live[None, :]
                    far[np.arange(len(q)), first] = False
                    rows, cells = np.nonzero(far)
                yield pa.RecordBatch.from_arrays([part.column("qid").take(pa.array(rows)), part.column("v").take(pa.array(rows)), pa.array(cells, pa.int32()), pa.array([known[r] for r in rows], _KNOWN)], names=["qid", "v", "cell", "known"])

    return run


_FOUND = pa.schema([("qid", pa.int64()), ("cid", pa.int64()), ("score", pa.int64())])


def _answers(space: Space, k: int, dim: int):
    def run(pages: pa.Table, queries: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        if pages.num_rows and queries.num_rows:
            cols = [pages.column(c).to_pylist() for c in ("page", "leaf", "child", "v", "radius", "up")]
            tree = opened(list(zip(*cols, strict=True)), space, dim)
            qid, q = queries.column("qid").to_numpy(), _dense(queries.column("v"))
            # queries alike go together: in the order of their distance to the tree's routing object
            order = np.argsort(Space.distances(space.queries(q), tree[0][2])[:, 0], kind="stable")
            for low in range(0, len(q), ASKED):
                some = order[low : low + ASKED]
                best, ids = _known(queries.column("known").take(pa.array(some)).to_pylist(), space, k)
                searched(tree, space, q[some], best, ids)
                r, c = np.nonzero(ids != _NONE)
                out.append((qid[some[r]], ids[r, c], best[r, c].astype(np.int64)))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], schema=_FOUND)

    return run


def _split(rows: DataFrame, name: str) -> DataFrame:
    """Into how many blocks the subtrees of more than BLOCK rows go."""
    return rows.groupBy("cell").count().select("cell", F.ceil(F.col("count") / BLOCK).cast("int").alias(name))


def exact_nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product of each queried row, exactly.

    vectors needs vec_id and embedding; other columns are ignored. A component x counts as floor(256 x). Rows
    whose vec_id is divisible by `every` are the queries, all other rows but the query's own the candidates;
    ties go to the smaller vec_id. Rows without id, null vectors and those with null or non-finite
    components take no part. Shorter vectors count as if zeros followed. Of rows that repeat a vec_id the
    least vector counts. An empty table gives an empty result. Components beyond 2**62 and scores that a long
    can't hold count as these bounds.

    Equal vectors are one point with their k + 1 smallest ids (no more can be among the k nearest of any
    row). A sample of at most CELLS points routes all others to subtrees, each written as pages of an M-tree
    (blocks of a large one are trees of their own). A query first searches the subtree of the nearest
    routing object, then those that its k-th best score doesn't rule out; within a tree it goes best-first.
    """
    spark, scrap = vectors.sparkSession, []

    def put(df: DataFrame) -> DataFrame:
        scrap.append(written(df))
        return scrap[-1]

    result = "query_id long, rank int, vec_id long, score long"
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v")).where("id is not null and v is not null")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(F.greatest(F.least(x * 256, F.lit(2.0**62)), F.lit(-(2.0**62))))))
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    if dim is None:
        return spark.createDataFrame([], result)
    dim = max(1, dim)
    rows = rows.withColumn("v", F.when(F.size("v") == dim, F.col("v")).otherwise(F.concat("v", F.array_repeat(F.lit(0).cast("long"), dim - F.size("v")))))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    points = rows.mapInArrow(_collapsed(k, every), "v array<long>, ids array<long>, asks boolean")
    points = points.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"), F.bool_or("asks").alias("asks"))
    points = put(points.select(F.col("ids")[0].alias("cid"), "v", "ids", "asks"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    longest, highest, many = points.agg(F.max(F.sqrt(norm)), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))), F.count("*")).first()
    space = Space(longest, highest, dim)

    sample = smallest(points.select("cid", "v"), min(CELLS, -(-many // CELL)), "cid").collect()
    ids, x = np.array([r["cid"] for r in sample], np.int64), np.array([r["v"] for r in sample], np.int64)
    centres = spark.sparkContext.broadcast(space.rows(x))
    placed = put(points.select("cid", "v").mapInArrow(_assigned(centres, space), "cid long, v array<long>, cell int, d double"))
    radii = {r["cell"]: r["d"] for r in placed.groupBy("cell").agg(F.max("d").alias("d")).collect()}  # CELLS rows at most
    top = spark.sparkContext.broadcast((ids, x, space.rows(x), np.array([radii.get(c, 0.0) + space.slack for c in range(len(ids))]), np.array([c in radii for c in range(len(ids))])))
    blocks = _split(placed, "rb")
    rb = F.broadcast(blocks)  # CELLS rows at most
    pages = placed.join(rb, "cell").withColumn("i", F.pmod(F.xxhash64("cid"), "rb").cast("int")).select("cell", "i", "cid", "v")
    pages = put(pages.groupBy("cell", "i").applyInArrow(_pages(centres, space), _PAGE_SQL))

    def answers(visits: DataFrame) -> DataFrame:
        """(qid, cid, score) of the pages and the queries that visit them."""
        visits = put(visits)
        size = F.broadcast(_split(visits, "qb"))  # CELLS rows at most
        p = pages.join(size, "cell").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("qb") - 1))).drop("qb")
        v = visits.join(size, "cell").join(rb, "cell").withColumn("j", F.pmod(F.xxhash64("qid"), "qb").cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)))
        key = ["cell", "i", "j"]
        return p.groupBy(*key).cogroup(v.select(*key, "qid", "v", "known").groupBy(*key)).applyInArrow(_answers(space, k + 1, dim), "qid long, cid long, score long")

    def best(found: DataFrame) -> DataFrame:
        """The k + 1 best points of each query."""
        place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "cid"))
        return found.distinct().withColumn("place", place).where(F.col("place") <= k + 1).drop("place")

    asks = points.where("asks").select(F.col("cid").alias("qid"), "v")
    first = put(best(answers(asks.mapInArrow(_visits(top, space, k + 1, True), _VISIT))))
    known = asks.join(first.groupBy("qid").agg(F.collect_list(F.struct(F.col("score").alias("s"), F.col("cid").alias("c"))).alias("known")), "qid")
    found = best(first.unionByName(answers(known.mapInArrow(_visits(top, space, k + 1, False), _VISIT))))

    entry = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("id")))
    lists = found.join(points.select("cid", "ids"), "cid").groupBy("qid").agg(F.slice(F.array_sort(F.flatten(F.collect_list(entry))), 1, k + 1).alias("near"))
    own = rows.where(F.col("id") % every == 0).join(points.where("asks").select("v", F.col("cid").alias("qid")), "v").select("id", "qid")
    near = own.join(lists, "qid").select("id", F.slice(F.filter("near", lambda e: e["id"] != F.col("id")), 1, k).alias("near"))
    out = near.select(F.col("id").alias("query_id"), F.posexplode("near").alias("pos", "e"))
    out = written(out.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("e.id").alias("vec_id"), (-F.col("e.s")).alias("score")))
    dropped(spark, *scrap)
    return out


def op11_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows of largest whole-number inner product of every fiftieth row. Null vectors and null or non-finite
    components take no part, ties go to the smaller vec_id, repeated ids count once, an empty table gives an empty
    result, other columns are ignored."""
    return exact_nearest(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
