"""Removal of long repeated substrings by a partitioned, sparse suffix array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U, chunks, dropped, prefix_sums, span_hash, table, texts_of, written

SPAN = 100  # bytes of a repeated string
LEAD = 32  # leading bytes by which suffixes are compared first
REACH = SPAN - LEAD
CHUNK = 1 << 20


def _flat(texts: list[bytes]):
    """The texts end to end, their bounds, and for each byte its text's end."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), np.uint8), bounds


def anchors(data: np.ndarray, bounds: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes to sort, and of each the first and last start of the 100-byte windows that chose it.

    A window chooses its leftmost least 32-byte hash. Equal windows choose equal places, so repeated
    windows meet at suffixes of equal leading bytes, while only about one suffix in 35 has to move.
    """
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return none, none, none
    at = np.arange(len(data) - LEAD + 1)
    key = (span_hash(sums, at, at + LEAD) >> U(32) << U(32)) | at.astype(U)
    width, least = 1, key
    while 2 * width <= REACH + 1:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = REACH + 1 - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    ends = np.repeat(bounds[1:], np.diff(bounds))[: len(least)]
    start = np.flatnonzero(np.arange(len(least)) + SPAN <= ends)
    if not len(start):
        return none, none, none
    p = (least[start] & U(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
    return p[new], start[new], start[np.append(new[1:], len(p)) - 1]


_ROW = pa.schema([("g", pa.int64()), ("c", pa.int64()), ("e", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64())])
_SQL = "g long, c long, e long, doc_id long, at long"
_WITH = _ROW.append(pa.field("near", pa.binary()))
_WITH_SQL = _SQL + ", near binary"
CROWD = 20_000  # suffixes of equal leading bytes that one task compares in memory; more are compared window by window


def _digests(strings: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """BLAKE2b of 128 bits of each string, as two columns: no one can build two strings of one digest."""
    flat = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in strings), "<i8")
    return flat[::2], flat[1::2]


def _once(g, c, e, doc, at):
    """Of rows with equal g, c and e, the earliest; and which of the others are later ones."""
    order = np.lexsort((at, doc, e, c, g))
    g, c, e, doc, at = g[order], c[order], e[order], doc[order], at[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (e[1:] != e[:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
    later = (doc != doc[lead]) | (at != at[lead])
    return g, c, e, doc, at, new, later


def _runs(doc, start, end) -> pa.RecordBatch:
    """Overlapping intervals of each document, joined: rows of g null, c the end, at the start."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if len(doc):
        # documents are set apart so that one running maximum serves all
        _, where = np.unique(doc, return_inverse=True)
        gap = int(end.max()) + 1
        top = np.maximum.accumulate(end + where * gap)
        first = np.concatenate(([True], (start + where * gap)[1:] > top[:-1]))
        last = np.append(np.flatnonzero(first)[1:] - 1, len(doc) - 1)
        doc, start, end = doc[first], start[first], (top - where * gap)[last]
    return pa.RecordBatch.from_arrays([pa.nulls(len(doc), pa.int64()), pa.array(end, pa.int64()), pa.nulls(len(doc), pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int64())], schema=_ROW)


def _rows(g, c, e, doc, at) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (g, c, e, doc, at)], schema=_ROW)


def _suffixes(batches):
    """Anchored suffixes: g = 3 leading bytes and a hash of 32, c and e = digest of the windows that chose it, at = position, left and right reach."""
    for batch in chunks(batches, "text", CHUNK):
        texts = texts_of(batch)
        data, bounds = _flat(texts)
        sums = prefix_sums(data)
        p, low, high = anchors(data, bounds, sums)
        if not len(p):
            continue
        row = np.searchsorted(bounds, p, "right") - 1
        left, right = p - low, high + SPAN - p
        lead = (data[p].astype(U) << U(16)) | (data[p + 1].astype(U) << U(8)) | data[p + 2].astype(U)
        g = ((lead << U(40)) | (span_hash(sums, p, p + LEAD) & U((1 << 40) - 1))).view(np.int64)
        whole = data.tobytes()
        c, e = _digests(bytes((x, y)) + whole[i - x : i + y] for i, x, y in zip(p.tolist(), left.tolist(), right.tolist(), strict=True))
        doc = batch.column("doc_id").to_numpy(zero_copy_only=False)[row]
        g, c, e, doc, at, new, later = _once(g, c, e, doc, ((p - bounds[row]) << 14) | (left << 7) | right)
        yield _rows(g[new], c[new], e[new], doc[new], at[new])
        yield _runs(doc[later], *_reach(at[later]))


def _reach(at):
    return (at >> 14) - (at >> 7 & 127), (at >> 14) + (at & 127)


def _classes(batches):
    """Sorted suffixes in; out come the runs that an earlier equal surrounding covers, and of each
    group of equal leading bytes but different surroundings the earliest of each (c null)."""
    group = held = None  # the last row's g; its group's only class so far
    first = None  # (g, c, e, doc, at) of the class at the end of the last batch
    for batch in batches:
        g, c, e, doc, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        n = len(g)
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (e[1:] != e[:-1])
        if first is not None:
            new[0] = (g[0], c[0], e[0]) != first[:3]
        lead = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        ldoc, lat = np.where(lead < 0, first[3] if first else 0, doc[lead]), np.where(lead < 0, first[4] if first else 0, at[lead])
        later = (doc != ldoc) | (at != lat)
        heads = np.flatnonzero(new)
        hg = g[heads]
        same = np.zeros(len(heads), bool)
        same[1:] = hg[1:] == hg[:-1]
        joins = len(heads) > 0 and group is not None and hg[0] == group
        if joins:
            same[0] = True
        many = same.copy()
        many[:-1] |= same[1:]
        out = heads[many]
        if joins and held is not None:
            yield _rows([held[0]], [None], [None], [held[3]], [held[4]])
        if len(out):
            yield _rows(g[out], [None] * len(out), [None] * len(out), doc[out], at[out])
        if later.any():
            yield _runs(doc[later], *_reach(at[later]))
        if len(heads):
            i = heads[-1]
            first = (g[i], c[i], e[i], doc[i], at[i])
            held = None if many[-1] else first
        group = g[-1]


def _spread(p, at):
    """The windows of anchors at p: which anchor, start, and how far before the anchor they begin."""
    left, size = at >> 7 & 127, (at >> 7 & 127) + (at & 127) - SPAN + 1
    which = np.repeat(np.arange(len(p)), size)
    s = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + (p - left)[which]
    return which, s, p[which] - s


def _plus(rows: pa.RecordBatch, near=None) -> pa.RecordBatch:
    near = pa.nulls(rows.num_rows, pa.binary()) if near is None else pa.array(near, pa.binary())
    return pa.RecordBatch.from_arrays([*rows.columns, near], schema=_WITH)


def _surroundings(batches):
    """For documents with listed anchors: the bytes of the windows at each (near), or, where very many
    suffixes share their leading bytes, a row a window: g and c = its digest, at = start."""
    for batch in chunks(batches, "text", CHUNK):
        texts = texts_of(batch)
        data, bounds = _flat(texts)
        lists = batch.column("listed")
        counts = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        h, at, crowded = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("g", "at", "crowded"))
        crowded = crowded.astype(bool)
        row = np.repeat(np.arange(len(texts)), counts)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        few = np.flatnonzero(~crowded)
        if len(few):
            low, high = _reach(at[few])
            near = [texts[i][a:b] for i, a, b in zip(row[few].tolist(), low.tolist(), high.tolist(), strict=True)]
            zero = np.zeros(len(few), np.int64)
            yield _plus(_rows(h[few], zero, zero, ids[row[few]], at[few]), near)
        many = np.flatnonzero(crowded)
        if len(many):
            row = row[many]
            which, s, _ = _spread((at[many] >> 14) + bounds[row], at[many])
            whole = data.tobytes()
            g, c = _digests(whole[i : i + SPAN] for i in s.tolist())
            g, c, e, doc, at, new, later = _once(g, c, np.zeros(len(g), np.int64), ids[row[which]], s - bounds[row[which]])
            yield _plus(_rows(g[new], c[new], e[new], doc[new], at[new]))
            yield _plus(_runs(doc[later], at[later], at[later] + SPAN))


def multikey(data: np.ndarray, start: np.ndarray, tag: np.ndarray, size: int = SPAN) -> np.ndarray:
    """Classes of equal tags and equal strings of `size` bytes, by multikey quicksort: all strings are split
    by one key of eight bytes, then only those that are still equal by the next."""
    keys = np.ndarray((max(0, len(data) - 7),), ">u8", np.ascontiguousarray(data), 0, (1,))
    of, live = np.unique(tag, return_inverse=True)[1], np.arange(len(start))
    for at in [*range(0, size - 8, 8), size - 8]:
        live = live[np.bincount(of)[of[live]] > 1] if len(live) else live
        if not len(live):
            break
        key = keys[start[live] + at].astype(U)
        order = np.lexsort((key, of[live]))
        live, key = live[order], key[order]
        new = np.ones(len(live), bool)
        new[1:] = (of[live][1:] != of[live][:-1]) | (key[1:] != key[:-1])
        of[live] = of.max() + np.cumsum(new)
    return of


def _compared(rows: pa.Table) -> pa.RecordBatch:
    """Whole groups of anchors with their bytes in; the runs that earlier equal windows cover out. Bytes decide, no hash does."""
    g, doc, at = (rows.column(k).to_numpy() for k in ("g", "doc_id", "at"))
    near = rows.column("near").to_pylist()
    data, bounds = _flat(near)
    which, s, back = _spread(bounds[:-1] + (at >> 7 & 127), at)
    start = (at >> 14) - (at >> 7 & 127)
    # equal windows lie alike about their anchors
    tag = np.unique(g, return_inverse=True)[1][which] * SPAN + back
    c = multikey(data, s, tag)
    zero = np.zeros(len(c), np.int64)
    _, _, _, doc, at, _, later = _once(c, zero, zero, doc[which], s - bounds[which] + start[which])
    return _runs(doc[later], at[later], at[later] + SPAN)


def _repeats(batches):
    """Rows sorted by g, c, document and place in, the runs that earlier equal windows cover out."""
    first, held = None, []
    for batch in batches:
        known = pc.is_null(batch.column("g"))
        if pc.any(known).as_py():
            yield batch.filter(known).select(_ROW.names)
            batch = batch.filter(pc.invert(known))
        listed = pc.is_valid(batch.column("near"))
        groups = batch.filter(listed)
        if groups.num_rows:
            held.append(groups)
            if sum(b.num_rows for b in held) >= CROWD:
                rows = pa.Table.from_batches(held)
                whole = rows.filter(pc.not_equal(rows["g"], rows["g"][-1]))
                held = rows.filter(pc.equal(rows["g"], rows["g"][-1])).to_batches()
                if whole.num_rows:
                    yield _compared(whole)
        batch = batch.filter(pc.invert(listed))
        g, c, doc, at = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("g", "c", "doc_id", "at"))
        n = len(g)
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
        if first is not None:
            new[0] = (g[0], c[0]) != first[:2]
        lead = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        later = (doc != np.where(lead < 0, first[2] if first else 0, doc[lead])) | (at != np.where(lead < 0, first[3] if first else 0, at[lead]))
        if later.any():
            yield _runs(doc[later], at[later], at[later] + SPAN)
        if new.any():
            i = np.flatnonzero(new)[-1]
            first = (g[i], c[i], doc[i], at[i])
    if held:
        yield _compared(pa.Table.from_batches(held))


def _kept(keep_text: bool):
    def run(batches):
        for batch in chunks(batches, "text"):
            out = []
            for text, runs in zip(texts_of(batch), batch.column("runs").to_pylist(), strict=True):
                spans: list[list[int]] = []
                for r in sorted((r["at"], r["c"]) for r in runs or ()):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r[1])
                    else:
                        spans.append([*r])
                rest, at = [], 0
                for a, b in spans:
                    rest.append(text[at:a])
                    at = b
                rest = b"".join([*rest, text[at:]])
                out.append((len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest))
            cols = list(zip(*out, strict=True))
            arrays = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in cols[:3]), pa.array(cols[3])]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                arrays.append(pa.array(cols[4], pa.binary()))
                names.append("kept_bytes")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * keep_text


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept_bytes]): texts without what is repeated.

    A byte goes if a 100-byte string that covers it also starts earlier (smaller doc_id, or earlier in
    the same document), judged on the input. Suffixes at content-chosen anchors are range-partitioned by
    sampled splitters of their leading bytes and sorted within partitions; suffixes of equal leading
    bytes and equal surroundings (told by digests of 128 bits) repeat the earliest one wholly. Where surroundings
    differ, the 100-byte windows around the anchor are compared by their bytes in a second sort, as a group in one
    task or, for crowded leading bytes, by their digests, a row a window. Rows with equal keys collapse within each
    chunk of input first, so that copies don't pile up in one task, and sorted streams need no group in
    memory.

    Nulls count as empty texts. Rows without doc_id, and rows that repeat a doc_id with another text,
    are left whole and take no part; rows that repeat both count once. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    odd = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(h := F.xxhash64("text")).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select("doc_id")
    odd = written(odd)
    named = docs.where("doc_id is not null")
    live = named if odd.isEmpty() else named.join(odd, "doc_id", "left_anti")
    suffixes = written(live.mapInArrow(_suffixes, _SQL))
    ranged = suffixes.where("g is not null").repartitionByRange("g").sortWithinPartitions("g", "c", "e", "doc_id", "at")
    # rows without g are runs found so far
    second = written(suffixes.where("g is null").unionByName(ranged.mapInArrow(_classes, _SQL)))
    dropped(spark, suffixes)
    listed = second.where("g is not null")
    crowds = listed.groupBy("g").count().where(F.col("count") > CROWD).select("g", F.lit(True).alias("crowded"))
    listed = listed.join(crowds, "g", "left").groupBy("doc_id").agg(F.collect_list(F.struct("g", "at", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("listed"))
    near = live.join(listed, "doc_id").mapInArrow(_surroundings, _WITH_SQL)
    # hash partitions here: these rows are not stored, and splitters would need them twice
    later = near.repartition("g", "c").sortWithinPartitions("g", "c", "doc_id", "at").mapInArrow(_repeats, _SQL)
    runs = second.where("g is null").unionByName(later)
    runs = runs.groupBy("doc_id").agg(F.collect_list(F.struct("at", "c")).alias("runs"))
    run, schema = _kept(keep_text)
    rest = docs.where("doc_id is null").unionByName(named.join(odd, "doc_id", "left_semi"))
    rest = rest.withColumn("runs", F.lit(None).cast("array<struct<at:long,c:long>>"))
    return live.join(runs, "doc_id", "left").unionByName(rest).mapInArrow(run, schema)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)
