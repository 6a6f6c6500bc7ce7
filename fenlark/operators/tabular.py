"""Relational operators over run, attempt, failure and review rows."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written


def rate(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, 0 for an empty whole."""
    return F.when(whole > 0, F.round(100.0 * part / whole, digits)).otherwise(F.lit(0.0))


def share_of_total(df: DataFrame, count: str, into: str = "pct") -> DataFrame:
    """Each row's share of the column's sum; meant for aggregated rows, which are few."""
    return df.withColumn(into, F.round(100.0 * F.col(count) / F.sum(count).over(Window.partitionBy()), 2))


def newest(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def latest(df: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row a key, the last by order; the greatest row where that doesn't decide. Null is a key like any other; columns are of orderable types."""
    rest = [c for c in df.columns if c != order]
    last = F.max(F.struct(*([order] if order else []), *rest)).alias("_row")
    return df.groupBy(*keys).agg(last).select(*(F.col(f"_row.{c}").alias(c) for c in df.columns))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Equal keys, null equal to null."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[f"_{k}"])
    return out


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str] = (), order: str | None = None) -> DataFrame:
    """Rows of new replace those of old with equal keys (null equals null); columns in keep stay as they were.
    Of new rows that repeat a key the last by order counts, the greatest row where that doesn't decide."""
    new = latest(new, keys, order)
    named = new.select(*(F.col(k).alias(f"_{k}") for k in keys))
    return old.join(named, _same(old, named, keys), "left_anti").unionByName(_kept(old, new, keys, list(keep)))


def _kept(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    if not keep:
        return new.select(old.columns)
    was = old.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(*(F.max(c).alias(f"_was_{c}") for c in keep))
    return new.join(was, _same(new, was, keys), "left").select(*(F.coalesce(f"_was_{c}", c).alias(c) if c in keep else new[c] for c in old.columns))


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old, and of new a row a key that old lacks (null equals null); of repeated keys the greatest row."""
    named = old.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    new = latest(new, keys)
    return old.unionByName(new.join(named, _same(new, named, keys), "left_anti").select(old.columns))


def quantiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """(group, a column a share): exact quantiles, linear between neighbours.

    Rows are dealt by ranges of group and value, so that a large group is many tasks' work and no task
    keeps its values: ranks are places within a range plus the counts of the ranges before, of which
    there is a row a range and group. Null values don't count.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).alias("v"))
    ranged = written(rows.repartitionByRange("g", "v").withColumn("p", F.spark_partition_id()))
    counts = ranged.groupBy("g", "p").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("g").orderBy("p")) - F.col("c")
    at = counts.select("g", "p", before.alias("before"), F.sum("c").over(Window.partitionBy("g")).alias("n"))
    place = F.row_number().over(Window.partitionBy("g", "p").orderBy("v")) - 1
    ranks = ranged.withColumn("place", place).join(at, ["g", "p"]).withColumn("r", F.col("before") + F.col("place"))
    out = []
    for name, share in shares.items():
        spot = share * (F.col("n") - 1)
        low, high = (F.max(F.when(F.col("r") == f(spot).cast("long"), F.col("v"))) for f in (F.floor, F.ceil))
        part = F.max(spot - F.floor(spot))
        out.append((low + (high - low) * part).alias(name))
    return ranks.groupBy(F.col("g").alias(group)).agg(*out)


def bins(value: Column, edges: list[float]) -> Column:
    """Histogram label "lo-hi": half-open, the last one closed; null outside."""
    out = None
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        upper = value <= hi if hi == edges[-1] else value < hi
        hit, label = (value >= lo) & upper, F.lit(f"{lo:g}-{hi:g}")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def direction(first: Column, last: Column) -> Column:
    """up, down or stable (under 5 %, or from 0)."""
    # shared by two branches, it may be worked out before the test for 0
    change = F.try_divide(last - first, first) * 100
    return F.when((first == 0) | (F.abs(change) < 5), "stable").when(change > 0, "up").otherwise("down")


def unpivot_refs(df: DataFrame, keys: list[str], refs: list[str]) -> DataFrame:
    """(keys, kind, ref): one row a non-empty reference column."""
    return df.unpivot(keys, refs, "kind", "ref").where("ref is not null and ref <> ''")


def _dealt(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """df with _p, its range of (key, order): a key of very many rows lies in many ranges, one after the other."""
    return written(df.repartitionByRange(key, *order).withColumn("_p", F.spark_partition_id()))


def _brought(ends: DataFrame, key: str, carry: Column) -> DataFrame:
    """(_p, _k, _b): what the ranges before bring to each range but the first of a key, carry over a row a range. Only
    keys on a border have any, so that these are fewer than the ranges, and fit to be broadcast."""
    ends = ends.withColumn("_first", F.min("_p").over(Window.partitionBy(key)))
    return F.broadcast(ends.withColumn("_b", carry).where("_p > _first").select("_p", F.col(key).alias("_k"), "_b"))


def as_of(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, values: list[str]) -> DataFrame:
    """For each left row the latest right row of its key at or before it (of several at one time the greatest values),
    by ranges of the sorted union and no range join: a key of very many rows is many tasks' work. A left row
    without a time has none; null is a key like any other."""
    a = left.select("*", F.col(left_ts).alias("_t"), F.lit(1).alias("_s"))
    b = right.select(F.col(key), F.col(right_ts).alias("_t"), F.lit(0).alias("_s"), F.struct(*values).alias("_v")).where("_t is not null")
    both = _dealt(a.unionByName(b, allowMissingColumns=True), key, ["_t", "_s"])
    w = Window.partitionBy("_p", key).orderBy("_t", "_s", "_v").rowsBetween(Window.unboundedPreceding, 0)
    ends = both.groupBy("_p", key).agg(F.max(F.when(F.col("_v").isNotNull(), F.struct("_t", "_v")))["_v"].alias("_v"))
    before = F.last("_v", ignorenulls=True).over(Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    found = both.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_s = 1").alias("x")
    found = found.join(_brought(ends, key, before).alias("y"), (F.col("x._p") == F.col("y._p")) & F.col(f"x.{key}").eqNullSafe(F.col("_k")), "left")
    last = F.when(F.col("_t").isNotNull(), F.coalesce("_v", "_b"))
    return found.select(*(F.col(f"x.{c}") for c in left.columns), *(last[v].alias(v) for v in values))


def running_count(df: DataFrame, key: str, order: list[str], hit: Column, into: str) -> DataFrame:
    """df with the number of rows up to each one, in the order of its key, that hit is true of. Ranges are counted apart
    and the counts of those before added, so that a key of very many rows is many tasks' work. Null is a key like
    any other; order is a total one."""
    rows = _dealt(df.withColumn("_h", F.when(hit, 1).otherwise(0).cast("long")), key, order)
    up = F.sum("_h").over(Window.partitionBy("_p", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    ends = rows.groupBy("_p", key).agg(F.sum("_h").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn(into, up).alias("x")
    found = rows.join(_brought(ends, key, before).alias("y"), (F.col("x._p") == F.col("y._p")) & F.col(f"x.{key}").eqNullSafe(F.col("_k")), "left")
    return found.select(*(F.col(f"x.{c}") for c in df.columns), (F.col(into) + F.coalesce("_b", F.lit(0))).alias(into))


def ordered_hash(df: DataFrame, group: str, key: str, into: str = "hash") -> DataFrame:
    """(group, hash): SHA-256 of each group's keys in byte order, a line feed between them, as the keys stream by:
    no group is held, however large. group is a long; null keys don't count."""

    def run(batches):
        last = state = None
        for batch in batches:
            done = []
            for g, k in zip(batch.column("g").to_pylist(), batch.column("k").to_pylist(), strict=True):
                if state is None or g != last:
                    if state is not None:
                        done.append((last, state.hexdigest()))
                    last, state = g, hashlib.sha256(k.encode())
                else:
                    state.update(b"\n" + k.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["g", "h"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([state.hexdigest()], pa.string())], names=["g", "h"])

    rows = df.select(F.col(group).cast("long").alias("g"), F.col(key).cast("string").alias("k")).where("k is not null")
    return rows.repartition("g").sortWithinPartitions("g", "k").mapInArrow(run, "g long, h string").select(F.col("g").cast(df.schema[group].dataType).alias(group), F.col("h").alias(into))
