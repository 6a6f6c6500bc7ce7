"""Connected components by alternating large-star and small-star steps, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a, b); component is the smallest node reachable.

    Null ends and loops are ignored; an edgeless input gives an empty result. No step gathers a
    node's neighbours: minima come from partial aggregates, joined back.
    """
    spark = edges.sparkSession
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _signature(edges)
    while seen[0]:
        # large star: each larger neighbour of a node gets the least of its neighbourhood
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours get the least of them
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        step = written(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        dropped(spark, edges)
        edges, now = step, _signature(step)
        if now == seen:
            break
        seen = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
