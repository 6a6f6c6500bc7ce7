"""A catalogue of types from sources: declarations, inheritance closed by doubling, members with what is inherited."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import csharp
from .scratch import written

_KINDS = [("path", pa.string()), ("namespace", pa.string()), ("type", pa.string()), ("kind", pa.string()), ("bases", pa.list_(pa.string())), ("member", pa.string()), ("member_kind", pa.string()), ("params", pa.string())]
_SQL = "path string, namespace string, type string, kind string, bases array<string>, member string, member_kind string, params string"


def _declared(batches):
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            part = batch.slice(low, 64)
            rows = [(p, *d) for p, t in zip(part.column("path").to_pylist(), part.column("text").to_pylist(), strict=True) for d in csharp.declarations(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_KINDS)], names=[n for n, _ in _KINDS])


def declarations(sources: DataFrame) -> DataFrame:
    """(path, namespace, type, kind, bases, member, member_kind, params) of sources (path, text): a row a type, whose
    member is null, and a row a member. Null and empty texts declare nothing; other columns are ignored."""
    return sources.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text")).mapInArrow(_declared, _SQL)


def ancestors(edges: DataFrame) -> DataFrame:
    """(type, ancestor, depth): all that is reachable over edges(type, base), at its least depth.

    What is reached in n steps is joined with itself, so that the rounds go with the logarithm of the
    deepest chain. Each round is written. A cycle's types are ancestors of themselves; null ends are ignored.
    """
    reach = written(edges.where("type is not null and base is not null").select("type", F.col("base").alias("ancestor"), F.lit(1).alias("depth")).distinct())
    before, n = -1, reach.count()
    while n != before:
        far = reach.select(F.col("type").alias("ancestor"), F.col("ancestor").alias("beyond"), F.col("depth").alias("more"))
        both = reach.unionByName(reach.join(far, "ancestor").select("type", F.col("beyond").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth")))
        reach = written(both.groupBy("type", "ancestor").agg(F.min("depth").alias("depth")))
        before, n = n, reach.count()
    return reach


def edges(declared: DataFrame) -> DataFrame:
    """(type, base), generic arguments and namespaces left out of a base's name."""
    return declared.where("member is null").select("type", F.explode("bases").alias("base")).select("type", F.element_at(F.split("base", r"\."), -1).alias("base")).distinct()


def members(declared: DataFrame, closed: DataFrame) -> DataFrame:
    """(type, member, member_kind, owner, depth): own and inherited members; the nearest declaration of a name counts. Constructors and enum values aren't inherited."""
    own = declared.where("member is not null").select(F.col("type").alias("owner"), "member", "member_kind").distinct()
    inherited = closed.join(own.where("member_kind not in ('constructor', 'value')"), F.col("ancestor") == F.col("owner")).select("type", "member", "member_kind", "owner", "depth")
    every = own.select(F.col("owner").alias("type"), "member", "member_kind", "owner", F.lit(0).alias("depth")).unionByName(inherited)
    return every.groupBy("type", "member").agg(F.min(F.struct("depth", "owner", "member_kind")).alias("m")).select("type", "member", "m.member_kind", "m.owner", "m.depth")
