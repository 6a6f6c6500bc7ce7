"""Places of regular-expression matches, from built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 256


def _sums(x: Column) -> Column:
    """0 and the running totals."""
    return F.aggregate(x, F.array(F.lit(0).cast("int")), lambda acc, v: F.array_append(acc, F.element_at(acc, -1) + v))


def _before(x: Column) -> Column:
    """For each entry, the total of those before it. Blocks keep the cost near linear."""
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _BLOCK).cast("int")), lambda j: _sums(F.slice(x, j * _BLOCK + 1, _BLOCK)))
    held = F.transform(parts, lambda p: F.element_at(p, -1))

    def joined(both: Column) -> Column:
        return F.flatten(F.transform(both["p"], lambda p, j: F.transform(F.slice(p, 1, F.size(p) - 1), lambda v: v + F.get(both["at"], j))))

    wide = F.element_at(F.transform(F.array(F.struct(parts.alias("p"), _sums(held).alias("at"))), joined), 1)
    return F.when(F.size(x) <= _BLOCK, _sums(x)).otherwise(wide)


def none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,match:string>>")


def spans(text: Column, pattern: str, possible: Column | None = None) -> Column:
    """array<struct<start, end, match>> of the leftmost non-overlapping matches, in code points, end exclusive.

    Matches come from regexp_extract_all, their places from the lengths of what split() leaves between
    them. The pattern may not match the empty string. possible: a cheap test without which no match can be.
    """
    text = F.coalesce(text, F.lit(""))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(x: Column) -> Column:
        sizes = F.zip_with(x["m"], F.slice(x["g"], 1, F.size(x["m"])), lambda m, g: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
        steps = F.transform(sizes, lambda s: s["g"] + s["m"])
        y = F.transform(F.array(F.struct(sizes.alias("s"), _before(steps).alias("b"), x["m"].alias("m"))), lambda y: F.transform(
            y["m"], lambda m, i: F.struct((F.get(y["b"], i) + F.get(y["s"], i)["g"]).alias("start"), (F.get(y["b"], i) + F.get(y["s"], i)["g"] + F.length(m)).alias("end"), m.alias("match"))))
        return F.element_at(y, 1)

    found = F.element_at(F.transform(F.array(F.struct(matches.alias("m"), gaps.alias("g"))), placed), 1)
    test = text.rlike(pattern) if possible is None else possible
    return F.when(test, found).otherwise(none())


def listed(items: Column, kinds: list[str], order: str) -> Column:
    """kind:start:end of array<struct<rank, start, end>> (rank from 1 in kinds), comma-joined, by "rank" or "start" first."""
    first, second = ("rank", "start") if order == "rank" else ("start", "rank")
    ordered = F.array_sort(F.transform(items, lambda s: F.struct(s[first], s[second], s["end"].alias("end"))))
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s[first] if order == "rank" else s[second]), (s[second] if order == "rank" else s[first]).cast("string"), s["end"].cast("string"))), ",")


def ranked(items: Column, rank: int) -> Column:
    return F.transform(items, lambda s: F.struct(F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end")))


def of_rank(items: Column | str, rank: int) -> Column:
    return F.filter(items, lambda s: s["rank"] == rank)
