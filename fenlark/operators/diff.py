"""Line diffs: unique common lines in their longest increasing order, and what lies between them; patches that can be applied."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

CELLS = 1 << 14  # cells of the table by which stretches without unique common lines are compared; larger ones are replaced as they are
CONTEXT = 3
TOGETHER = 64  # rows whose texts are Python objects at once


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (ordered by the first) whose second increases: patience sorting."""
    tops: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, j) in enumerate(pairs):
        k = bisect_left(tops, j)
        before[i] = last[k - 1] if k else -1
        if k == len(tops):
            tops.append(j)
            last.append(i)
        else:
            tops[k], last[k] = j, i
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def _table(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence of short lists."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (i, j) of lines that stay, in order: a[i] == b[j], both increasing."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        ca, cb = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        at = {b[j]: j for j in range(blo, bhi) if cb[b[j]] == 1}
        kept = _increasing([(i, at[a[i]]) for i in range(alo, ahi) if ca[a[i]] == 1 and a[i] in at])
        if kept:
            i0, j0 = alo, blo
            for i, j in [*kept, (ahi, bhi)]:
                todo.append((i0, i, j0, j))
                i0, j0 = i + 1, j + 1
            out += kept
        elif (ahi - alo) * (bhi - blo) <= CELLS:
            out += [(alo + i, blo + j) for i, j in _table(a[alo:ahi], b[blo:bhi])]
    return sorted(out)


def changes(a: list[str], b: list[str]) -> list[tuple[int, int, int, int]]:
    """(alo, ahi, blo, bhi): a[alo:ahi] becomes b[blo:bhi]; all else stays."""
    out, i0, j0 = [], 0, 0
    for i, j in [*common(a, b), (len(a), len(b))]:
        if i > i0 or j > j0:
            out.append((i0, i, j0, j))
        i0, j0 = i + 1, j + 1
    return out


def _range(low: int, high: int) -> str:
    return f"{low + 1}" if high - low == 1 else f"{low + (high > low)},{high - low}"


def unified(before: str, after: str, context: int = CONTEXT) -> str:
    """The patch from one text to the other, in unified form; empty where they are equal. Lines are what line feeds part."""
    a, b = before.split("\n"), after.split("\n")
    hunks: list[list] = []
    for c in changes(a, b):
        if hunks and c[0] - hunks[-1][-1][1] <= 2 * context:
            hunks[-1].append(c)
        else:
            hunks.append([c])
    out = ["--- ", "+++ "] if hunks else []
    for group in hunks:
        (alo, _, blo, _), (_, ahi, _, bhi) = group[0], group[-1]
        lead, tail = min(context, alo, blo), min(context, len(a) - ahi, len(b) - bhi)
        out.append(f"@@ -{_range(alo - lead, ahi + tail)} +{_range(blo - lead, bhi + tail)} @@")
        at = alo - lead
        for i0, i1, j0, j1 in group:
            out += [" " + x for x in a[at:i0]] + ["-" + x for x in a[i0:i1]] + ["+" + x for x in b[j0:j1]]
            at = i1
        out += [" " + x for x in a[at : ahi + tail]]
    return "\n".join(out)


def patched(before: str, patch: str) -> str | None:
    """The text after the patch; null where the patch names lines that are not there."""
    a, out, at, rows = before.split("\n"), [], 0, patch.split("\n") if patch else []
    for row in rows[2:]:
        if row.startswith("@@ "):
            start, _, size = row.split(" ")[1][1:].partition(",")
            first = int(start) - (size != "0")
            if first < at:
                return None
            out += a[at:first]
            at = first
        elif row.startswith("+"):
            out.append(row[1:])
        else:
            if a[at : at + 1] != [row[1:]]:
                return None
            if row.startswith(" "):
                out.append(row[1:])
            at += 1
    return "\n".join(out + a[at:])


def _each(f, *columns: pa.Array) -> pa.Array:
    """f of the columns' texts, null as empty, a few rows at a time: a batch of whole texts is never held as Python objects."""
    parts = [pa.array([], pa.string())]
    for low in range(0, len(columns[0]), TOGETHER):
        rows = zip(*(c.slice(low, TOGETHER).to_pylist() for c in columns), strict=True)
        parts.append(pa.array([f(*(x or "" for x in row)) for row in rows], pa.string()))
    return pa.concat_arrays(parts)


def unified_diff(before: Column, after: Column) -> Column:
    """The patch from one column to the other; null texts count as empty."""

    @arrow_udf("string")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return _each(unified, a, b)

    return run(before, after)


def apply_patch(before: Column, patch: Column) -> Column:
    """The column after its patch; null where it doesn't fit. Null texts count as empty, null patches change nothing."""

    @arrow_udf("string")
    def run(a: pa.Array, p: pa.Array) -> pa.Array:
        return _each(patched, a, p)

    return run(before, patch)


def added(patch: Column) -> Column:
    """The lines that a patch adds."""
    return F.transform(F.filter(F.slice(F.split(patch, "\n"), 3, F.size(F.split(patch, "\n"))), lambda z: z.startswith("+")), lambda z: F.substr(z, F.lit(2)))


def removed(patch: Column) -> Column:
    """The lines that a patch takes away."""
    return F.transform(F.filter(F.slice(F.split(patch, "\n"), 3, F.size(F.split(patch, "\n"))), lambda z: z.startswith("-")), lambda z: F.substr(z, F.lit(2)))
