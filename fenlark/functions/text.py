"""Column expressions: signatures, keys, cosines, set changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(x: Column) -> Column:
    """Without white space at either end; no regular expression, which is slow on whole documents."""
    return F.btrim(x, F.lit(" \t\n\r\x0b\f"))


def signature(code: Column) -> Column:
    """SHA-256 of the stripped code with one kind of line end."""
    return F.sha2(F.replace(stripped(code), F.lit("\r\n"), F.lit("\n")), 256)


def example_key(*parts: Column) -> Column:
    """16 hex digits over the parts, in lower case and with forward slashes; null parts are empty."""
    joined = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.substring(F.sha2(F.lower(F.replace(joined, F.lit("\\"), F.lit("/"))), 256), 1, 16)


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision, clipped to 0..1; 0 for empty or zero vectors."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / norm))).otherwise(0.0)


def set_changes(before: Column, after: Column) -> tuple[Column, Column]:
    """What was added and what was removed, sorted."""
    return F.array_sort(F.array_except(after, before)), F.array_sort(F.array_except(before, after))
