"""Names most alike, by key joins in place of all pairs: rare shared characters gather candidates, matching blocks decide."""

from __future__ import annotations

import difflib
import math
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from .scratch import dealt, written

TOGETHER = 3  # characters that a key holds
SHARERS = 1000  # words of a key that one task meets with a name
NEAR = 0.9  # names with a word as near as this are done before the rest is looked for


@pandas_udf(DoubleType())
def ratio(word: pd.Series, name: pd.Series) -> pd.Series:
    """difflib's ratio: twice the characters in matching blocks, by those of both."""
    matcher, last, out = difflib.SequenceMatcher(), None, []
    for w, n in zip(word, name, strict=True):
        if n != last:
            matcher.set_seq2(n)
            last = n
        matcher.set_seq1(w)
        out.append(matcher.ratio())
    return pd.Series(out, dtype="float64")


def possible(a: Column, b: Column, cutoff: float) -> Column:
    """Whether a ratio of cutoff isn't ruled out: what matches is a common subsequence, so that lengths and the edit distance bound it."""
    both = F.length(a) + F.length(b)
    most = F.floor((1 - F.lit(cutoff)) * both + 1e-9).cast("int")
    # without a threshold levenshtein() is quadratic for long names; with one it gives -1 beyond it
    return (2 * F.least(F.length(a), F.length(b)) >= (cutoff - 1e-9) * both) & (F.levenshtein(a, b) <= most)


def _characters(name: Column) -> Column:
    """Each character with its number among the equal ones: as sets, what two names share is what their bags share."""
    each = F.split(name, "")
    return F.transform(each, lambda c, i: F.concat(c, F.size(F.filter(F.slice(each, 1, i), lambda d: d == c)).cast("string")))


def _needed(length: int, cutoff: float) -> int:
    """How many characters a name of this length shares with any name that is alike enough."""
    least = math.ceil(length * cutoff / (2 - cutoff) - 1e-9)
    return max(1, math.ceil(cutoff / 2 * (length + max(1, least)) - 1e-9))


def _short(cutoff: float) -> int:
    """The length up to which two names may need to share less than TOGETHER characters."""
    return next(n for n in range(1000) if math.ceil(cutoff / 2 * (n + 2) - 1e-9) >= TOGETHER)


def _keys(cutoff: float, ranks: DataFrame, names: DataFrame) -> DataFrame:
    """(name, key): subsets of TOGETHER of a name's rarest characters, and single ones of short names.

    Exact: of the characters that two names share, the TOGETHER rarest are among the first
    length - needed + TOGETHER of both, in any common order.
    """
    @pandas_udf("array<string>")
    def subsets(ordered: pd.Series) -> pd.Series:
        out = []
        for x in ordered:
            x = list(x)
            head = x[: len(x) - max(TOGETHER, _needed(len(x), cutoff)) + TOGETHER]
            keys = ["\0".join(c) for c in combinations(head, TOGETHER)]
            out.append(keys + (x if len(x) <= _short(cutoff) else []))
        return pd.Series(out, dtype=object)

    each = names.select("name", F.explode(_characters(F.col("name"))).alias("c")).join(ranks, "c", "left")
    # characters that no word has come first: they hold no candidates
    ordered = each.groupBy("name").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "c"))).alias("x"))
    return ordered.select("name", F.explode(subsets(F.transform("x", lambda s: s["c"]))).alias("key"))


def candidates(names: DataFrame, words: DataFrame, cutoff: float) -> DataFrame:
    """(name, word): all pairs whose characters may match to the cutoff, by keys; keys of many words are dealt in blocks."""
    names, words = (written(x.where(F.length("name") > 0).select("name").distinct()) for x in (names, words))
    ranks = written(words.select(F.explode(_characters(F.col("name"))).alias("c")).groupBy("c").agg(F.count("*").alias("n")))
    of_words = written(_keys(cutoff, ranks, words).withColumnRenamed("name", "word"))
    blocks = dealt(of_words.groupBy("key").agg(F.ceil(F.count("*") / SHARERS).cast("int").alias("s")))
    mine = _keys(cutoff, ranks, names).join(blocks, "key").withColumn("b", F.explode(F.sequence(F.lit(0), F.col("s") - 1))).drop("s")
    theirs = of_words.join(blocks, "key").withColumn("b", F.pmod(F.xxhash64("word"), F.col("s")).cast("int")).drop("s")
    both = F.length("name") + F.length("word")
    pairs = mine.join(dealt(theirs), ["key", "b"]).where(2 * F.least(F.length("name"), F.length("word")) >= (cutoff - 1e-9) * both)
    return pairs.select("name", "word").distinct().where(possible(F.col("name"), F.col("word"), cutoff))


def _best(pairs: DataFrame, keys: list[str], cutoff: float) -> DataFrame:
    """The word of highest ratio of each key; the larger word wins a tie."""
    scored = pairs.withColumn("score", ratio("word", "name")).where(F.col("score") >= cutoff)
    return scored.groupBy(*keys).agg(F.max(F.struct("score", "word")).alias("m")).select(*keys, "m.score", "m.word")


def _less(name: Column) -> Column:
    """The name without one of its characters, each way once."""
    at = F.sequence(F.lit(1), F.length(name))
    return F.array_distinct(F.transform(at, lambda i: F.concat(F.substr(name, F.lit(1), i - 1), F.substr(name, i + 1))))


def _next(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, word): all pairs that are equal or in which one has a single character more, by equal strings."""
    more = words.select(F.explode(_less(F.col("word"))).alias("name"), "word").join(dealt(names), "name")
    less = names.select("name", F.explode(F.array_append(_less(F.col("name")), F.col("name"))).alias("word")).join(dealt(words), "word")
    return more.select("name", "word").unionByName(less.select("name", "word"))


def closest(names: DataFrame, words: DataFrame, cutoff: float) -> DataFrame:
    """(name, score, word) for every distinct name that a word is like: what difflib.get_close_matches(name, words, 1, cutoff) gives.

    names and words have a column name; nulls and empty names match nothing, repeats count once, an empty
    side gives an empty result. Meant for cutoffs of 0.5 and more: the lower, the more candidates. So names
    with a word that lacks or adds a single character are done first: any other word leaves two characters
    of both unmatched, so that its ratio with a name of n is n / (n + 1) at most. Of the rest, those
    with a word of ratio NEAR come next: what is nearer still is among the same candidates. No side is
    gathered anywhere.
    """
    names, words = (written(x.where(F.length("name") > 0).select("name").distinct()) for x in (names, words))
    n = F.length("name")
    pairs = _next(names, words.withColumnRenamed("name", "word"))
    alike = written(_best(pairs, ["name"], cutoff).where(F.col("score") > n / (n + 1) + 1e-9))
    names = written(names.join(dealt(alike), "name", "left_anti"))
    return alike if names.isEmpty() else alike.unionByName(_far(names, words, cutoff))


def _far(names: DataFrame, words: DataFrame, cutoff: float) -> DataFrame:
    """closest() by rare characters."""
    if cutoff >= NEAR:
        return _best(candidates(names, words, cutoff), ["name"], cutoff)
    near = written(_best(candidates(names, words, NEAR), ["name"], NEAR))
    left = written(names.select("name").distinct().join(dealt(near), "name", "left_anti"))
    return near.unionByName(_best(candidates(left, words, cutoff), ["name"], cutoff))


def closest_within(names: DataFrame, words: DataFrame, key: str, cutoff: float) -> DataFrame:
    """(key, name, score, word): as closest, among the words of the name's key alone, for any cutoff."""
    names, words = names.select(key, "name").distinct(), words.select(key, F.col("name").alias("word")).distinct()
    pairs = names.join(dealt(words), key).where((F.length("name") > 0) & (F.length("word") > 0) & possible(F.col("name"), F.col("word"), cutoff))
    return _best(pairs, [key, "name"], cutoff)
