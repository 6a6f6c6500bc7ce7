"""How the term counts of sources diverge from one another and from their language: cells of equal counts, ranked."""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, dropped, table, texts_of, written

SCALE = 1_000_000_000  # shares are counted in billionths
FLUSH = 200_000  # distinct terms that a task holds before it passes them on
SMALL = 100_000  # rows (some 10 MB) up to which a counted table is broadcast
#: what isn't part of a term becomes a space, and A-Z lower case
_FOLD = bytes(i + 32 if 65 <= i <= 90 else i if i >= 97 and not 123 <= i <= 127 else 32 for i in range(256))
_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("df", pa.int64())])


def terms(text: bytes) -> list[bytes]:
    """Letters A-Z in lower case, a-z and all that isn't ASCII, in unbroken stretches."""
    return text.translate(_FOLD).split()


def _counted(batches):
    """Occurrences and documents of each term by group, summed up over as many documents as FLUSH allows."""
    n: dict[tuple, Counter] = defaultdict(Counter)
    df: dict[tuple, Counter] = defaultdict(Counter)

    def out():
        for (lang, source), counts in n.items():
            names = list(counts)
            arrays = [pa.array([lang] * len(names)), pa.array([source] * len(names)), pa.array(names, pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64()), pa.array([df[lang, source][t] for t in names], pa.int64())]
            for batch in pa.Table.from_arrays(arrays, schema=_COUNTED).to_batches(50_000):
                yield batch
        n.clear()
        df.clear()

    for batch in batches:
        for part in chunks([batch], "text"):
            for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts_of(part), strict=True):
                found = terms(text)
                n[lang, source].update(found)
                df[lang, source].update(set(found))
            if sum(map(len, n.values())) > FLUSH:
                yield from out()
    yield from out()


def _share(count: Column | str, total: Column | str, v: Column | str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * v)), exactly: the product can exceed a long."""
    count, total, v = (F.col(c) if isinstance(c, str) else c for c in (count, total, v))
    over = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    parts = F.struct(over.alias("a"), (total + 2 * v).cast("decimal(20,0)").alias("b"))
    # the quotient of decimals rounds; the remainder does not
    rest = parts["a"] % parts["b"]
    return F.lit(1).cast("long") + ((parts["a"] - rest) / parts["b"]).cast("decimal(20,0)").cast("long")


def _value(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)). Shares are at most SCALE + 1, so that the square fits a long."""
    square = (p - q) * (p - q)
    return F.floor((square - square % (p + q)).cast("decimal(20,0)") / (p + q).cast("decimal(20,0)")).cast("long")


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= SMALL else df


def divergence(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): for each group of documents (lang, source), how far its shares
    of terms are from every other group's of the language (part pair), and the `top` terms that it has too
    often (part term).

    docs needs text, lang and source; null counts as ''. A language keeps the terms of at least `least` of
    its documents. Shares are whole billionths, smoothed by two occurrences; the value of two shares p and q is
    floor((p - q)^2 / (p + q)), summed up over all kept terms for a pair. Ties go by the UTF-8 bytes of
    the item. Groups without terms are there too; a language of one source has no pairs, one without kept
    terms only zeros. Repeated rows count each time; an empty table gives an empty result; other columns are
    ignored.

    Values depend on two counts only. So terms are gathered in cells of equal counts, a value is computed a
    cell, cells are ranked by value and cumulative size, cells of equal values merge, and only the cells that
    reach the top are expanded to terms. For pairs, terms of equal counts in all sources collapse first;
    cells in which a count is zero follow from the sources' own cells, so that only terms that two sources
    share meet.
    """
    spark, scrap = docs.sparkSession, []

    def put(df: DataFrame) -> DataFrame:
        scrap.append(written(df))
        return scrap[-1]

    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    known = docs.select("lang", "source").distinct()
    counted = docs.mapInArrow(_counted, "lang string, source string, term string, n long, df long").repartition("lang", "term")
    by_source = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    kept = by_source.groupBy("lang", "term").agg(F.sum("n").alias("ln"), F.sum("df").alias("df"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("held"))
    kept = put(kept.where(F.col("df") >= least).drop("df"))

    langs = kept.groupBy("lang").agg(F.sum("ln").alias("ln"), F.count("*").alias("v"))
    rows = kept.select("lang", "term", F.col("ln").alias("lc"), F.explode("held").alias("h")).select("lang", "term", "lc", "h.source", F.col("h.n").alias("gc"))
    cells = put(rows.groupBy("lang", "source", "gc", "lc").agg(F.count("*").alias("m")))
    totals = cells.groupBy("lang", "source").agg(F.sum(F.col("gc") * F.col("m")).alias("n"))
    groups = put(known.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "ln", "v"))))
    few = _small(groups)

    out = put(_pairs(kept, cells, few).unionByName(_terms(rows, cells, few, top)))
    dropped(spark, *scrap[:-1])
    return out


def _terms(rows: DataFrame, cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    shares = cells.join(groups, ["lang", "source"]).withColumn("p", _share("gc", "n", "v")).withColumn("q", _share("lc", "ln", "v"))
    valued = shares.where("p > q").withColumn("value", _value(F.col("p"), F.col("q"))).select("lang", "source", "gc", "lc", "m", "value")
    # of merged equal values the `top` largest are enough, and of these those with less than `top` terms before them
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    merged = merged.withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= top)
    reach = merged.withColumn("before", F.sum("m").over(ordered) - F.col("m")).where(F.col("before") < top).select("lang", "source", "value", "before")
    named = _small(written(valued.join(reach, ["lang", "source", "value"]).select("lang", "source", "gc", "lc", "value")))
    found = rows.join(named, ["lang", "source", "gc", "lc"]).select("lang", "source", "value", F.col("term").alias("item"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", place).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(kept: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Values of both orders of each pair: v * f(0, 0), corrected where one or both counts aren't zero."""
    alike = kept.groupBy("lang", "held").agg(F.count("*").alias("m"))
    first = alike.select("lang", "m", "held", F.posexplode("held").alias("i", "x"))
    both = first.select("lang", "m", "x", F.explode(F.slice("held", F.col("i") + 2, F.greatest(F.size("held"), F.lit(1)))).alias("y"))
    both = both.groupBy("lang", F.col("x.source").alias("a"), F.col("y.source").alias("b"), F.col("x.n").alias("ca"), F.col("y.n").alias("cb")).agg(F.sum("m").alias("m"))
    ga, gb = (groups.select("lang", "v", F.col("source").alias(s), F.col("n").alias(n)) for s, n in (("a", "na"), ("b", "nb")))
    pairs = ga.join(gb.drop("v"), "lang").where("a < b")

    def f(ca: str | Column, cb: str | Column) -> Column:
        return _value(_share(ca, "na", "v"), _share(cb, "nb", "v"))

    zero = F.lit(0).cast("long")
    own = cells.groupBy("lang", "source", "gc").agg(F.sum("m").alias("m"))
    mine = own.join(pairs, (own["lang"] == pairs["lang"]) & (own["source"] == pairs["a"])).select(pairs["lang"], "a", "b", (F.col("m") * (f("gc", zero) - f(zero, zero))).alias("value"))
    other = own.join(pairs, (own["lang"] == pairs["lang"]) & (own["source"] == pairs["b"])).select(pairs["lang"], "a", "b", (F.col("m") * (f(zero, "gc") - f(zero, zero))).alias("value"))
    shared = both.join(ga, ["lang", "a"]).join(gb.drop("v"), ["lang", "b"]).select("lang", "a", "b", (F.col("m") * (f("ca", "cb") - f("ca", zero) - f(zero, "cb") + f(zero, zero))).alias("value"))
    none = pairs.select("lang", "a", "b", F.when(F.col("v") > 0, F.col("v") * f(zero, zero)).otherwise(zero).alias("value"))
    total = none.unionByName(mine).unionByName(other).unionByName(shared).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    ways = total.select("lang", "value", sides.alias("s")).select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    return ways.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents. Null text, lang and source count as '', repeated rows each time; an empty table
    gives an empty result, other columns are ignored."""
    return divergence(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
t AS (SELECT lang, term, count(*) AS c FROM w GROUP BY 1, 2 HAVING count(DISTINCT i) >= 10),
s AS (SELECT w.lang, w.source, w.term, count(*) AS c FROM w JOIN t ON t.lang = w.lang AND t.term = w.term GROUP BY 1, 2, 3),
l AS (SELECT lang, sum(c)::HUGEINT AS n, count(*)::HUGEINT AS v FROM t GROUP BY 1),
g AS (SELECT lang, source FROM d GROUP BY 1, 2),
n AS (SELECT g.lang, g.source, coalesce(sum(s.c), 0)::HUGEINT AS n FROM g LEFT JOIN s ON s.lang = g.lang AND s.source = g.source GROUP BY 1, 2),
p AS (SELECT n.lang, n.source, t.term, coalesce(s.c, 0) AS c,
    (1 + 1000000000::HUGEINT * (coalesce(s.c, 0) + 2) // (n.n + 2 * l.v))::HUGEINT AS p, (1 + 1000000000::HUGEINT * (t.c + 2) // (l.n + 2 * l.v))::HUGEINT AS q
  FROM n JOIN l ON l.lang = n.lang JOIN t ON t.lang = n.lang LEFT JOIN s ON s.lang = n.lang AND s.source = n.source AND s.term = t.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM k WHERE part = 'pair' OR rank <= 10
"""
