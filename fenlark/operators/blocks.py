"""Documents as lines, fenced blocks and contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

HEAD = 5  # leading lines that stand for a block whose signature is not found
SHARERS, HOLDERS = 1000, 10_000  # documents that have a unit among their rarest, and that hold it, whose pairs one task forms
LONG = 64  # common units up to which a document takes them along


def lines(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, i, line): lines from 0, split at \\n or \\r\\n."""
    return docs.select(key, F.posexplode(F.split(text, "\r?\n")).alias("i", "line"))


def islands(rows: DataFrame, key: str, flag: Column) -> DataFrame:
    """(key, first, n): runs of consecutive lines for which flag holds."""
    w = Window.partitionBy(key).orderBy("i")
    hit = rows.where(flag).withColumn("g", F.col("i") - F.row_number().over(w))
    return hit.groupBy(key, "g").agg(F.min("i").alias("first"), F.count("*").alias("n")).drop("g")


def overlap(units: DataFrame, key: str, unit: str, least: float) -> DataFrame:
    """(a, b, common, ratio): pairs a < b that share `least` of the smaller one's distinct units.

    Such a pair shares one of the smaller document's rarest units: with n units, one of the
    n - ceil(least * n) + 1 that the fewest documents hold. Only those are looked up among the units of
    other documents, so that frequent lines form candidates only where a document has nothing rarer.
    A document's common units go along to where it may meet others. There a pair is told, and counted, at the
    rarest unit that both hold, so that pairs are never shuffled: what is shuffled grows with the documents, also
    where the pairs grow with their square. Documents of over LONG common units don't carry them; their candidates
    are made distinct and counted by equi-joins.
    """
    u = written(units.select(F.col(key).alias("k"), F.xxhash64(unit).alias("h")).distinct())
    # units of one document alone can't be common; they only count in its size, and come first in the order of rarity
    held = u.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    common = F.sort_array(F.collect_list(F.when(F.col("df").isNotNull(), F.struct("df", "h"))))
    d = u.join(held, "h", "left").groupBy("k").agg(F.count("*").alias("n"), common.alias("us"))
    d = written(d.withColumn("m", F.size("us")).where("m > 0"))
    # a product just over a whole number must not cost a unit
    first = F.slice("us", 1, F.greatest(F.col("m") - F.ceil(least * F.col("n") - 1e-9).cast("int") + 1, F.lit(0)))
    x = d.select(F.col("k").alias("x"), F.col("n").alias("nx"), F.col("m").alias("mx"), F.col("us.h").alias("xs"), F.posexplode(first).alias("i", "u")).withColumns({"h": F.col("u.h"), "df": F.col("u.df")})
    y = d.select(F.col("k").alias("y"), F.col("n").alias("ny"), F.col("m").alias("my"), F.col("us.h").alias("ys"), F.explode("us.h").alias("h"))
    sharers = x.groupBy("h").agg(F.count("*").alias("r"), F.max("df").alias("df"))
    short_x, short_y = x.where(F.col("mx") <= LONG), y.where(F.col("my") <= LONG)
    # rounded shares are looked up: there is one a number of common units, not one a pair
    shares = F.transform(F.sequence(F.lit(1), "mx"), lambda c: F.round(c / F.col("nx"), 6))
    short_x = short_x.select("h", "x", "nx", F.slice("xs", 1, F.col("i")).alias("before"), F.slice("xs", F.col("i") + 2, F.col("mx")).alias("after"), shares.alias("shares"))
    met = _met(short_x, short_y, sharers).where(F.when(F.size("before") == 0, True).otherwise(~F.arrays_overlap("before", "ys")))
    number = F.when(F.size("after") == 0, 0).otherwise(F.size(F.array_intersect("after", "ys"))) + 1
    # as an element it is worked out once, not again for each use
    met = met.select("x", "y", "nx", "shares", F.explode(F.array(number)).alias("common")).where(F.col("common") / F.col("nx") >= least)
    met = met.select("x", "y", F.col("common").cast("long").alias("common"), F.element_at("shares", F.col("common")).alias("ratio"))

    x, y = x.select("h", "x", "nx", "mx"), y.select("h", "y", "ny", "my")
    pairs = _met(x.where(F.col("mx") > LONG), y, sharers).unionByName(_met(x.where(F.col("mx") <= LONG), y.where(F.col("my") > LONG), sharers)).select("x", "y", "nx").distinct()
    full = d.select("k", F.explode("us.h").alias("h"))
    both = pairs.join(full.withColumnRenamed("k", "x"), "x").join(full.withColumnRenamed("k", "y"), ["y", "h"])
    counted = both.groupBy("x", "y", "nx").agg(F.count("*").alias("common")).where(F.col("common") / F.col("nx") >= least)
    counted = counted.select("x", "y", "common", F.round(F.col("common") / F.col("nx"), 6).alias("ratio"))
    return met.unionByName(counted).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "common", "ratio")


def _met(x: DataFrame, y: DataFrame, sharers: DataFrame) -> DataFrame:
    """x with the y that hold the same unit h and come after it by size, then key. A unit's rows are dealt in cells of
    some SHARERS x and HOLDERS y, so that no task has all its pairs, and in as many tasks as a shuffle has: these
    rows are few bytes that make many pairs."""
    n = int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = sharers.select("h", F.ceil(F.col("r") / SHARERS).cast("int").alias("nr"), F.ceil(F.col("df") / HOLDERS).cast("int").alias("nc"))

    def dealt(df, key, own, others):
        rows = df.join(cells, "h").withColumn(own, F.pmod(F.xxhash64(key), F.col(f"n{own}")).cast("int"))
        return rows.withColumn(others, F.explode(F.sequence(F.lit(0), F.col(f"n{others}") - 1))).drop("nr", "nc").repartition(n, "h", "r", "c")

    after = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    # the right side's rows of a cell are kept, which are the fewer
    return dealt(y, "y", "c", "r").hint("merge").join(dealt(x, "x", "r", "c"), ["h", "r", "c"]).where(after)


def head(text: Column) -> Column:
    """Hash of the first five lines, stripped, in lower case and without closing semicolons; blank ones drop, and null if none is left."""
    some = F.slice(F.split(text, "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]", HEAD + 1), 1, HEAD)
    kept = F.transform(F.filter(some, lambda s: _bare(s) != ""), lambda s: F.rtrim(F.lower(_bare(s)), F.lit(";")))
    return F.when(F.size(kept) > 0, F.unhex(F.sha2(F.array_join(kept, "\n"), 256)))


def _bare(text: Column) -> Column:
    """functions.text.stripped without a regular expression, which is slow on whole documents."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def _held(rows: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """rows with n, the number of blocks with the same key. There is one count a key, so that the rows of a hot
    key can be split among tasks by the adaptive skew join; none are gathered."""
    n = blocks.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return rows.join(n, key, "left").select(F.coalesce("n", F.lit(0)).alias("n"), *(c for c in rows.columns if c != key))


def resolve(targets: DataFrame, blocks: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n): how many blocks a target may mean. Those with its whole text's signature; only where there is none, those with its head."""
    keys = [F.unhex(F.sha2(F.replace(_bare(F.col(text)), F.lit("\r\n"), F.lit("\n")), 256)).alias("signature"), head(F.col(text)).alias("head")]
    blocks = blocks.select(*keys)
    first = _held(targets.select(key, *keys), blocks, "signature")
    second = _held(first.where("n = 0").select(key, "head"), blocks, "head")
    return first.where("n > 0").select(key, "n").unionByName(second.select(key, "n"))
