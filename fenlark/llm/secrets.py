"""Secret scan: fixed patterns, and character Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import smallest, table
from .spans import listed, of_rank, ranked, spans

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "(?<![0-9a-f])[0-9a-f]{32,}"
WORD = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
SIGNS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
LEAST = 0.45  # mean log-likelihood ratio a transition from which a string counts as random
TRAINING_DOCUMENTS = 400  # the labelled sample's bound, wherever the input ends
# Words of which identifiers are made.
PARTS = (
    "get set user name file path list item index count value data time date type code read write open close load save page view size text line word node tree hash cache queue event state error "
    "result request response config option default handler manager service client server table column access account action active address after agent array async attribute before begin binary block body bool "
    "buffer build byte call cancel category char check child class clear clone color command comment common compare complete connect content context control convert copy create current custom debug decode delete "
    "depth description detail device dict dir display document domain double down driver edit element empty enable encode encoding entry environment exception execute exists export extension factory field filter find flag float folder format frame from "
    "function global graph group header height help host import info init input insert install integer internal iterator join key kind label language last layer left length level library limit link local lock logger lower map mask match max menu merge message "
    "method min mode model module mutex native network next null number object offset operator order output owner package panel parent parse patch pattern permission phase pool position prefix print process project property protocol provider public query random range raw "
    "record region register release remove rename render replace reset resource right root row rule schema scope screen search select sequence session shape source split stack start status step stop storage stream string style suffix symbol system target task template test thread "
    "token tool total trace transform trigger uniform union unique unknown update upper url valid variable vector version visible warning width window worker wrapper zone special character characters"
).split()


def labelled_sample(docs: DataFrame, texts: int = TRAINING_DOCUMENTS) -> DataFrame:
    """(text, random): random strings in the usual alphabets, and ordinary identifiers and words.

    Identifiers are made of common parts in the usual styles; words come from a bounded sample of docs
    (those of smallest hash), letters only, each once. Every string is labelled by how it came about.
    """
    spark = docs.sparkSession
    n = spark.range(0, 6000, 1, 4)
    bits = F.unhex(F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256))
    plain = F.base64(bits)
    strings = n.select(F.when(F.col("id") % 3 == 0, F.regexp_replace(plain, "=", "")).when(F.col("id") % 3 == 1, F.lower(F.hex(bits))).otherwise(F.regexp_replace(F.translate(plain, "+/=", "AZ"), "^(.{36}).*", "$1")).alias("text"), F.lit(True).alias("random"))
    parts = F.array(*(F.lit(p) for p in PARTS))

    def part(k: int) -> Column:
        return F.element_at(parts, (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(PARTS))) + 1).cast("int"))

    pick = F.pmod(F.xxhash64("id"), F.lit(100)).cast("string")
    styles = [
        F.concat_ws("_", part(1), part(2), part(3)),
        F.concat(part(1), F.initcap(part(2)), F.initcap(part(3)), F.initcap(part(4))),
        F.concat(F.concat_ws("-", part(1), part(2), part(3)), pick),
        F.upper(F.concat_ws("_", part(1), part(2), part(3))),
        F.concat(F.initcap(part(1)), F.initcap(part(2)), F.initcap(part(3)), pick),
        F.concat_ws("/", part(1), part(2), F.concat(part(3), F.lit("."), part(4))),
    ]
    names = n.select(F.element_at(F.array(*styles), (F.col("id") % len(styles) + 1).cast("int")).alias("text"), F.lit(False).alias("random"))
    some = smallest(docs.where("text is not null").select("text"), texts, "text")
    words = some.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0))).alias("text")).groupBy("text").count().select("text", F.lit(False).alias("random"))
    return strings.unionByName(names).unionByName(words)


def _pairs(text: Column) -> Column:
    """Each transition's number: signs from 1, 0 for any other."""
    at = F.transform(F.split(text, ""), lambda c: F.when(c == "", 0).otherwise(F.locate(c, F.lit(SIGNS)) if isinstance(c, str) else F.expr("0") + F.instr(F.lit(SIGNS), c)))
    n = len(SIGNS) + 1
    return F.element_at(F.transform(F.array(at), lambda a: F.zip_with(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.slice(a, 2, F.size(a)), lambda x, y: x * n + y)), 1)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of all transitions, random over ordinary, from samples(text, random).

    Counts are aggregated in Spark; at most two rows a transition (twice 63 * 63) reach the driver.
    """
    n = (len(SIGNS) + 1) ** 2
    counts = {True: [0.5] * n, False: [0.5] * n}
    rows = samples.where("text is not null and random is not null").select("random", F.explode(_pairs(F.col("text"))).alias("pair")).groupBy("random", "pair").count().collect()
    for r in rows:
        counts[r["random"]][r["pair"]] += r["count"]
    width = len(SIGNS) + 1
    out = []
    for i in range(0, n, width):
        a, b = (sum(counts[k][i : i + width]) for k in (True, False))
        out += [math.log(x / a) - math.log(y / b) for x, y in zip(counts[True][i : i + width], counts[False][i : i + width], strict=True)]
    return out


def score(text: Column, ratios: list[float]) -> Column:
    """The mean log-likelihood ratio of a string's transitions; null for under two characters."""
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in ratios)), ",").cast("array<double>")
    return F.element_at(F.transform(F.array(_pairs(text)), lambda p: F.when(F.size(p) > 0, F.aggregate(p, F.lit(0.0), lambda a, i: a + F.get(table, i)) / F.size(p))), 1)


def find_secrets(docs: DataFrame, ratios: list[float], least: float = LEAST) -> DataFrame:
    """docs with secret_spans, array<struct<rank, start, end>>: rank in KINDS, code points, end exclusive.

    Base kinds are fixed patterns; a failing match is dropped and not retried. The models add strings of
    20 or more characters that hold letters and digits, touch no base span and look random. A null or
    empty text has no spans. An existing column of that name is replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(spans(text, ASSIGN, (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & text.rlike(ASSIGN)), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 1)) >= 8)
    access = spans(text, ACCESS, F.contains(text, F.lit("AKIA")))
    base = F.concat(ranked(assign, 1), ranked(access, 2), ranked(spans(text, HEX), 3))
    mixed = F.filter(spans(text, WORD, text.rlike("[0-9]") & text.rlike(WORD)), lambda s: s["match"].rlike("[0-9]") & s["match"].rlike("[A-Za-z]"))
    likely = F.filter(mixed, lambda s: score(s["match"], ratios) >= least)
    both = docs.withColumn("secret_spans", F.struct(base.alias("base"), likely.alias("likely")))
    added = F.filter("secret_spans.likely", lambda s: ~F.exists("secret_spans.base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return both.withColumn("secret_spans", F.concat("secret_spans.base", ranked(added, 4)))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, train(labelled_sample(docs)))
    of = {k: of_rank("secret_spans", i) for i, k in enumerate(KINDS, 1)}
    base = F.filter("secret_spans", lambda s: s["rank"] <= 3)
    return found.select("doc_id", *(F.size(of[k]).cast("long").alias(f"n_{k}") for k in KINDS[:3]), F.sha2(listed(base, KINDS, "start"), 256).alias("base_sha256"), listed(F.col("secret_spans"), KINDS, "start").alias("spans"), F.size(of["random"]).cast("long").alias("n_random"))
