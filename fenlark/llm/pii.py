"""Personal data by weak supervision: labellers vote on candidate spans, expectation-maximisation weighs them."""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .spans import listed, of_rank, spans

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "handle", "national", "contact", "person"]
# Possessive quantifiers keep matching linear; an address may begin where the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "handle": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]++(?:(?: ?[(\[] ?dot ?[)\]] ?|\.)[A-Za-z0-9-]++)++| at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++)",
    "national": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "contact": r"(?<![0-9+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
# Given names and family names that are frequent in several countries.
GIVEN = (
    "james mary john patricia robert jennifer michael linda william elizabeth david barbara richard susan joseph jessica thomas sarah charles karen "
    "anna peter maria paul laura emma julia daniel sofia carlos lucia jean marie pierre claire hans greta klaus ingrid jose carmen luis elena antoine camille "
    "nicolas sophie francois isabelle juan miguel pablo isabel wolfgang jürgen ursula monika helga stefan andreas sabine martin lukas lena felix "
    "giovanni francesca marco giulia ahmed fatima mohammed aisha wei mei yuki hiroshi kenji priya rahul anita ivan olga dmitri natasha george helen alice oliver"
).split()
FAMILY = (
    "smith johnson williams brown jones miller davis wilson anderson taylor moore martin lee thompson white clark lewis walker hall young king wright "
    "müller schmidt schneider fischer weber meyer wagner becker hoffmann garcía garcia fernández fernandez gonzález gonzalez rodríguez rodriguez lópez lopez martínez martinez sánchez sanchez pérez perez "
    "dubois bernard durand moreau laurent lefebvre rossi russo ferrari bianchi ivanov petrov kim chen wang li zhang nguyen tanaka suzuki patel singh khan"
).split()
TITLES = "(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme|Señor|Señora)"
DOMAINS = "com org net edu gov io de fr es uk eu info".split()
CUES = r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|mail|e-mail|email|contact|write to|ssn|social security|card|visa|mastercard|iban|ip|address|name|signed|patient|telefon|correo|courriel|teléfono)\b[^A-Za-z0-9]{0,6}\S{0,12}[^A-Za-z0-9]{0,3}$"
COUNTER = r"(?i)(?:\b(?:version|isbn|issn|order|invoice|part|figure|page|chapter|serial|model|build|ticket)\b[^A-Za-z0-9]{0,6}|[#$€=/_])$"
PATTERNS["person"] = rf"(?<![\p{{L}}])(?:{TITLES}\.? \p{{Lu}}\p{{Ll}}++|(?:{'|'.join(n.capitalize() for n in GIVEN)})(?= \p{{Lu}}))(?: \p{{Lu}}\p{{Ll}}++)*+"
VOTERS = ("form", "list", "cue", "counter", "edge")
BELIEVED = 0.95  # posterior from which the classifier adds a span


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    """Of a string of digits: whether it passes; doubled are every second digit from the right."""
    twice = lambda n: n * 2 - F.when(n > 4, 9).otherwise(0)
    at = F.transform(F.split(F.reverse(x), ""), lambda c, i: F.when(i % 2 == 1, twice(c.try_cast("int"))).otherwise(c.try_cast("int")))
    return F.aggregate(at, F.lit(0), lambda a, n: a + F.coalesce(n, F.lit(0))) % 10 == 0


def valid(rank: Column, match: Column) -> Column:
    """What a base kind asks of its matches; true for the other kinds."""
    d = _digits(match)
    n = F.length(d)
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    ip = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return F.when(rank == 2, ip).when(rank == 3, n.between(13, 19) & _luhn(d)).when(rank == 4, n.between(9, 15)).otherwise(True)


def candidates(text: Column) -> Column:
    """array<struct<rank, start, end, match, left, right>>: what any pattern matches, with 32 code points before and one after."""
    text = F.coalesce(text, F.lit(""))
    has = lambda x: F.contains(text, F.lit(x))
    at = has("(at") | has("( at") | has("[at") | has("[ at") | has(" dot ")
    tests = {"email": has("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9](?:[ -]?[0-9]){12}"), "phone": text.rlike(r"\+[0-9]"), "handle": at, "national": text.rlike("[0-9]-[0-9]{2}-[0-9]"), "contact": text.rlike("[0-9]{3}[ .-][0-9]{4}")}
    # a name has two capitalised words; few texts pass this on to the list of names
    tests["person"] = text.rlike(r"\p{Lu}\p{Ll}+\.? \p{Lu}") & text.rlike(PATTERNS["person"])
    out = []
    for rank, kind in enumerate(KINDS, 1):
        found = spans(text, PATTERNS[kind], tests.get(kind))
        if kind == "card":  # of all numbers in a text, only those that can be one
            found = F.filter(found, lambda s: F.length(s["match"]) >= 13)
        out.append(_wide(found, rank, text))
    return F.concat(*out)


def _wide(found: Column, rank: int, text: Column) -> Column:
    return F.transform(found, lambda s: F.struct(F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"),
        F.substring(text, F.greatest(s["start"] - 31, F.lit(1)), F.least(s["start"], F.lit(32))).alias("left"), F.substring(text, s["end"] + 1, F.lit(1)).alias("right")))


def votes(s: Column) -> list[Column]:
    """Each labeller's vote on a candidate: 1 personal, 0 not, 2 none."""
    rank, match, left, right = s["rank"], s["match"], s["left"], s["right"]
    d = _digits(match)
    lower = F.lower(match)
    form = F.when(rank == 6, ~match.rlike("^(?:000|666|9)|-00-|-0000$")).when(rank == 7, match.rlike(r"^\(?[2-9][0-9]{2}\)?.[2-9]")).when(rank == 8, match.rlike(r"^(?:" + TITLES + r"\.? )?\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+$")).when(rank == 5, match.rlike("[A-Za-z]{2,}$")).otherwise(valid(rank, match))
    known = F.when(rank.isin(1, 5), F.when(F.regexp_extract(lower, "([a-z]+)$", 1).isin(*DOMAINS), 1).otherwise(2))
    known = known.when(rank == 2, F.when(match.rlike(r"^(?:0|10|127|192\.168|255)\."), 0).otherwise(2))
    known = known.when(rank == 3, F.when(d.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|62)"), 1).otherwise(0))
    known = known.when(rank == 4, F.when(match.rlike(r"^\+[1-9]"), 1).otherwise(0))
    named = F.exists(F.split(lower, " "), lambda w: w.isin(*FAMILY)) | match.rlike("^" + TITLES)
    known = known.when(rank == 8, F.when(named, 1).otherwise(2)).when(rank == 6, F.when(match.rlike("^(?:000|666|9)"), 0).otherwise(2)).otherwise(2)
    edge = F.when(left.rlike("[A-Za-z0-9_]$") | right.rlike("[A-Za-z0-9_]"), 0).otherwise(2)
    return [F.when(form, 1).otherwise(0), known, F.when(left.rlike(CUES), 1).otherwise(2), F.when(left.rlike(COUNTER), 0).otherwise(2), edge]


def features(s: Column) -> list[Column]:
    """Bounded categories that the classifier sees beside the votes: what stands before and after, and the length."""
    side = lambda c: F.when(c == "", "b").when(c.rlike(r"\s"), "s").when(c.rlike("[A-Za-z0-9]"), "w").otherwise("p")
    return [side(F.regexp_extract(s["left"], r"(?s)(.)$", 1)), side(s["right"]), F.least(F.length(s["match"]) / 8, F.lit(4)).cast("int").cast("string")]


def estimate(counts: dict[tuple, float], rounds: int = 50) -> tuple[dict, dict]:
    """Reliabilities of the labellers by expectation-maximisation, over counts of (kind, votes, ...).

    Returns each labeller's probabilities of a vote, by true class, and the posterior of each key.
    A labeller that abstains says nothing. Start: a labeller is right 8 times of 10.
    """
    p = {(j, y): (0.8 if y == 1 else 0.2) for j in range(len(VOTERS)) for y in (0, 1)}  # probability of a vote 1 in class y
    prior: dict[int, float] = defaultdict(lambda: 0.5)
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for key in counts:
            log = math.log(prior[key[0]]) - math.log(1 - prior[key[0]])
            for j, v in enumerate(key[1]):
                if v != 2:
                    log += math.log(p[j, 1] if v else 1 - p[j, 1]) - math.log(p[j, 0] if v else 1 - p[j, 0])
            post[key] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
        up, both = defaultdict(lambda: 1.0), defaultdict(lambda: 2.0)
        for key, n in counts.items():
            up[key[0]] += n * post[key]
            both[key[0]] += n
        prior = {k: up[k] / both[k] for k in both}
        for j in range(len(VOTERS)):
            for y in (0, 1):
                one, all_ = (8.0 if y else 2.0), 10.0  # as many imagined votes as the start says
                for key, n in counts.items():
                    if key[1][j] != 2:
                        w = n * (post[key] if y else 1 - post[key])
                        one, all_ = one + w * key[1][j], all_ + w
                p[j, y] = one / all_
    return p, post


def train(docs: DataFrame) -> dict[str, float]:
    """Weights of the final span classifier: log-odds of each feature's values under the posterior labels.

    Votes and features of all candidates in docs are counted in Spark. Only the counts reach the driver:
    a row for each combination that occurs, of which there are 8 kinds x 3 ** 5 votes x 80 at most.
    """
    c = docs.select(candidates(F.col("text")).alias("c")).where(F.size("c") > 0).select(F.explode(apart(F.col("c"), True)).alias("s"))
    s = F.col("s")
    cols = [s["rank"].alias("rank"), F.array(*votes(s)).alias("votes"), F.array(*features(s)).alias("features")]
    rows = c.select(*cols).groupBy("rank", "votes", "features").count().collect()
    counts = {(r["rank"], tuple(r["votes"]), tuple(r["features"])): float(r["count"]) for r in rows}
    _, post = estimate(counts)
    yes, no = defaultdict(lambda: 0.5), defaultdict(lambda: 0.5)
    for key, n in counts.items():
        for name in ["bias", *_names(key)]:
            yes[name] += n * post[key]
            no[name] += n * (1 - post[key])
    bias = math.log(yes["bias"] / no["bias"])
    return {k: bias if k == "bias" else math.log(yes[k] / no[k]) - bias for k in sorted(set(yes) | set(no))}


def _names(key: tuple) -> list[str]:
    return [f"k{key[0]}", *(f"v{j}{v}" for j, v in enumerate(key[1]) if v != 2), *(f"f{j}{v}" for j, v in enumerate(key[2]))]


def belief(s: Column, weights: dict[str, float]) -> Column:
    """The classifier's posterior that a candidate is personal data."""
    total = F.lit(weights.get("bias", 0.0))

    def one(value: Column, names: dict) -> Column:
        out = None
        for v, w in names.items():
            out = F.when(value == v, w) if out is None else out.when(value == v, w)
        return F.lit(0.0) if out is None else out.otherwise(0.0)

    total = total + one(s["rank"], {k: weights[f"k{k}"] for k in range(1, len(KINDS) + 1) if f"k{k}" in weights})
    for j, v in enumerate(votes(s)):
        total = total + one(v, {x: weights[f"v{j}{x}"] for x in (0, 1) if f"v{j}{x}" in weights})
    for j, v in enumerate(features(s)):
        total = total + one(v, {k[2:]: w for k, w in weights.items() if k.startswith(f"f{j}")})
    return 1 / (1 + F.exp(-total))


def find_personal(docs: DataFrame, weights: dict[str, float], believed: float = BELIEVED) -> DataFrame:
    """docs with pii_spans, array<struct<rank, start, end>>: rank in KINDS, code points, end exclusive.

    Base kinds are patterns whose matches are checked; failing ones are dropped, not retried. Of the
    candidates of the other kinds that touch no base span, the classifier adds those that it believes;
    no rule stands before it. A null or empty text has no spans, an empty table no rows; repeated rows
    get equal spans. An existing column of that name is replaced.
    """
    c = docs.withColumn("pii_spans", candidates(F.col("text")))
    return c.withColumn("pii_spans", personal(F.col("pii_spans"), weights, believed))


def personal(found: Column, weights: dict[str, float], believed: float = BELIEVED) -> Column:
    """The spans of find_personal from a column of candidates; of texts without any, nothing more is computed."""
    both = F.filter(apart(found), lambda s: (s["rank"] <= len(BASE)) | (belief(s, weights) >= believed))
    kept = F.transform(both, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end")))
    return F.when(F.size(found) > 0, kept).otherwise(F.array().cast("array<struct<rank:int,start:int,end:int>>"))


def apart(found: Column, failing: bool = False) -> Column:
    """Base candidates (valid ones, unless failing ones are asked for too) and others that touch none of these."""

    def joined(x: Column) -> Column:
        base = F.filter(x, lambda s: (s["rank"] <= len(BASE)) & (F.lit(failing) | valid(s["rank"], s["match"])))
        both = F.struct(base.alias("base"), F.filter(x, lambda s: s["rank"] > len(BASE)).alias("more"))
        free = lambda y: F.filter(y["more"], lambda s: ~F.exists(y["base"], lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        return F.element_at(F.transform(F.array(both), lambda y: F.concat(y["base"], free(y))), 1)

    return F.element_at(F.transform(F.array(found), joined), 1)


def redacted(text: Column, found: Column) -> Column:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"))))
    zero = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        parts = F.when(fresh, F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["rank"])))).otherwise(acc["parts"])
        return F.struct(parts.alias("parts"), F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate(order, zero, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.greatest(F.length(text) - acc["at"], F.lit(0)))))
    return F.when(F.size(found) > 0, done).otherwise(text)


def op2_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal(docs, train(docs))
    base = F.filter("pii_spans", lambda s: s["rank"] <= len(BASE))
    counts = [F.size(of_rank("pii_spans", i)).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE, 1)]
    return found.select("doc_id", *counts, F.sha2(listed(base, KINDS, "rank"), 256).alias("base_sha256"), listed(F.col("pii_spans"), KINDS, "rank").alias("spans"))
