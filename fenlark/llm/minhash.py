"""MinHash near-duplicates: fast similarity sketches, banding, exact verification on full shingle sets."""

from __future__ import annotations

import hashlib
import secrets
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U, chunks, dropped, mix, table, texts_of, written
from .components import components

BANDS, ROWS = 36, 6
SHARERS = 1000  # sets with a shingle in common that one task pairs with all others
_SEEDS = mix(np.arange(1, 1 + 4 * BANDS * ROWS, dtype=U) * U(0x9E3779B97F4A7C15))


def sketch(items: np.ndarray, t: int = BANDS * ROWS) -> np.ndarray:
    """Fast similarity sketch of a set of 64-bit hashes.

    Round i < t throws every item into a hashed bin with a value in [i, i + 1); round t + j throws all
    into bin j, so that after 2t rounds no bin is empty. Each bin keeps its least value; rounds stop as
    soon as all are full, which takes one or a few rounds of a set larger than t ln t.
    """
    out = np.full(t, np.iinfo(U).max, U)
    for i in range(2 * t):
        h = mix(items ^ _SEEDS[i])
        value = (h & U((1 << 40) - 1)) | U(i << 40)
        if i < t:
            np.minimum.at(out, (((h >> U(40)) * U(t)) >> U(24)).astype(np.int64), value)
        elif out[i - t] == np.iinfo(U).max:
            out[i - t] = value.min()
        if i >= 2 and not (out == np.iinfo(U).max).any():
            break
    return out


def bands(items: np.ndarray) -> np.ndarray:
    rows = sketch(items).reshape(BANDS, ROWS)
    acc = _SEEDS[:BANDS].copy()
    for j in range(ROWS):
        acc = mix(acc * U(0xD6E8FEB86659FD93) + rows[:, j])
    return acc.view(np.int64)


def normal(text: bytes) -> list[bytes]:
    """Words, A-Z in lower case: bytes split at space and \\x09-\\x0D alone."""
    return text.lower().split()


def grams(ids: np.ndarray, k: int) -> np.ndarray:
    """A number for each k words in a row, equal where all the words (numbered by ids) are: nothing is hashed."""
    top = int(ids.max()) + 1 if len(ids) else 1
    out, bound = ids, top
    for j in range(1, k):
        if bound * top >= 1 << 62:
            out = np.unique(out, return_inverse=True)[1]
            bound = len(out)
        out, bound = out[:-1] * top + ids[j:], bound * top
    return out


def shingled(texts: list[list[bytes]], k: int, salt: int) -> list[np.ndarray]:
    """For each text a hash of every distinct k-word shingle; under k words, of the whole sequence; none without words.

    Shingles are told apart by their words. Hashes go into sketches and gather candidates; the salt is
    drawn for each run, so that nobody can build texts of equal hashes.
    """
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for t in texts for w in t), np.int64)
    w = np.array([xxhash.xxh3_64_intdigest(x, salt) for x in names], U)[ids] if len(ids) else np.zeros(0, U)
    told, hashed = grams(ids, k) if len(ids) >= k else ids[:0], w.copy()
    for j in range(1, min(k, len(w))):
        hashed[: len(w) - j] = mix(hashed[: len(w) - j] * U(0xD6E8FEB86659FD93) + w[j:])
    out, a = [], 0
    for t in texts:
        b = a + len(t)
        if b - a >= k:
            out.append(hashed[a + np.unique(told[a : b - k + 1], return_index=True)[1]])
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(t), salt)], U))
        else:
            out.append(np.zeros(0, U))
        a = b
    return out


def _signed(k: int, salt: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in chunks(batches, "text"):
            texts = [normal(t) for t in texts_of(batch)]
            sets = shingled(texts, k, salt)
            keys = [hashlib.sha256(b" ".join(t)).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array([bands(s) if len(s) else None for s in sets], pa.list_(pa.int64()))], schema=schema)

    return run, "doc_id long, n_shingles long, digest binary, bands array<long>"


def _normalised(batches):
    """Texts as their words, one space between them, and the digest of that."""
    for batch in chunks(batches, "text"):
        texts = [b" ".join(normal(t)) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(texts, pa.binary())], names=["doc_id", "digest", "text"])


def in_common(a: bytes, b: bytes, k: int) -> int:
    """How many shingles two normalised texts share, by their words."""
    if a == b:
        return -1
    x, y = a.split(b" "), b.split(b" ")
    if min(len(x), len(y)) < k:
        return 0  # a sequence of under k words is a shingle of its own, and these two differ
    names: dict[bytes, int] = {}
    told = grams(np.fromiter((names.setdefault(w, len(names)) for w in chain(x, y)), np.int64, len(x) + len(y)), k)
    return len(np.intersect1d(told[: len(x) - k + 1], told[len(x) :]))


def _common(k: int, percent: int):
    """a, b and the size of the intersection of their sets; sets of too different sizes are not compared."""

    def run(batches):
        for batch in chunks(batches, "ta", 4 << 20):
            rows = zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "ta", "tb")), strict=True)
            n = [0 if 100 * min(x, y) < percent * max(x, y) else in_common(s, t, k) for x, y, s, t in rows]
            # equal words have all in common
            n = [x if c < 0 else c for c, x in zip(n, batch.column("na").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("na"), batch.column("nb"), pa.array(n, pa.int64())], names=["a", "b", "na", "nb", "both"])

    return run


def _compared(pairs: DataFrame, sets: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs (a, b) and whether they are linked, from the words of all their shingles."""
    sa = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("text").alias("ta"))
    sb = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("text").alias("tb"))
    both = pairs.join(sb, "b").join(sa, "a").mapInArrow(_common(k, percent), "a long, b long, na long, nb long, both long")
    return both.select("a", "b", (100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).alias("linked"))


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members, with component c, of the buckets (key) in which components differ."""
    at = members.join(found.select(F.col("node").alias("id"), F.col("component").alias("c")), "id", "left").withColumn("c", F.coalesce("c", "id"))
    mixed = at.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    return at.join(mixed, "key", "left_semi")


def _tokens(k: int, salt: int):
    def run(batches):
        for batch in chunks(batches, "text", 1 << 20):
            sets = shingled([t.split(b" ") for t in batch.column("text").to_pylist()], k, salt)
            ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), pa.array(ids)], names=["token", "id"])

    return run


def _own(sets: DataFrame, k: int, salt: int) -> DataFrame:
    """(id, u): u shingles of the set are in no other of these sets."""
    return sets.mapInArrow(_tokens(k, salt), "token long, id long").groupBy("token").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n = 1").groupBy("id").agg(F.count("*").alias("u"))


def _prefix_pairs(sets: DataFrame, of: DataFrame, percent: int, k: int, salt: int, put=written) -> DataFrame:
    """Pairs (a, b) of sets in different components (of: id, c, n) for which a link isn't ruled out.

    Exact: in any order of the shingles, here from the rarest, linked sets share one of their first
    n - ceil(n * percent / 100) + 1. From the first one they share, enough must be left in both.
    Shingles of very many sets are dealt in blocks, so that no task holds all pairs of one.
    """
    held = sets.join(of.select(F.col("id").alias("doc_id")), "doc_id", "left_semi").mapInArrow(_tokens(k, salt), "token long, id long")
    often = held.groupBy("token").agg(F.count("*").alias("df"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "token"))
    first = held.join(often, "token").withColumn("p", place).where("df > 1").join(of, "id").where(F.col("p") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    first = put(first.select("token", "id", "c", "n", "p"))
    blocks = first.groupBy("token").agg(F.ceil(F.count("*") / SHARERS).cast("int").alias("s"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("token", "s")
    at = first.join(blocks, "token")
    x = at.select("token", F.pmod(F.xxhash64("id"), "s").cast("int").alias("k"), *(F.col(k).alias(k + "a") for k in ("id", "c", "n", "p")))
    y = at.select("token", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("k"), *(F.col(k).alias(k + "b") for k in ("id", "c", "n", "p")))
    most = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) + 1
    fits = 100 * most >= percent * (F.col("na") + F.col("nb") - most)
    return x.join(y, ["token", "k"]).where((F.col("ida") < F.col("idb")) & (F.col("ca") != F.col("cb")) & fits).select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): classes of documents linked by Jaccard >= percent / 100.

    docs needs doc_id and text; further columns are ignored. Texts of equal words (told by SHA-256) form one
    class, whose smallest doc_id stands for it, so copies never meet pairwise. Classes that share a band of their
    sketches are compared with the smallest class of that bucket, and where components differ after
    that, with the class that has the fewest shingles of its own. Classes that still share a bucket with
    another component are compared where they share one of their rarest shingles, of which a link needs
    one. Every link is confirmed on the words of all shingles; hashes, salted for each run, only gather candidates.

    Null or wordless texts have n_shingles 0 and no links. Rows without doc_id have no component and
    are kept. Rows that repeat a doc_id share its component. An empty table gives an empty result.
    """
    spark, scrap, salt = docs.sparkSession, [], secrets.randbits(63)

    def put(df: DataFrame) -> DataFrame:
        scrap.append(written(df))
        return scrap[-1]

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run, schema = _signed(k, salt)
    signed = put(docs.mapInArrow(run, schema))
    live = signed.where("doc_id is not null and n_shingles > 0")
    classes = put(live.groupBy("n_shingles", "digest").agg(F.min_by("bands", "doc_id").alias("bands"), F.min("doc_id").alias("rep")))
    keys = classes.select(F.col("rep").alias("id"), F.explode("bands").alias("key"))
    leads = keys.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last")
    members = put(keys.join(leads.select("key", "lead"), "key"))  # the buckets with two classes or more
    stars = members.where("id > lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    needed = members.select(F.col("id").alias("doc_id")).distinct()
    # a repeated doc_id can have several texts; the one that stands for its class is meant
    own = classes.select(F.col("rep").alias("doc_id"), "digest", F.col("n_shingles").alias("n"))
    sets = docs.join(needed, "doc_id", "left_semi").mapInArrow(_normalised, "doc_id long, digest binary, text binary")
    sets = put(sets.join(own, ["doc_id", "digest"]).groupBy("doc_id").agg(F.max_by("n", "text").alias("n"), F.max("text").alias("text")))
    links = put(_compared(stars, sets, percent, k).where("linked").select("a", "b"))
    found = put(components(links))
    # buckets that still hold several components: a second leader, then the rest
    sizes = classes.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"))
    at = put(_mixed(members.select("key", "id"), found).join(sizes, "id"))
    own = _own(sets.join(at.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"), k, salt)
    at = at.join(own, "id", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    # what has more shingles of its own than a link allows has no further link
    at = at.where(100 * (F.col("n") - F.col("u")) >= percent * F.col("n"))
    leads = at.groupBy("key").agg(F.min(F.struct((F.col("u") / F.col("n")).alias("s"), "id")).alias("l"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key", "l")
    at = put(at.join(leads, "key").select("key", "id", F.col("l.id").alias("lead")))
    pairs = at.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = put(links.unionByName(_compared(pairs, sets, percent, k).where("linked").select("a", "b")))
    found = put(components(links))
    # what still shares a bucket with another component: pairs by their rarest shingles
    rest = _mixed(at.select("key", "id"), found).select("id", "c").distinct()
    rest = put(rest.join(sizes, "id"))
    rest = _compared(_prefix_pairs(sets, rest, percent, k, salt, put), sets, percent, k).where("linked").select("a", "b")
    # a doc_id with several texts joins their classes
    shared = live.join(classes.drop("bands"), ["n_shingles", "digest"]).groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("c")).where("b < c")
    again = live.join(shared.select("doc_id"), "doc_id", "left_semi").join(classes.drop("bands"), ["n_shingles", "digest"]).select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    ends = put(components(links.unionByName(rest).unionByName(again)))
    of = classes.drop("bands").join(ends.withColumnRenamed("node", "rep"), "rep", "left").select("n_shingles", "digest", F.coalesce("component", "rep").alias("c"))
    out = signed.drop("bands").join(of, ["n_shingles", "digest"], "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id"))
    out = written(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
    dropped(spark, *scrap)
    return out


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)
