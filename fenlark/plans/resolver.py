"""Finding test files: what an example needs, where it is, and by which tier it was found.

Tables stand in for folders: suppliers are the files at hand (their number names them), customers what is asked for.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths as p
from .base import query, read
from .markdown import _role

_EXT = "['docx', 'PDF', 'zip', 'txt']"
_STEM = "['Report', 'sample', 'Output', 'data', 'skip_me', 'Template']"


def _name(key: str, case: str = "") -> str:
    return f"concat(({_STEM})[CAST({key} % 6 AS INTEGER) + 1], '_', {key}, '.', {case}(({_EXT})[CAST({key} % 4 AS INTEGER) + 1]))"


_HAVE = f"(SELECT s_suppkey AS id, {_name('s_suppkey')} AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'repo' ELSE 'data' END AS place FROM supplier WHERE s_suppkey % 3 <> 2)"
_WANT = f"(SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN upper({_name('c_custkey')}) WHEN c_custkey % 4 = 1 THEN concat('alias_', c_custkey, '.', lower(({_EXT})[CAST(c_custkey % 4 AS INTEGER) + 1])) ELSE {_name('c_custkey')} END AS name FROM customer)"


def _spark_name(key):
    pick = lambda words: F.element_at(F.array(*(F.lit(w) for w in words)), (key % len(words) + 1).cast("int"))
    return F.concat(pick(["Report", "sample", "Output", "data", "skip_me", "Template"]), F.lit("_"), key.cast("string"), F.lit("."), pick(["docx", "PDF", "zip", "txt"]))


def _have(spark, sf_dir):
    k = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").where(k % 3 != 2).select(k.alias("id"), _spark_name(k).alias("name"), F.when(k % 5 == 0, "repo").otherwise("data").alias("place"))


def _want(spark, sf_dir):
    k = F.col("c_custkey")
    ext = F.lower(F.element_at(F.array(*(F.lit(w) for w in ("docx", "PDF", "zip", "txt"))), (k % 4 + 1).cast("int")))
    name = F.when(k % 4 == 0, F.upper(_spark_name(k))).when(k % 4 == 1, F.concat(F.lit("alias_"), k.cast("string"), F.lit("."), ext)).otherwise(_spark_name(k))
    return read(spark, sf_dir, "customer").select(k.alias("id"), name.alias("name"))


_TIERS = f"""w AS {_WANT}, h AS {_HAVE}, wr AS (SELECT id, name, {_role('name')} AS role FROM w), al AS (SELECT id AS aid, concat('alias_', id, '.', lower(string_split(name, '.')[-1])) AS alias, name AS canonical, {_role('name')} AS crole FROM h),
 e AS (SELECT string_split(lower(name), '.')[-1] AS ext, min(name) AS first FROM h WHERE place = 'data' GROUP BY 1),
 j AS (SELECT wr.id, wr.name, wr.role, d.name AS exact, coalesce(x.name, ci.name) AS loose, al.canonical AS alias, e.first AS same_ext FROM wr LEFT JOIN h d ON d.name = wr.name AND d.place = 'data' LEFT JOIN h x ON x.name = wr.name AND x.place = 'repo'
 LEFT JOIN h ci ON lower(ci.name) = lower(wr.name) AND ci.name <> wr.name LEFT JOIN al ON lower(al.alias) = lower(wr.name) AND (al.crole = 'output') = (wr.role = 'output') LEFT JOIN e ON e.ext = string_split(lower(wr.name), '.')[-1])"""


@query(f"""WITH {_TIERS} SELECT id, name, CASE WHEN role = 'output' OR lower(name) LIKE 'skip%' THEN NULL ELSE coalesce(exact, loose, alias, same_ext) END AS found,
 CASE WHEN role = 'output' OR lower(name) LIKE 'skip%' THEN 'skipped' WHEN exact IS NOT NULL THEN 'existing' WHEN loose IS NOT NULL THEN 'example_repo' WHEN alias IS NOT NULL THEN 'reverse_alias' WHEN same_ext IS NOT NULL THEN 'extension_match' ELSE 'generate' END AS method FROM j""")
def resolver_cascade(spark, sf_dir):
    """Each wanted file by the first tier that has it. Every tier is one equi-join; outputs and skipped names are left alone."""
    w = _want(spark, sf_dir).withColumn("role", p.role(F.col("name")))
    h = _have(spark, sf_dir)
    ext = lambda x: F.element_at(F.split(F.lower(x), r"\."), -1)
    exact = h.where("place = 'data'").select("name", F.col("name").alias("exact"))
    repo = h.where("place = 'repo'").select("name", F.col("name").alias("repo"))
    loose = h.select(F.lower("name").alias("low"), F.col("name").alias("loose"))
    alias = h.select(F.lower(F.concat(F.lit("alias_"), F.col("id").cast("string"), F.lit("."), ext(F.col("name")))).alias("low"), F.col("name").alias("alias"), (p.role(F.col("name")) == "output").alias("out"))
    first = h.where("place = 'data'").groupBy(ext(F.col("name")).alias("ext")).agg(F.min("name").alias("same_ext"))
    j = w.withColumn("low", F.lower("name")).withColumn("out", F.col("role") == "output").withColumn("ext", ext(F.col("name")))
    j = j.join(exact, "name", "left").join(repo, "name", "left").join(loose, "low", "left").withColumn("loose", F.when(F.col("loose") != F.col("name"), F.col("loose"))).join(alias, ["low", "out"], "left").join(first, "ext", "left")
    skip = (F.col("role") == "output") | F.col("low").startswith("skip")
    method = F.when(skip, "skipped")
    for column, tier in (("exact", "existing"), (F.coalesce("repo", "loose"), "example_repo"), ("alias", "reverse_alias"), ("same_ext", "extension_match")):
        method = method.when((F.col(column) if isinstance(column, str) else column).isNotNull(), tier)
    return j.select("id", "name", F.when(~skip, F.coalesce("exact", "repo", "loose", "alias", "same_ext")).alias("found"), method.otherwise("generate").alias("method"))


@query(f"WITH {_TIERS} SELECT id, name FROM j WHERE role <> 'output' AND exact IS NULL AND loose IS NULL AND alias IS NULL")
def missing_test_data(spark, sf_dir):
    """Wanted files that no exact, loose or alias look-up finds; outputs aren't wanted."""
    found = resolver_cascade(spark, sf_dir).where("method in ('existing', 'example_repo', 'reverse_alias')").select("id")
    h = _have(spark, sf_dir)
    w = _want(spark, sf_dir).where(p.role(F.col("name")) != "output")
    skipped = w.where(F.lower("name").startswith("skip")).join(h.select(F.lower("name").alias("low")), F.lower("name") == F.col("low"), "left_semi").select("id")
    return w.join(found.unionByName(skipped), "id", "left_anti").select("id", "name")


@query(f"""WITH h AS {_HAVE}, a AS (SELECT id, name AS canonical, {_role('name')} AS crole, unnest([concat('copy_', name), concat('output_', id, '.docx'), concat('template-', id, '.docx')]) AS alias FROM h), r AS (SELECT *, {_role('alias')} AS arole FROM a)
SELECT id, canonical, alias, (crole = 'output') = (arole = 'output') AS kept, CASE WHEN (crole = 'output') <> (arole = 'output') THEN concat('dropped unsafe alias ''', alias, ''' (', arole, ') for ''', canonical, ''' (', crole, ')') END AS warning FROM r""")
def alias_sanitising(spark, sf_dir):
    """Aliases that would turn a source into an output, or the other way round, are dropped with a warning."""
    k = F.col("id").cast("string")
    a = _have(spark, sf_dir).select("id", F.col("name").alias("canonical"), F.explode(F.array(F.concat(F.lit("copy_"), "name"), F.concat(F.lit("output_"), k, F.lit(".docx")), F.concat(F.lit("template-"), k, F.lit(".docx")))).alias("alias"))
    a = a.withColumn("crole", p.role(F.col("canonical"))).withColumn("arole", p.role(F.col("alias")))
    bad = p.crosses(F.col("crole"), F.col("arole"))
    text = F.concat(F.lit("dropped unsafe alias '"), "alias", F.lit("' ("), "arole", F.lit(") for '"), "canonical", F.lit("' ("), "crole", F.lit(")"))
    return a.select("id", "canonical", "alias", (~bad).alias("kept"), F.when(bad, text).alias("warning"))


@query(f"""WITH w AS {_WANT}, h AS {_HAVE}, n AS (SELECT id, name, CASE WHEN id % 2 = 0 THEN 'v2' ELSE 'v1' END AS version FROM w WHERE id % 3 = 0)
SELECT w.id, w.name, coalesce(n.version = 'v2', false) AND h.name IS NULL AS skip FROM w LEFT JOIN n ON n.id = w.id LEFT JOIN h ON h.name = w.name""")
def negative_cache(spark, sf_dir):
    """A file known to be unresolvable is skipped, unless it is there by now or the generator's version has changed."""
    w = _want(spark, sf_dir)
    n = w.where("id % 3 = 0").select("id", F.when(F.col("id") % 2 == 0, "v2").otherwise("v1").alias("version"))
    there = _have(spark, sf_dir).select("name").withColumn("there", F.lit(True))
    return w.join(n, "id", "left").join(there, "name", "left").select("id", "name", (F.coalesce(F.col("version") == "v2", F.lit(False)) & F.col("there").isNull()).alias("skip"))


@query(f"""WITH w AS {_WANT}, h AS {_HAVE}, x AS (SELECT DISTINCT lower(string_split(name, '.')[-1]) AS ext FROM h)
SELECT id, w.name, CASE WHEN contains(w.name, '*') THEN 'glob' WHEN h.name IS NOT NULL THEN 'name' WHEN x.ext IS NOT NULL THEN 'extension' ELSE 'none' END AS resolvable FROM w LEFT JOIN (SELECT DISTINCT name FROM h) h ON h.name = w.name LEFT JOIN x ON x.ext = lower(string_split(w.name, '.')[-1])""")
def repo_membership(spark, sf_dir):
    """Whether the repository has a wanted file's name, or at least its extension."""
    h = _have(spark, sf_dir)
    ext = F.element_at(F.split(F.lower("name"), r"\."), -1)
    names, kinds = h.select("name").distinct().withColumn("n", F.lit(True)), h.select(ext.alias("ext")).distinct().withColumn("x", F.lit(True))
    j = _want(spark, sf_dir).withColumn("ext", ext).join(names, "name", "left").join(kinds, "ext", "left")
    return j.select("id", "name", F.when(F.contains("name", F.lit("*")), "glob").when(F.col("n"), "name").when(F.col("x"), "extension").otherwise("none").alias("resolvable"))


@query(f"SELECT place, list_sort(list(name)) AS outputs FROM {_HAVE} WHERE regexp_matches(name, '^[^_]*_[0-9]*0\\.(docx|zip)$') GROUP BY 1")
def output_match(spark, sf_dir):
    """Files that match a glob (*_*0.docx, *_*0.zip), sorted. Only the matching ones are gathered."""
    return _have(spark, sf_dir).where(F.col("name").rlike(r"^[^_]*_[0-9]*0\.(docx|zip)$")).groupBy("place").agg(F.sort_array(F.collect_list("name")).alias("outputs"))
