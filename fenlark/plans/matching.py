"""Texts against texts and rules: patches that are made and applied, and many rules told apart by their literals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diff, rules
from .base import query, read

_EDITED = "array_to_string(list_concat(list_filter(string_split(text, chr(10)), lambda z: length(z) % 7 <> 0), ['end of ' || doc_id]), chr(10))"
_PAIRS = f"(SELECT a.doc_id, 'next' AS kind, coalesce(a.text, '') AS text, coalesce(b.text, '') AS other FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 UNION ALL SELECT doc_id, 'edited', text, {_EDITED} FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))"


def _patches(spark, sf_dir):
    """(doc_id, kind, text, other, patch): each document and the next one, and each one and an edited version."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    after = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("other"))
    kept = F.filter(F.split("text", "\n"), lambda z: F.length(z) % 7 != 0)
    edited = F.array_join(F.concat(kept, F.array(F.concat(F.lit("end of "), F.col("doc_id").cast("string")))), "\n")
    pairs = d.join(after, "doc_id").select("doc_id", F.lit("next").alias("kind"), "text", "other").unionByName(d.select("doc_id", F.lit("edited").alias("kind"), "text", edited.alias("other")))
    return pairs.withColumn("patch", diff.unified_diff(F.col("text"), F.col("other")))


@query(f"""SELECT doc_id, kind, sha256(other) AS patched, CAST(len(string_split(other, chr(10))) - len(string_split(text, chr(10))) AS BIGINT) AS net, text = other AS same FROM {_PAIRS}""")
def document_patches(spark, sf_dir):
    """A patch a pair of texts, applied: what comes out is the other text; lines added less lines removed are the difference in lines."""
    p = _patches(spark, sf_dir)
    net = (F.size(diff.added(F.col("patch"))) - F.size(diff.removed(F.col("patch")))).cast("long")
    return p.select("doc_id", "kind", F.sha2(diff.apply_patch(F.col("text"), F.col("patch")), 256).alias("patched"), F.when(F.col("patch") == "", 0).otherwise(net).alias("net"), (F.col("patch") == "").alias("same"))


_WORDS = "regexp_extract_all(text, '[A-Za-z]{4,}')"
_RULES = f"""r AS (SELECT item_id, unnest([
 {{'id': concat(item_id, 'a'), 'severity': 'error', 'issue': 'leak', 'code': concat(w[2], '[ \\n]+', w[3]), 'missing': NULL, 'required': NULL, 'intent': CAST([] AS VARCHAR[]), 'context': CAST([] AS VARCHAR[]), 'types': CAST([] AS VARCHAR[])}},
 {{'id': concat(item_id, 'b'), 'severity': 'warning', 'issue': 'mention', 'code': concat('(?:', w[4], ')[^.]{{0,40}}', w[5]), 'missing': concat(w[1], '[ \\n]+', w[2]), 'required': NULL, 'intent': CAST([] AS VARCHAR[]), 'context': ['en', 'de'], 'types': CAST([] AS VARCHAR[])}},
 {{'id': concat(item_id, 'c'), 'severity': 'info', 'issue': 'absent', 'code': NULL, 'missing': NULL, 'required': w[1], 'intent': [concat('src', item_id % 20, chr(10))], 'context': CAST([] AS VARCHAR[]), 'types': ['kb']}}]) AS q FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) >= 5)"""


@query(f"""WITH {_RULES}, d AS (SELECT doc_id, coalesce(text, '') AS text, lower(concat_ws(chr(10), source, lang)) AS blob, CASE doc_id % 3 WHEN 0 THEN 'blog' WHEN 1 THEN 'docs' ELSE 'kb' END AS type FROM documents),
x AS (SELECT d.*, r.* FROM d JOIN (SELECT unnest(q) FROM r) r ON len(types) = 0 OR list_contains(types, type))
SELECT doc_id, id AS rule, severity, issue, CASE WHEN required IS NULL THEN substr(regexp_extract(text, concat('(?ms)', code)), 1, 120) END AS matched FROM x WHERE
 (required IS NOT NULL AND NOT regexp_matches(text, concat('(?ms)', required)) AND len(list_filter(intent, lambda w: contains(blob, w))) > 0)
 OR (required IS NULL AND regexp_matches(text, concat('(?ms)', code)) AND (missing IS NULL OR NOT regexp_matches(text, concat('(?ms)', missing))) AND (len(context) = 0 OR len(list_filter(context, lambda w: contains(blob, w))) > 0))""")
def rule_findings(spark, sf_dir):
    """Documents against three rules an item of the benchmark; only rules whose literals occur in a document are tried there."""
    w = F.regexp_extract_all("text", F.lit("[A-Za-z]{4,}"), F.lit(0))
    b = read(spark, sf_dir, "benchmark").select("item_id", w.alias("w")).where("size(w) >= 5")
    i, none, word = F.col("item_id").cast("string"), F.lit(None).cast("string"), lambda k: F.get("w", F.lit(k - 1))
    words = lambda *x: F.array(*x).cast("array<string>")
    rule = lambda tail, severity, issue, code, missing, required, intent, context, types: F.struct(F.concat(i, F.lit(tail)).alias("id"), F.lit(severity).alias("severity"), F.lit(issue).alias("issue"), code.alias("code"), missing.alias("missing"), required.alias("required"), intent.alias("intent"), context.alias("context"), types.alias("types"))
    table = b.select(F.inline(F.array(
        rule("a", "error", "leak", F.concat(word(2), F.lit("[ \\n]+"), word(3)), none, none, words(), words(), words()),
        rule("b", "warning", "mention", F.concat(F.lit("(?:"), word(4), F.lit(")[^.]{0,40}"), word(5)), F.concat(word(1), F.lit("[ \\n]+"), word(2)), none, words(), words(F.lit("en"), F.lit("de")), words()),
        rule("c", "info", "absent", none, none, word(1), words(F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string"), F.lit("\n"))), words(), words(F.lit("kb"))),
    )))
    kind = F.when(F.col("doc_id") % 3 == 0, "blog").when(F.col("doc_id") % 3 == 1, "docs").otherwise("kb")
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.lower(F.concat_ws("\n", "source", "lang")).alias("blob"), kind.alias("type"))
    return rules.findings(d, table).select(F.col("id").alias("doc_id"), "rule", "severity", "issue", "matched")
