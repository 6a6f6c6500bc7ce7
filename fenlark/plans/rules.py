"""Rules on code and fixes: behaviour patterns, hints, gates that a candidate passes, trials of learned patterns, and wrappers."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..functions import code as c
from ..functions import paths as p
from . import markdown  # noqa: F401  the gates' SQL is made of that of its queries
from .base import ORACLES, query, read
from .code import ENUMS, _mode
from .errors import _has
from .samples import SNIPPETS, quoted, snippets

# Behaviour patterns of the example family, as (id, severity, issue, code, missing, required, intent words, context words, content types).
PATTERNS = [
    ("P1", "error", "wrong_output", r"\.Save\(", r"SaveFormat", None, ["src"], [], []),
    ("P2", "warning", "console", r"Console\.WriteLine\([^)]*\)", None, None, [], [], ["blog", "docs"]),
    ("P3", "critical", "no_license", None, None, r"License", ["src1", "src2"], [], []),
    ("P4", "warning", "generator", r"new Generator\(.*\);", r"using ", None, [], ["en", "de"], []),
    ("P5", "error", "kb_only", r"Document", None, None, [], [], ["kb"]),
]
_FIELDS = "id string, severity string, issue string, code string, missing string, required string, intent array<string>, context array<string>, types array<string>"


def _list(x) -> str:
    return "CAST([" + ", ".join(map(quoted, x)) + "] AS VARCHAR[])"


_RULES = "r(id, severity, issue, code, missing, required, intent, context, types) AS (VALUES " + ", ".join("(" + ", ".join("CAST(NULL AS VARCHAR)" if v is None else _list(v) if isinstance(v, list) else quoted(v) for v in row) + ")" for row in PATTERNS) + ")"
_BLOB = "lower(concat_ws(chr(10), source, lang))"
_TYPE = "CASE doc_id % 3 WHEN 0 THEN 'blog' WHEN 1 THEN 'docs' ELSE 'kb' END"
_FINDINGS = f"""{_RULES}, s AS (SELECT doc_id, source, s.code AS text, {_BLOB} AS blob, {_TYPE} AS type FROM {SNIPPETS} s WHERE s.code <> ''), x AS (SELECT s.*, r.* FROM s JOIN r ON len(types) = 0 OR list_contains(types, type)),
 fi AS (SELECT doc_id, source, id, severity, issue, CASE WHEN required IS NULL THEN substr(regexp_extract(text, concat('(?ms)', code)), 1, 120) END AS matched FROM x WHERE (required IS NOT NULL AND NOT regexp_matches(text, concat('(?ms)', required)) AND len(list_filter(intent, lambda w: contains(blob, w))) > 0)
 OR (required IS NULL AND regexp_matches(text, concat('(?ms)', code)) AND (missing IS NULL OR NOT regexp_matches(text, concat('(?ms)', missing))) AND (len(intent) = 0 OR len(list_filter(intent, lambda w: contains(blob, w))) > 0) AND (len(context) = 0 OR len(list_filter(context, lambda w: contains(blob, w))) > 0)))"""


def _findings(spark, sf_dir):
    """Snippets against the table of patterns, which is small and broadcast: a pattern's code must stand and what it
    misses must not; one with required code speaks where that is absent and the intent names the topic."""
    kind = F.when(F.col("doc_id") % 3 == 0, "blog").when(F.col("doc_id") % 3 == 1, "docs").otherwise("kb")
    s = snippets(spark, sf_dir).where("code <> ''").select("doc_id", "source", F.col("code").alias("text"), F.lower(F.concat_ws("\n", "source", "lang")).alias("blob"), kind.alias("type"))
    rules = F.broadcast(spark.createDataFrame(PATTERNS, _FIELDS))
    x = s.join(rules, (F.size("types") == 0) | F.array_contains("types", F.col("type")))
    flags = lambda k: F.concat(F.lit("(?ms)"), F.col(k))
    said = lambda k: F.exists(k, lambda w: F.contains("blob", w))
    absent = F.col("required").isNotNull() & ~F.regexp_like("text", flags("required")) & said("intent")
    present = F.col("required").isNull() & F.regexp_like("text", flags("code")) & (F.col("missing").isNull() | ~F.regexp_like("text", flags("missing"))) & ((F.size("intent") == 0) | said("intent")) & ((F.size("context") == 0) | said("context"))
    matched = F.when(F.col("required").isNull(), F.substring(F.regexp_substr("text", flags("code")), 1, 120))
    return x.where(F.coalesce(absent, F.lit(False)) | F.coalesce(present, F.lit(False))).select("doc_id", "source", "id", "severity", "issue", matched.alias("matched"))


@query(f"WITH {_FINDINGS} SELECT doc_id, id, severity, issue, matched FROM fi")
def behaviour_findings(spark, sf_dir):
    return _findings(spark, sf_dir).drop("source")


@query(f"WITH {_FINDINGS} SELECT doc_id, concat('Deterministic behavioral findings:', chr(10), string_agg(concat('- [', severity, '] ', issue, ' (', id, ')'), chr(10) ORDER BY severity, id)) AS summary FROM fi GROUP BY 1")
def behaviour_summary(spark, sf_dir):
    """A document's findings as text, by severity and id. A document has at most one finding a pattern."""
    line = F.concat(F.lit("- ["), "severity", F.lit("] "), "issue", F.lit(" ("), "id", F.lit(")"))
    g = _findings(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("severity", "id", line.alias("line")))).alias("all"))
    return g.select("doc_id", F.concat(F.lit("Deterministic behavioral findings:\n"), F.array_join(F.transform("all", lambda x: x["line"]), "\n")).alias("summary"))


@query(f"""WITH {_FINDINGS}, d AS (SELECT s.doc_id, s.source, bool_or(coalesce(fi.severity IN ('error', 'critical'), false)) AS blocking, count(fi.id) AS n, count(*) FILTER (WHERE fi.severity = 'warning') AS w FROM s LEFT JOIN fi ON fi.doc_id = s.doc_id GROUP BY 1, 2)
SELECT source, count(*) AS scanned, count(*) FILTER (WHERE n > 0) AS with_findings, count(*) FILTER (WHERE blocking) AS needs_review, CAST(sum(w) AS BIGINT) AS warnings FROM d GROUP BY 1""")
def behaviour_scan(spark, sf_dir):
    """A scan's counts by source; documents with a blocking finding need review."""
    found = _findings(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or(F.col("severity").isin("error", "critical")).alias("blocking"), F.count_if(F.col("severity") == "warning").alias("w"))
    d = snippets(spark, sf_dir).where("code <> ''").select("doc_id", "source").join(found, "doc_id", "left")
    return d.groupBy("source").agg(F.count("*").alias("scanned"), F.count("n").alias("with_findings"), F.count_if("blocking").alias("needs_review"), F.coalesce(F.sum("w"), F.lit(0)).alias("warnings"))


HINTS = [("H1", "Save(", "src"), ("H2", "", "en"), ("H3", "Generator", ""), ("H4", "nothing", "")]


@query(f"SELECT doc_id, list_sort(list(id)) AS hints FROM {SNIPPETS} JOIN (VALUES {', '.join(f'({quoted(a)}, {quoted(b)}, {quoted(w)})' for a, b, w in HINTS)}) h(id, pattern, context) ON contains(code, pattern) AND contains({_BLOB}, context) GROUP BY 1")
def hint_filter(spark, sf_dir):
    """Hints whose pattern stands in the code and whose word in the article's context; an empty one always does."""
    blob = F.lower(F.concat_ws("\n", "source", "lang"))
    hit = F.array(*(F.when(F.contains("code", F.lit(a)) & F.contains(blob, F.lit(w)), i) for i, a, w in HINTS))
    return snippets(spark, sf_dir).select("doc_id", F.filter(hit, lambda h: h.isNotNull()).alias("hints")).where(F.size("hints") > 0)


def _gates(spark, sf_dir, threshold: float):
    """What each gate says of a fix, in the row: (gate, reason, score) of the first that rejects it."""
    a, b = F.col("code"), F.col("fixed")
    sa, sb = c.signature(a, ENUMS), c.signature(b, ENUMS)
    d = snippets(spark, sf_dir).select("doc_id", "code", "fixed", sa.alias("sa"), sb.alias("sb"))
    moved = c.changes(F.col("sa"), F.col("sb"))
    critical = F.arrays_overlap(moved["kinds_changed"], F.array(F.lit("Encode"), F.lit("Decode")))
    modes = (c.mode(a) != "unknown") & (c.mode(b) != "unknown") & (c.mode(a) != c.mode(b))
    before, after = c.app_context(a), c.app_context(b)
    context = (before != after) & ~((before == "console") & after.isin("library", "aspnet_core_minimal"))
    roles = p.role_issues(p.occurrences(a), p.occurrences(b))
    names = lambda x: F.array_distinct(F.regexp_extract_all(x, F.lit(r'(?i)"([^"]+\.(?:docx|doc|pdf|xlsx|xls|pptx|ppt|odt|rtf|txt))"'), F.lit(1)))
    lost = F.array_sort(F.array_except(names(a), names(b)))
    score = moved["score"]
    rules: list[tuple[str, Column, Column, Column]] = [
        ("critical_enum", critical, F.concat(F.lit("Critical enum changed: "), F.array_join(moved["kinds_changed"], ", ")), score),
        ("family", modes, F.concat(F.lit("API mode changed: "), c.mode(a), F.lit(" -> "), c.mode(b)), F.lit(0.3)),
        ("app_context", context, F.concat(before, F.lit(" -> "), after), F.lit(None).cast("double")),
        ("path_role", F.size(roles) > 0, F.concat(F.size(roles).cast("string"), F.lit(" path roles")), F.lit(1.0)),
        ("filename", F.size(lost) > 0, F.array_join(lost, ", "), F.lit(None).cast("double")),
        ("unchanged", c.identical(a, b), F.lit("identical code"), F.lit(0.0)),
        ("drift", score > threshold, F.lit("drift threshold exceeded"), score),
    ]
    found = None
    for gate, test, reason, value in rules:
        row = F.struct(F.lit(gate).alias("gate"), reason.alias("reason"), value.cast("double").alias("score"))
        found = F.when(test, row) if found is None else found.when(test, row)
    return d.select("doc_id", found.alias("g")).select("doc_id", "g.gate", "g.reason", F.round("g.score", 6).alias("score"), F.col("g").isNull().alias("accepted"))


_SWAPPED = ORACLES["app_context"].replace(SNIPPETS, f"(SELECT doc_id, fixed AS code FROM {SNIPPETS})")


@query(f"""WITH sd AS ({ORACLES['signature_drift']}), ca AS ({ORACLES['app_context']}), cb AS ({_SWAPPED}), pr AS (SELECT doc_id, count(*) AS n FROM ({ORACLES['path_role_drift']}) GROUP BY 1), fg AS ({ORACLES['fix_guards']}), mo AS (SELECT doc_id, {_mode('code')} AS a, {_mode('fixed')} AS b FROM {SNIPPETS}),
g AS (SELECT sd.doc_id, CASE WHEN critical THEN 'critical_enum' WHEN mo.a <> 'unknown' AND mo.b <> 'unknown' AND mo.a <> mo.b THEN 'family' WHEN ca.context <> cb.context AND NOT (ca.context = 'console' AND cb.context IN ('library', 'aspnet_core_minimal')) THEN 'app_context' WHEN pr.n > 0 THEN 'path_role' WHEN len(names_lost) > 0 THEN 'filename' WHEN same THEN 'unchanged' WHEN score > 0.3 THEN 'drift' END AS gate,
 kinds_changed, mo.a AS ma, mo.b AS mb, ca.context AS xa, cb.context AS xb, pr.n AS n, names_lost, score FROM sd JOIN ca ON ca.doc_id = sd.doc_id JOIN cb ON cb.doc_id = sd.doc_id LEFT JOIN pr ON pr.doc_id = sd.doc_id JOIN fg ON fg.doc_id = sd.doc_id JOIN mo ON mo.doc_id = sd.doc_id)
SELECT doc_id, gate, CASE gate WHEN 'critical_enum' THEN concat('Critical enum changed: ', array_to_string(kinds_changed, ', ')) WHEN 'family' THEN concat('API mode changed: ', ma, ' -> ', mb) WHEN 'app_context' THEN concat(xa, ' -> ', xb) WHEN 'path_role' THEN concat(n, ' path roles') WHEN 'filename' THEN array_to_string(names_lost, ', ') WHEN 'unchanged' THEN 'identical code' WHEN 'drift' THEN 'drift threshold exceeded' END AS reason,
 CASE gate WHEN 'critical_enum' THEN score WHEN 'family' THEN 0.3 WHEN 'path_role' THEN 1.0 WHEN 'unchanged' THEN 0.0 WHEN 'drift' THEN score END::DOUBLE AS score, gate IS NULL AS accepted FROM g""")
def acceptance_gates(spark, sf_dir):
    """Each fix with the first gate that rejects it, in the chain's order."""
    return _gates(spark, sf_dir, 0.3)


@query("""
WITH t AS (SELECT user_id, event_id, event_type AS signature, 0.4 + 0.2 * (event_id % 4) AS confidence, event_id % 5 AS before, (event_id * 7) % 11 AS after FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, signature ORDER BY confidence DESC, event_id) AS rank FROM t WHERE confidence >= 0.6)
SELECT user_id, signature, event_id, CAST(rank AS INTEGER) AS rank, CASE WHEN before = 0 THEN after > 0 ELSE after > 1.5 * before AND after >= before + 2 END AS rolled_back FROM r WHERE rank <= 3""")
def pattern_trials(spark, sf_dir):
    """The three surest patterns of a signature are tried; one that makes the errors worse is taken back."""
    k = F.col("event_id")
    t = read(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("signature"), (0.4 + 0.2 * (k % 4)).alias("confidence"), (k % 5).alias("before"), ((k * 7) % 11).alias("after"))
    w = Window.partitionBy("user_id", "signature").orderBy(F.desc("confidence"), "event_id")
    r = t.where("confidence >= 0.6").withColumn("rank", F.row_number().over(w)).where("rank <= 3")
    worse = F.when(F.col("before") == 0, F.col("after") > 0).otherwise((F.col("after") > 1.5 * F.col("before")) & (F.col("after") >= F.col("before") + 2))
    return r.select("user_id", "signature", "event_id", "rank", worse.alias("rolled_back"))


_INDENT = "array_to_string(list_transform(string_split(code, chr(10)), lambda z: CASE WHEN z = '' THEN '' ELSE concat('        ', z) END), chr(10))"


@query(f"""WITH s AS (SELECT doc_id, code, CASE doc_id % 3 WHEN 0 THEN 'aspnet_core_minimal' WHEN 1 THEN 'library' ELSE 'console' END AS context FROM {SNIPPETS})
SELECT doc_id, CASE WHEN context = 'aspnet_core_minimal' AND NOT {_has('code', 'WebApplication.CreateBuilder', 'WebApplicationBuilder')} AND contains(code, 'app.') THEN concat('var builder = WebApplication.CreateBuilder(args);', chr(10), 'var app = builder.Build();', chr(10), chr(10), code, CASE WHEN contains(code, 'app.Run(') THEN '' ELSE concat(chr(10), chr(10), 'app.Run();') END)
 WHEN context = 'library' AND NOT regexp_matches(code, '\\bnamespace\\s+[\\w.]+|\\bclass\\s+\\w+') THEN concat('public class GeneratedHelper', chr(10), '{{', chr(10), '    public static void Execute()', chr(10), '    {{', chr(10), {_INDENT}, chr(10), '    }}', chr(10), '}}', chr(10)) ELSE code END AS wrapped FROM s""")
def harness_wrap(spark, sf_dir):
    """Code in what its application context needs around it."""
    x, k = F.col("code"), F.col("doc_id") % 3
    boot = F.concat(F.lit("var builder = WebApplication.CreateBuilder(args);\nvar app = builder.Build();\n\n"), x, F.when(F.contains(x, F.lit("app.Run(")), "").otherwise("\n\napp.Run();"))
    body = F.array_join(F.transform(F.split(x, "\n"), lambda z: F.when(z == "", "").otherwise(F.concat(F.lit("        "), z))), "\n")
    helper = F.concat(F.lit("public class GeneratedHelper\n{\n    public static void Execute()\n    {\n"), body, F.lit("\n    }\n}\n"))
    bare_app = ~(F.contains(x, F.lit("WebApplication.CreateBuilder")) | F.contains(x, F.lit("WebApplicationBuilder"))) & F.contains(x, F.lit("app."))
    return snippets(spark, sf_dir).select("doc_id", F.when((k == 0) & bare_app, boot).when((k == 1) & ~x.rlike(r"\bnamespace\s+[\w.]+|\bclass\s+\w+"), helper).otherwise(x).alias("wrapped"))


_USES = "regexp_extract_all(code, '(?m)^\\s*(using\\s+[\\w.]+\\s*;)', 1)"


@query(f"""WITH s AS (SELECT doc_id, code, list_transform({_USES}, lambda z: trim(z)) AS u, regexp_replace(code, '(?m)^\\s*using\\s+[\\w.]+\\s*;[^\\S\\n]*\\n?', '', 'g') AS rest, regexp_matches(code, '\\bnamespace\\s+[\\w.]+') OR (regexp_matches(code, '\\bclass\\s+\\w+') AND regexp_matches(code, '\\bstatic\\s+(?:async\\s+)?(?:void|Task|Task<int>|int)\\s+Main\\s*\\(')) AS complete FROM {SNIPPETS})
SELECT doc_id, CASE WHEN complete THEN code ELSE concat(array_to_string(list_sort(list_distinct(list_concat(['using System;'], u))), chr(10)), chr(10), 'class Program', chr(10), '{{', chr(10), '    static ', CASE WHEN regexp_matches(rest, '\\bawait\\s') THEN 'async Task' ELSE 'void' END, ' Main()', chr(10), '    {{', chr(10), rest, chr(10), '    }}', chr(10), '}}') END AS wrapped FROM s""")
def code_wrap(spark, sf_dir):
    """Statements in a class with a Main method, their using lines hoisted, sorted and each once; whole programs stay."""
    x = F.col("code")
    flags = c.structure(x)
    uses = F.transform(F.regexp_extract_all(x, F.lit(r"(?m)^\s*(using\s+[\w.]+\s*;)"), F.lit(1)), lambda z: F.trim(z))
    rest = F.regexp_replace(x, r"(?m)^\s*using\s+[\w.]+\s*;[^\S\n]*\n?", "")
    head = F.array_join(F.array_sort(F.array_distinct(F.concat(F.array(F.lit("using System;")), uses))), "\n")
    kind = F.when(rest.rlike(r"\bawait\s"), "async Task").otherwise("void")
    whole = F.concat(head, F.lit("\nclass Program\n{\n    static "), kind, F.lit(" Main()\n    {\n"), rest, F.lit("\n    }\n}"))
    return snippets(spark, sf_dir).select("doc_id", F.when(flags["is_complete"], x).otherwise(whole).alias("wrapped"))
