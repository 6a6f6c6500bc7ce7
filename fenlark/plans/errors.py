"""Errors of builds and runs: what they are, how risky and how hard, and where they go next."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import errors as e
from .base import query
from .samples import FAILURES, failures, quoted


def _case(pairs, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in pairs) + f" ELSE {otherwise} END"


def _match(x: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({x}, {quoted('(?' + flags + '-s)' + pattern)})"


def _any(x: str, patterns: list[str], flags: str = "") -> str:
    return "(" + " OR ".join(_match(x, p, flags) for p in patterns) + ")"


def _has(x: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains({x}, {quoted(w)})" for w in words) + ")"


def _category(x: str) -> str:
    return _case([(_match(x, p, "i"), quoted(c)) for c, p in e.CATEGORIES], "'unknown'")


_TEXT = "array_to_string(errors, chr(10))"
_SPACED = "array_to_string(errors, ' ')"


@query(f"""SELECT event_id, list_transform(list_filter(string_split(o, chr(10)), lambda z: contains(z, ': error ') OR contains(z, 'error CS')), lambda z: trim(z)) AS errors,
 list_transform(list_filter(string_split(o, chr(10)), lambda z: contains(z, ': warning ') OR contains(z, 'warning CS')), lambda z: trim(z)) AS warnings FROM (SELECT event_id, {_TEXT} AS o FROM {FAILURES})""")
def diagnostics_split(spark, sf_dir):
    """Error and warning lines of a build's output."""
    o = e.joined(F.col("errors"))
    return failures(spark, sf_dir).select("event_id", e.diagnostics(o, "error").alias("errors"), e.diagnostics(o, "warning").alias("warnings"))


@query(f"SELECT event_id, message, {_category('message')} AS category FROM {FAILURES}")
def error_categories(spark, sf_dir):
    return failures(spark, sf_dir).select("event_id", "message", e.category(F.col("message")).alias("category"))


NAMESPACES = {"Archive": "Acme.Zip", "Chart": "Acme.Charts", "report": "Acme.Reports"}


@query(f"""
WITH c AS (SELECT event_id, list_transform(errors, lambda z: {_category('z')}) AS k, list_transform(errors, lambda z: regexp_extract(z, 'type.*''(\\w+)''', 1)) AS t FROM {FAILURES}),
n AS (SELECT event_id, k, list_sort(list_distinct(list_filter(list_transform(range(1, len(k) + 1), lambda i: CASE WHEN k[i] = 'missing_type' THEN {_case([(f"t[i] = {quoted(a)}", quoted(b)) for a, b in NAMESPACES.items()], 'NULL')} END), lambda z: z IS NOT NULL))) AS ns FROM c)
SELECT event_id, list_filter([CASE WHEN len(ns) > 0 THEN concat('Add using statements: ', array_to_string(ns, ', ')) END, {', '.join(f"CASE WHEN list_contains(k, {quoted(c)}) THEN {quoted(h)} END" for c, h in e.HINTS)}], lambda z: z IS NOT NULL) AS hints FROM n""")
def fix_hints(spark, sf_dir):
    return failures(spark, sf_dir).select("event_id", e.hints(F.col("errors"), NAMESPACES).alias("hints"))


def _risk(x: str, low: list[str]) -> str:
    return _case([(f"{x} = ''", "'medium'"), (_any(x, e.CRITICAL, "i"), "'critical'"), (_any(x, e.HIGH, "i"), "'high'"), (_any(x, low, "i"), "'low'")], "'medium'")


_BUDGET = "CASE {0} WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'low' THEN 5 ELSE 3 END"


def _routing(low: list[str], text: str, kind: str) -> str:
    return f"""
WITH r AS (SELECT event_id, attempt, {_risk(text, low)} AS risk FROM {FAILURES}), b AS (SELECT *, {_BUDGET.format('risk')} AS most FROM r)
SELECT event_id, risk, most AS max_retries, NOT (risk = 'critical' OR attempt > most) AS retry,
 CASE WHEN risk = 'critical' THEN concat('CRITICAL risk {kind} error detected at attempt ', attempt) WHEN attempt > most THEN concat(risk, ' risk error exceeded max retries (', most, ') at attempt ', attempt) END AS reason FROM b"""


def _routed(spark, sf_dir, low, text, kind):
    level = e.risk(text, low)
    f = failures(spark, sf_dir).withColumn("risk", level)
    retry, reason = e.routed(F.col("risk"), F.col("attempt"), kind)
    return f.select("event_id", "risk", e.budget(F.col("risk")).alias("max_retries"), retry.alias("retry"), reason.alias("reason"))


@query(_routing(e.LOW, _TEXT, "compilation"))
def route_compilation(spark, sf_dir):
    """Risk of a build's errors, the attempts it allows, and whether another one follows."""
    return _routed(spark, sf_dir, e.LOW, e.joined(F.col("errors")), "compilation")


@query(_routing(e.LOW_RUNTIME, "message", "runtime"))
def route_runtime(spark, sf_dir):
    return _routed(spark, sf_dir, e.LOW_RUNTIME, F.col("message"), "runtime")


@query(f"SELECT {_category('message')} AS category, {_risk('message', e.LOW)} AS risk, count(*) AS n FROM {FAILURES} GROUP BY 1, 2")
def risk_class(spark, sf_dir):
    m = F.col("message")
    return failures(spark, sf_dir).groupBy(e.category(m).alias("category"), e.risk(m, e.LOW).alias("risk")).agg(F.count("*").alias("n"))


_CODE = "coalesce(nullif(regexp_extract(message, '(CS\\d{4})', 1), ''), nullif(regexp_extract(message, '(\\w+Exception)', 1), ''), 'none')"
_KIND = _case([(f"code = {quoted(k)}", quoted(v)) for k, v in e.CODE_CATEGORY] + [(f"{_has('code', *e.EXCEPTION_WORDS)} AND {_has('upper(code)', 'EXCEPTION', 'ERROR')}", _case([(_has("code", "NullReferenceException", "ArgumentNullException"), "'null_reference'"), (_has("code", "FileNotFoundException", "DirectoryNotFoundException", "IOException"), "'io_exception'")], "'runtime_exception'"))], "'unknown'")
_DOMAIN = f"({_any('message', e.DOMAIN, 'i')} OR {_has('message', 'ArchiveEntry', 'RarArchiveLoadOptions', 'SevenZipArchiveLoadOptions')})"
_CRYPTIC = f"(length(message) > 200 OR contains(message, chr(10)) OR {_any('message', e.CRYPTIC)})"


@query(f"""
WITH c AS (SELECT *, {_CODE} AS code FROM {FAILURES}), k AS (SELECT *, {_KIND} AS category, {_DOMAIN} AS domain, {_CRYPTIC} AS cryptic FROM c),
s AS (SELECT *, CASE category {' '.join(f"WHEN {quoted(k)} THEN CAST({v} AS DOUBLE)" for k, v in e.BASE_SCORE)} END AS base FROM k),
t AS (SELECT *, least(1.0, greatest(0.0, base + CAST(0.1 AS DOUBLE) * least(retries, 2) + CASE WHEN len(errors) > 1 THEN least(CAST(0.15 AS DOUBLE), CAST(0.05 AS DOUBLE) * (len(errors) - 1)) ELSE 0 END
 + (CASE WHEN domain THEN CAST(0.1 AS DOUBLE) ELSE 0 END + CASE WHEN cryptic THEN CAST(0.08 AS DOUBLE) ELSE 0 END + CASE WHEN attempt > 2 THEN CAST(0.05 AS DOUBLE) ELSE 0 END))) AS score FROM s)
SELECT event_id, code, category, domain, cryptic, round(score, 3) AS score, CASE WHEN score < 0.4 THEN 'simple' WHEN score < 0.7 THEN 'medium' ELSE 'complex' END AS level,
 CASE WHEN score < 0.4 THEN 'small' WHEN score < 0.7 THEN 'medium' ELSE 'large' END AS tier FROM t""")
def error_complexity(spark, sf_dir):
    """Score, level and model tier of an error, with what the score rests on; the attempt stands for the length of the history."""
    m = F.col("message")
    code = F.coalesce(F.nullif(F.regexp_extract(m, r"(CS\d{4})", 1), F.lit("")), F.nullif(F.regexp_extract(m, r"(\w+Exception)", 1), F.lit("")), F.lit("none"))
    f = failures(spark, sf_dir).withColumn("code", code)
    c, score = F.col("code"), e.complexity(F.col("code"), m, F.col("retries"), F.size("errors"), F.col("attempt"))
    return f.select("event_id", "code", e.code_category(c).alias("category"), e.domain(m).alias("domain"), e.cryptic(m).alias("cryptic"), F.round(score, 3).alias("score"), e.tier(score, ("simple", "medium", "complex")).alias("level"), e.tier(score).alias("tier"))


@query(f"""
WITH s AS (SELECT base + 0.1::DOUBLE * least(retries, 2) AS s FROM (SELECT retries, CASE {_KIND} {' '.join(f"WHEN {quoted(k)} THEN {v}::DOUBLE" for k, v in e.BASE_SCORE)} END AS base FROM (SELECT *, {_CODE} AS code FROM {FAILURES})))
SELECT CASE WHEN s < 0.4 THEN 'small' WHEN s < 0.7 THEN 'medium' ELSE 'large' END AS tier, count(*) AS n FROM s GROUP BY 1""")
def tier_histogram(spark, sf_dir):
    m = F.col("message")
    code = F.coalesce(F.nullif(F.regexp_extract(m, r"(CS\d{4})", 1), F.lit("")), F.nullif(F.regexp_extract(m, r"(\w+Exception)", 1), F.lit("")), F.lit("none"))
    f = failures(spark, sf_dir).select("retries", code.alias("code"))
    scored = f.select((e.base_score(F.col("code")) + 0.1 * F.least("retries", F.lit(2))).alias("score"))
    return scored.groupBy(e.tier(F.col("score")).alias("tier")).agg(F.count("*").alias("n"))


_LOW = f"lower({_SPACED})"
_FILE = f"regexp_extract({_SPACED}, '''([^'']+\\.\\w+)''', 1)"
_CODES = "list_filter(list_transform(errors, lambda z: regexp_extract(z, '(CS\\d{4})', 1)), lambda z: z <> '')"
_MISSING = f"{_has(_LOW, 'file')} AND {_has(_LOW, 'not found', 'missing')}"


@query(f"""
WITH x AS (SELECT *, regexp_extract({_SPACED}, '\\b(\\w+Exception):', 1) AS name, {_FILE} AS file FROM {FAILURES})
SELECT event_id, CASE WHEN len({_CODES}) > 0 THEN ({_CODES})[1] WHEN name = 'FileNotFoundException' AND file <> '' THEN concat('MISSING_FILE:', file) WHEN name <> '' THEN name
 WHEN {_has(_LOW, 'password')} THEN 'PASSWORD_ISSUE' WHEN {_MISSING} THEN 'MISSING_FILE' WHEN {_has(_LOW, 'directory')} AND {_has(_LOW, 'not found')} THEN 'MISSING_DIRECTORY' WHEN {_has(_LOW, 'disposed')} THEN 'DISPOSED_STREAM' ELSE 'RUNTIME_ERROR' END AS signature FROM x""")
def error_signature(spark, sf_dir):
    return failures(spark, sf_dir).select("event_id", e.signature(F.col("errors")).alias("signature"))


@query(f"""
WITH x AS (SELECT *, list_transform(regexp_extract_all({_SPACED}, '\\b(\\w+Exception):', 1), lambda n: CASE WHEN n = 'FileNotFoundException' AND {_FILE} <> '' THEN concat('MISSING_FILE:', {_FILE}) ELSE n END) AS names FROM {FAILURES}),
y AS (SELECT event_id, list_concat({_CODES}, names, list_filter([CASE WHEN {_has(_LOW, 'password')} THEN 'PASSWORD_ISSUE' END, CASE WHEN {_MISSING} THEN 'MISSING_FILE' END], lambda z: z IS NOT NULL)) AS s FROM x)
SELECT event_id, CASE WHEN len(s) = 0 THEN ['RUNTIME_ERROR'] ELSE list_filter(s, lambda z, i: list_position(s, z) = i) END AS signatures FROM y""")
def error_signatures_all(spark, sf_dir):
    return failures(spark, sf_dir).select("event_id", e.signatures(F.col("errors")).alias("signatures"))


@query(f"""
WITH s AS (SELECT event_id, {_case([(f"len({_CODES}) > 0", f"({_CODES})[1]"), (_has(_LOW, 'timeout', 'timed out'), "'TIMEOUT'"), (_has(_LOW, 'password'), "'PASSWORD_ISSUE'"), (_has(_LOW, 'could not find file', 'filenotfound'), "'MISSING_FILE'")], "'OTHER_' || upper(event_type)")} AS signature FROM {FAILURES})
SELECT signature, count(*) AS n, CASE WHEN signature LIKE 'CS%' THEN CASE WHEN count(*) >= 3 THEN 0.8 ELSE 0.5 END WHEN signature LIKE 'OTHER%' THEN 0.2 ELSE 0.3 END AS confidence, list_sort(list(event_id))[1:10] AS ids FROM s GROUP BY 1""")
def cluster_mine(spark, sf_dir):
    """Failures by signature, a proposal's confidence and its first ten ids, which come from a ranked top-k and not from gathering the cluster."""
    from ..operators import tabular as t

    text = F.lower(e.joined(F.col("errors"), " "))
    code = F.get(F.filter(F.transform("errors", lambda z: F.regexp_extract(z, r"(CS[0-9]{4})", 1)), lambda c: c != ""), F.lit(0))
    rest = F.when(e.has(text, "timeout", "timed out"), "TIMEOUT").when(e.has(text, "password"), "PASSWORD_ISSUE").when(e.has(text, "could not find file", "filenotfound"), "MISSING_FILE").otherwise(F.concat(F.lit("OTHER_"), F.upper("event_type")))
    s = failures(spark, sf_dir).select("event_id", F.coalesce(code, rest).alias("signature"))
    n = s.groupBy("signature").agg(F.count("*").alias("n"))
    ids = t.newest(s, ["signature"], [F.col("event_id")], 10).groupBy("signature").agg(F.array_sort(F.collect_list("event_id")).alias("ids"))
    sure = F.when(F.col("signature").startswith("CS"), F.when(F.col("n") >= 3, 0.8).otherwise(0.5)).when(F.col("signature").startswith("OTHER"), 0.2).otherwise(0.3)
    return n.join(ids, "signature").select("signature", "n", sure.alias("confidence"), "ids")


_P1, _P2 = "'(?s)Unhandled exception[.:]\\s*([A-Za-z.]+Exception):\\s*(.+?)(?:\\n\\s+at\\s|\\z)'", "'(?s)([A-Za-z.]+Exception):\\s*(.+?)(?:\\n\\s+at\\s|\\z)'"


@query(f"""
WITH x AS (SELECT event_id, message AS m, regexp_matches(message, {_P1}) AS u FROM {FAILURES}),
y AS (SELECT *, nullif(CASE WHEN u THEN regexp_extract(m, {_P1}, 1) ELSE regexp_extract(m, {_P2}, 1) END, '') AS exception, trim(CASE WHEN u THEN regexp_extract(m, {_P1}, 2) ELSE regexp_extract(m, {_P2}, 2) END) AS detail FROM x)
SELECT event_id, exception, CASE WHEN exception IS NOT NULL THEN detail END AS detail, CASE WHEN exception IS NOT NULL THEN trim(array_to_string(string_split(nullif(regexp_extract(m, '(?s)(\\n\\s+at\\s.+)', 1), ''), chr(10))[1:5], chr(10)), concat(' ', chr(10))) END AS stack FROM y""")
def exception_parse(spark, sf_dir):
    kind, message, stack = e.exception(F.col("message"))
    return failures(spark, sf_dir).select("event_id", kind.alias("exception"), message.alias("detail"), stack.alias("stack"))


@query(f"""
SELECT event_id, CASE WHEN {_has('m', 'filenotfound', 'could not find file')} THEN CASE WHEN contains(m, '.rar') THEN 'missing_rar_file' ELSE 'missing_file' END {' '.join(f"WHEN {_has('m', *w)} THEN {quoted(k)}" for k, w in e.RUNTIME)} ELSE 'unhandled_exception' END AS class
FROM (SELECT event_id, lower(message) AS m FROM {FAILURES})""")
def runtime_error_class(spark, sf_dir):
    return failures(spark, sf_dir).select("event_id", e.runtime_class(F.col("message")).alias("class"))


@query(f"""SELECT event_id, starts_with(message, 'Build failed:') OR {_has('message', 'Restore failed:', 'error CS', 'error MSB')} AS build_failure, {_any(_TEXT, e.API_MISMATCH, 'i')} AS api_mismatch,
 CASE WHEN attempt = 0 THEN 'tier1_minimal' WHEN attempt = 1 THEN 'tier2_with_examples' ELSE 'tier3_expanded' END AS enrichment FROM {FAILURES}""")
def failure_tests(spark, sf_dir):
    """Whether a failure is the build's, whether the interface doesn't fit, and how much context the next attempt gets."""
    return failures(spark, sf_dir).select("event_id", e.build_failure(F.col("message")).alias("build_failure"), e.api_mismatch(e.joined(F.col("errors"))).alias("api_mismatch"), e.enrichment(F.col("attempt")).alias("enrichment"))


def _base(pattern: str) -> str:
    return f"nullif(string_split(regexp_replace(replace(regexp_extract(message, {quoted(pattern)}, 1), chr(92), '/'), '/+$', ''), '/')[-1], '')"


_NAME = "coalesce(" + ", ".join(map(_base, ["(?i)Could not find file '([^']+)'", '(?i)Could not find file "([^"]+)"', "(?i)FileNotFoundException[^'\"]*['\"]([^'\"]+)['\"]"])) + ")"
_DIR = "coalesce(" + ", ".join(map(_base, ["(?i)Could not find a part of the path '([^']+)'", '(?i)Could not find a part of the path "([^"]+)"', "(?i)DirectoryNotFoundException[^'\"]*['\"]([^'\"]+)['\"]"])) + ")"


@query(f"SELECT event_id, file, CASE WHEN NOT contains(folder, '.') THEN folder END AS folder FROM (SELECT event_id, {_NAME} AS file, {_DIR} AS folder FROM {FAILURES})")
def missing_names(spark, sf_dir):
    """File and folder that a run-time error names, without their paths; a folder's name has no dot."""
    return failures(spark, sf_dir).select("event_id", e.missing_file(F.col("message")).alias("file"), e.missing_directory(F.col("message")).alias("folder"))


def _hint(test: str, *lines: str) -> str:
    return f"CASE WHEN {test} THEN {quoted(chr(10).join('- ' + x for x in lines))} END"


@query(f"""SELECT event_id, nullif(concat_ws(chr(10), {_hint(_has(_TEXT, 'CS0246', 'could not be found'), "Add missing 'using' statements for the namespace containing the missing type.")},
 {_hint(_has(_TEXT, 'CS8803', 'Top-level statements'), "Wrap all code in 'class Program { static void Main() { ... } }' structure.")},
 {_hint(_has(_TEXT, 'FileNotFoundException', 'DirectoryNotFoundException'), 'Check file paths - use paths from the available test data list.', 'Replace placeholder paths with actual test file names.')},
 {_hint(_has(_TEXT, 'CS0029') + ' OR ' + _has('lower(' + _TEXT + ')', 'type mismatch'), 'Check type compatibility - use explicit casting if needed.')},
 {_hint(_has(_TEXT, 'CS1061', 'does not contain'), 'Verify API method/property names against documentation.', 'The member may not exist in this API version.')}), '') AS hints FROM {FAILURES}""")
def strategy_hints(spark, sf_dir):
    return failures(spark, sf_dir).select("event_id", e.strategy(e.joined(F.col("errors"))).alias("hints"))


@query(f"""
WITH x AS (SELECT event_id, errors AS b, list_concat(errors, [message, message]) AS a FROM {FAILURES}),
y AS (SELECT event_id, a, b, list_distinct(list_filter(list_transform(a, lambda z: regexp_extract(z, '\\b(CS\\d+)\\b', 1)), lambda z: z <> '')) AS ca, list_filter(list_transform(b, lambda z: regexp_extract(z, '\\b(CS\\d+)\\b', 1)), lambda z: z <> '') AS cb FROM x)
SELECT event_id, CASE WHEN len(b) = 0 THEN len(a) > 0 ELSE (len(a) > 1.5 * len(b) AND len(a) >= len(b) + 2) OR len(list_filter(ca, lambda z: NOT list_contains(cb, z))) >= 2 END AS regressed FROM y""")
def error_regression(spark, sf_dir):
    """Whether a fix made the errors worse: here it adds the row's message twice."""
    after = F.concat("errors", F.array("message", "message"))
    return failures(spark, sf_dir).select("event_id", e.regressed(F.col("errors"), after).alias("regressed"))


# When an example is swapped for another one, and why; first match wins.
TRIGGERS = [(r"Microsoft\.AspNetCore", "web_framework"), (r"FileNotFoundException.*\.rar", "rar_fixture"), (r"CS8803", "top_level_statements"), (r"password", "password"), (r"CompressionLevel", "enum_changed")]


@query(f"SELECT event_id, {_case([(_match(_TEXT, p, 'i'), quoted(w)) for p, w in TRIGGERS], 'NULL')} AS substitute FROM {FAILURES}")
def substitution_trigger(spark, sf_dir):
    text = e.joined(F.col("errors"))
    return failures(spark, sf_dir).select("event_id", e.first_of([(w, p) for p, w in TRIGGERS], lambda p: text.rlike("(?i)" + p), None).alias("substitute"))


BUILT_IN, CATALOG = ["String", "Color"], ["Chart", "Report"]


@query(f"""
WITH t AS (SELECT event_id, unnest(list_filter(list_transform(errors, lambda z: CASE WHEN contains(z, 'CS0246') THEN nullif(regexp_extract(z, '''(\\w+)''', 1), '') END), lambda z: z IS NOT NULL)) AS name FROM {FAILURES})
SELECT event_id, name FROM t WHERE name NOT IN ({', '.join(map(quoted, BUILT_IN + CATALOG))})""")
def unfixable_types(spark, sf_dir):
    """Types that errors miss and that neither the platform nor the catalogue has."""
    names = F.filter(F.transform("errors", lambda z: F.when(F.contains(z, F.lit("CS0246")), F.nullif(F.regexp_extract(z, r"'(\w+)'", 1), F.lit("")))), lambda n: n.isNotNull())
    known = spark.createDataFrame([(n,) for n in BUILT_IN + CATALOG], "name string")
    return failures(spark, sf_dir).select("event_id", F.explode(names).alias("name")).join(F.broadcast(known), "name", "left_anti").select("event_id", "name")


@query(f"SELECT event_id, CASE WHEN contains({_TEXT}, 'Chart') AND regexp_matches({_TEXT}, 'CS(0117|1061)') THEN 'fix_gap' WHEN regexp_matches({_TEXT}, 'CS0246') AND regexp_extract({_TEXT}, '''(\\w+)''', 1) IN ('Archive') THEN 'fix_gap' WHEN regexp_matches({_TEXT}, 'CS\\d+') THEN 'data_gap' ELSE 'none' END AS gap FROM {FAILURES}")
def catalog_gaps(spark, sf_dir):
    """A failure whose member's type the catalogue knows is a gap of the fixes, any other compiler error one of the data."""
    t = e.joined(F.col("errors"))
    gap = F.when(F.contains(t, F.lit("Chart")) & t.rlike("CS(0117|1061)"), "fix_gap").when(t.rlike("CS0246") & F.regexp_extract(t, r"'(\w+)'", 1).isin("Archive"), "fix_gap").when(t.rlike(r"CS\d+"), "data_gap").otherwise("none")
    return failures(spark, sf_dir).select("event_id", gap.alias("gap"))
