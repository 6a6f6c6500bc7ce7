"""Source code in documents: what is kept, what it needs, and whether a fix may stand."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import code as c
from ..functions import errors as e
from .base import query
from .errors import _any, _case, _has, _match
from .samples import MESSAGES, SNIPPETS, pick, pick_sql, quoted, snippets

_BARE = "trim({0}, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))"
_LINES = "string_split(code, chr(10))"
_STRIPPED = f"list_filter(list_transform(string_split({_BARE.format('code')}, chr(10)), lambda z: {_BARE.format('z')}), lambda z: z <> '')"


def _without(*starts: str) -> str:
    return f"list_filter({_STRIPPED}, lambda z: NOT ({' OR '.join(f'starts_with(z, {quoted(s)})' for s in starts)}))"


_MEANT = _without("//", "#", "/*", "*/", "*")
_PLAIN = "regexp_replace(regexp_replace(code, '\"(?:[^\"\\\\]|\\\\.)*\"', '', 'g'), '''(?:[^''\\\\]|\\\\.)*''', '', 'g')"
_NO_COMMENTS = "regexp_replace(regexp_replace({0}, '//[^\\n]*', '', 'g'), '(?s)/\\*.*?\\*/', '', 'g')"
_NO_BLOCKS = "regexp_replace(regexp_replace({0}, '(?s)/\\*.*?\\*/', '', 'g'), '//[^\\n]*', '', 'g')"
_COUNT = "(length({0}) - length(replace({0}, '{1}', '')))"


@query(f"""
WITH p AS (SELECT doc_id, code, {_NO_COMMENTS.format(_PLAIN)} AS p FROM {SNIPPETS}), b AS (SELECT doc_id, code, {_COUNT.format('p', '{')} AS o, {_COUNT.format('p', '}')} AS s FROM p)
SELECT doc_id, CASE WHEN regexp_matches(code, '(?m)\\b(foreach|for|if|while)\\s*\\([^)]*$') THEN 'malformed_extraction_incomplete_statement' WHEN o <> s THEN concat('malformed_extraction_unbalanced_braces (open:', o, ', close:', s, ')') ELSE '' END AS reason FROM b""")
def extraction_syntax(spark, sf_dir):
    return snippets(spark, sf_dir).select("doc_id", c.extraction_error(F.col("code")).alias("reason"))


_LOOP = f"len(list_filter(regexp_extract_all(code, 'foreach\\s*\\([^)]*\\bin\\s+(\\w+)\\)', 1), lambda n: NOT regexp_matches(code, concat('(?:(?:{c.COLLECTIONS})\\s+', n, '\\b)|(?:\\b', n, '\\s*=)|(?:\\(\\s*(?:[\\w.<>\\[\\]]+\\s+)*', n, '\\s*[,)])')))) > 0"
_ROWS = _without("//")
_NAMES = f"list_filter(list_transform({_ROWS}, lambda z: regexp_extract(z, '^\\s*(\\w+)\\s*\\.', 1)), lambda n: n <> '' AND n NOT IN ({', '.join(map(quoted, c.NO_VARIABLES))}) AND NOT regexp_matches(n, '^[A-Z]'))"
_CONTEXT = f"len(list_filter({_NAMES}, lambda n: len(list_filter({_ROWS}, lambda z: regexp_matches(z, concat('\\b', n, '\\s*=')) OR regexp_matches(z, concat('(?:var|[\\w.<>\\[\\]]+)\\s+', n, '\\s*[=;,)]')) OR regexp_matches(z, concat('\\(\\s*[\\w.<>\\[\\]]+\\s+', n, '\\s*[,)]')) OR regexp_matches(z, concat('foreach\\s*\\(.*\\b', n, '\\s+in\\b')))) = 0)) > 0"
_SIG = f"list_filter(range(1, len(r) + 1), lambda i: {_match('r[i]', c.METHOD)})"
_STUB = f"len(list_filter(r, lambda z: regexp_matches(z, '^(public\\s+)?(abstract\\s+)?(class|interface|struct)\\s+\\w+'))) > 0 AND len({_SIG}) > 0 AND len(list_filter({_SIG}, lambda i: ends_with(r[i], ';') OR (ends_with(r[i], ')') AND NOT contains(concat(r[i + 1], r[i + 2]), '{{')))) = len({_SIG})"
_JUDGED = f"""j AS (SELECT *, {_MEANT} AS m, {_LOOP} AS loop_open, {_CONTEXT} AS context_open, {_ROWS} AS r FROM s), k AS (SELECT *, {_STUB} AS stub FROM j),
 l AS (SELECT *, CASE WHEN {_BARE.format('code')} = '' THEN 'empty_code' WHEN len(m) < 3 THEN concat('snippet_too_incomplete (only ', len(m), ' meaningful lines)') WHEN len(list_filter(m, lambda z: NOT starts_with(z, 'using ') AND NOT starts_with(z, 'namespace '))) = 0 THEN 'using_only_snippet'
 WHEN len(m) <= 25 AND loop_open THEN 'fragment_outer_context' WHEN len(m) <= 25 AND context_open THEN 'fragment_undeclared_context_variable' WHEN stub THEN 'interface_stub_no_implementation' END AS meaningless FROM k)"""


@query(f"WITH s AS {SNIPPETS}, {_JUDGED} SELECT doc_id, CAST(len(m) AS BIGINT) AS meaningful_lines, loop_open, context_open, stub, meaningless FROM l")
def meaningful_code(spark, sf_dir):
    """Whether a snippet means something by itself, with the tests behind it: names declared nowhere, methods without bodies."""
    x = F.col("code")
    return snippets(spark, sf_dir).select("doc_id", F.size(c.meaningful(x)).cast("long").alias("meaningful_lines"), c.undeclared_loop(x).alias("loop_open"), c.undeclared_context(x).alias("context_open"), c.stub(x).alias("stub"), c.meaningless(x).alias("meaningless"))


_HOLDERS = " + ".join(f"len(regexp_extract_all(code, {quoted('(?i)' + p)}))" for p in c.PLACEHOLDERS)
_FEW = _without("//", "using ")
_LICENSED = f"(len({_FEW}) <= 8 AND len(list_filter({_FEW}, lambda z: {_has('z', 'Metered', 'SetMeteredKey')} OR (contains(z, 'License') AND {_has('z', 'SetLicense', '.License(', 'new License')}))) > 0)"
_SIZE = f"len(string_split({_BARE.format('code')}, chr(10)))"
_REJECTED = f"""x AS (SELECT *, CASE WHEN meaningless IS NOT NULL THEN meaningless WHEN {_SIZE} < 3 THEN concat('Too short (', {_SIZE}, ' lines < 3)') WHEN {_SIZE} > 20 THEN concat('Too long (', {_SIZE}, ' lines > 20)')
 {' '.join(f"WHEN regexp_matches(code, {quoted('(?m)' + p)}) THEN {quoted('Matched exclusion pattern: ' + p)}" for p in c.EXCLUDED)}
 WHEN NOT {_any('code', c.INDICATORS, 'mi')} THEN 'No C# code indicators found' WHEN {_HOLDERS} >= 3 THEN 'excessive_placeholder_content' WHEN {_LICENSED} THEN 'license_api_key_required' END AS reason FROM l)"""


def _filtered(spark, sf_dir):
    return snippets(spark, sf_dir).withColumn("reason", c.rejected(F.col("code"), 3, 20))


@query(f"WITH s AS {SNIPPETS}, {_JUDGED}, {_REJECTED} SELECT doc_id, CAST({_HOLDERS} AS BIGINT) AS placeholders, {_LICENSED} AS license_only, reason, reason IS NULL AS kept FROM x")
def snippet_filter(spark, sf_dir):
    x = F.col("code")
    return _filtered(spark, sf_dir).select("doc_id", c.placeholders(x).cast("long").alias("placeholders"), c.license_only(x).alias("license_only"), "reason", F.col("reason").isNull().alias("kept"))


@query(f"WITH s AS {SNIPPETS}, {_JUDGED}, {_REJECTED} SELECT reason, count(*) AS n FROM x WHERE reason IS NOT NULL GROUP BY 1")
def filter_reasons(spark, sf_dir):
    return _filtered(spark, sf_dir).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


@query(f"WITH s AS {SNIPPETS}, {_JUDGED}, {_REJECTED} SELECT doc_id, source, reason, substr(code, 1, 100) AS preview FROM x WHERE reason IS NOT NULL")
def skipped_candidates(spark, sf_dir):
    """What the filter leaves out, with the reason and the first 100 characters."""
    return _filtered(spark, sf_dir).where("reason is not null").select("doc_id", "source", "reason", F.substring("code", 1, 100).alias("preview"))


# Aliases of languages.
ALIASES = {"csharp": ["c#", "cs"], "python": ["py", "python3"], "bash": ["sh", "shell"], "javascript": ["js"], "typescript": ["ts"]}
TAGS = ["C#", " cs ", "csharp", "PY", "python3", "sh", "Shell", "js", "TS", "java", ""]


@query(f"""SELECT doc_id, tag, {_case([(f"lower(trim(tag)) IN ({', '.join(map(quoted, v))})", quoted(k)) for k, v in ALIASES.items()], 'lower(trim(tag))')} AS language,
 {_case([(f"lower(tag) IN ({', '.join(map(quoted, v))})", quoted(k)) for k, v in ALIASES.items()], 'tag')} AS configured, lower({_case([(f"lower(tag) IN ({', '.join(map(quoted, v))})", quoted(k)) for k, v in ALIASES.items()], 'tag')}) IN ('csharp') AS validatable FROM (SELECT doc_id, {pick_sql(TAGS, 'doc_id')} AS tag FROM documents)""")
def language_normalise(spark, sf_dir):
    """Aliases to names: the fixed map strips and lowers, the configured one leaves what it doesn't know as given."""
    t = F.col("tag")
    fixed = e.first_of(ALIASES.items(), lambda v: F.lower(F.trim(t)).isin(*v), F.lower(F.trim(t)))
    configured = e.first_of(ALIASES.items(), lambda v: F.lower(t).isin(*v), t)
    d = snippets(spark, sf_dir).withColumn("tag", pick(TAGS, F.col("doc_id")))
    return d.select("doc_id", "tag", fixed.alias("language"), configured.alias("configured"), F.lower(configured).isin("csharp").alias("validatable"))


# Markers by which code of another family is told.
MARKERS = [("web", "WebApplication"), ("web", "Controller"), ("barcode", "BarReader"), ("barcode", "Encode."), ("documents", "SaveFormat"), ("files", "File.")]


@query(f"WITH m(family, marker) AS (VALUES {', '.join(f'({quoted(a)}, {quoted(b)})' for a, b in MARKERS)}) SELECT doc_id, list_sort(list(DISTINCT family)) AS families FROM {SNIPPETS} JOIN m ON contains(code, marker) WHERE family <> 'documents' GROUP BY 1")
def foreign_families(spark, sf_dir):
    """Families other than one's own whose markers stand in the code."""
    own = [(f, m) for f, m in MARKERS if f != "documents"]
    found = F.array_sort(F.array_distinct(F.filter(F.array(*(F.when(F.contains("code", F.lit(m)), f) for f, m in own)), lambda f: f.isNotNull())))
    return snippets(spark, sf_dir).select("doc_id", found.alias("families")).where(F.size("families") > 0)


_B = _BARE.format("code")
_TOP = f"""list_reduce(list_prepend('', list_transform(string_split({_B}, chr(10)), lambda z: {_BARE.format('z')})).list_transform(lambda z: struct_pack(z := z, depth := 0, space := false, kind := false, found := false)), lambda s, x: CASE
 WHEN x.z = '' OR starts_with(x.z, '//') OR starts_with(x.z, '[') OR starts_with(x.z, 'using ') THEN s
 WHEN starts_with(x.z, 'namespace ') THEN struct_pack(z := x.z, depth := 0, space := true, kind := s.kind, found := s.found)
 WHEN {_match('x.z', c.TYPE_LINE)} THEN struct_pack(z := x.z, depth := 0, space := s.space, kind := true, found := s.found)
 ELSE struct_pack(z := x.z, depth := CAST(s.depth + {_COUNT.format('x.z', '{')} - {_COUNT.format('x.z', '}')} AS INTEGER), space := s.space, kind := s.kind AND s.depth + {_COUNT.format('x.z', '{')} - {_COUNT.format('x.z', '}')} <> 0,
  found := s.found OR (s.depth = 0 AND NOT s.space AND NOT s.kind AND {_BARE.format("replace(replace(x.z, '{', ''), '}', '')")} <> '' AND NOT starts_with({_BARE.format("replace(replace(x.z, '{', ''), '}', '')")}, '//'))) END).found"""


@query(f"""WITH s AS (SELECT doc_id, {_B} AS code FROM {SNIPPETS}), t AS (SELECT *, {_TOP} AS top_level, {_any('code', c.MVC, 'mi')} AS mvc, {_any('code', c.WEBAPI, 'mi')} AS api FROM s)
SELECT doc_id, top_level, CASE WHEN code = '' THEN 'unknown' WHEN {_any('code', c.MINIMAL, 'mi')} THEN 'aspnet_core_minimal' WHEN regexp_matches(code, ':\\s*Controller\\b|\\bView\\s*\\(') AND mvc THEN 'aspnet_core_mvc'
 WHEN regexp_matches(code, '\\[ApiController\\]|:\\s*ControllerBase\\b') AND api THEN 'aspnet_core_webapi' WHEN mvc THEN 'aspnet_core_mvc' WHEN api THEN 'aspnet_core_webapi' WHEN {_any('code', c.LIBRARY, 'mi')} AND NOT {_any('code', c.ENTRY, 'mi')} AND NOT top_level THEN 'library' ELSE 'console' END AS context FROM t""")
def app_context(spark, sf_dir):
    return snippets(spark, sf_dir).select("doc_id", c.top_level(F.col("code")).alias("top_level"), c.app_context(F.col("code")).alias("context"))


_MSG = pick_sql(MESSAGES, "doc_id * 5")
_CLEAN = _NO_BLOCKS.format("code")
_CL = f"list_filter(string_split({_CLEAN}, chr(10)), lambda z: {_BARE.format('z')} <> '')"
_FR = f"list_filter(list_transform({_LINES}, lambda z: {_BARE.format('z')}), lambda z: z <> '')"
_READS = f"({_any('''regexp_replace(code, '\"[^\"]*\"', '', 'g')''', c.READS)} AND NOT {_any('code', c.CREATES)})"


@query(f"""WITH s AS (SELECT doc_id, {_B} AS code, lower({_MSG}) AS m, CASE WHEN doc_id % 11 = 3 THEN 'Python' ELSE 'CS' END AS language FROM {SNIPPETS}),
t AS (SELECT doc_id, CASE WHEN code = '' THEN 'empty_code' WHEN lower(language) NOT IN ('csharp', 'c#', 'cs') THEN 'no_csharp_code_block' WHEN {_BARE.format(_CLEAN)} = '' THEN 'only_comments' WHEN len({_CL}) < 3 THEN 'snippet_too_incomplete'
 WHEN {_has('lower(code)', *c.SKELETON)} AND len(list_filter({_CL}, lambda z: NOT starts_with(z, 'using ') AND NOT starts_with(z, '{{') AND NOT starts_with(z, '}}'))) <= 3 THEN 'snippet_too_incomplete' WHEN NOT {_any('code', c.USAGE, 'i')} THEN 'no_product_usage'
 WHEN {_any('code', c.SETUP, 'i')} OR {_has('m', 'license', 'trial', 'activation')} THEN 'requires_product_specific_setup'
 WHEN NOT {_any('code', c.STRUCTURE)} AND len(list_filter({_FR}, lambda z: ends_with(z, ';'))) >= len({_FR}) * 0.7 THEN 'fragment_without_method'
 WHEN {_has('m', 'does not exist', 'not found', 'undefined', 'is not defined')} OR (NOT (contains(m, 'missing') AND contains(m, 'directive')) AND {_READS}) THEN 'missing_required_context'
 WHEN {_any('code', c.AMBIGUOUS, 'i')} THEN 'ambiguous_input_file' WHEN len(regexp_extract_all(code, '\\bclass\\s+\\w+')) > 1 OR len(regexp_extract_all(code, '\\bnamespace\\s+\\w+')) > 1 THEN 'multiple_classes_or_namespaces' ELSE 'other' END AS reason FROM s)
SELECT doc_id, reason, reason IN ({', '.join(map(quoted, c.FATAL))}) AS escalate FROM t""")
def escalation(spark, sf_dir):
    language = F.when(F.col("doc_id") % 11 == 3, "Python").otherwise("CS")
    reason = c.escalation(F.col("code"), language, pick(MESSAGES, F.col("doc_id") * 5))
    return snippets(spark, sf_dir).select("doc_id", reason.alias("reason")).withColumn("escalate", F.col("reason").isin(*c.FATAL))


@query(f"""SELECT doc_id, {_any('code', c.USAGE, 'i')} AS uses_product, {_any('code', c.SETUP, 'i')} AS needs_setup, NOT {_any('code', c.STRUCTURE)} AND len(list_filter({_FR}, lambda z: ends_with(z, ';'))) >= len({_FR}) * 0.7 AS fragment,
 {_READS} AS needs_files, {_any('code', c.AMBIGUOUS, 'i')} AS ambiguous_files, len(regexp_extract_all(code, '\\bclass\\s+\\w+')) > 1 OR len(regexp_extract_all(code, '\\bnamespace\\s+\\w+')) > 1 AS several_types, {_CLEAN} AS clean FROM {SNIPPETS}""")
def escalation_tests(spark, sf_dir):
    """The tests behind the reasons, one a column, and the code without comments (blocks first)."""
    x = F.col("code")
    return snippets(spark, sf_dir).select("doc_id", e.any_of(x, c.USAGE, "i").alias("uses_product"), e.any_of(x, c.SETUP, "i").alias("needs_setup"), c.fragment(x).alias("fragment"), c.missing_context(x, F.lit("")).alias("needs_files"), e.any_of(x, c.AMBIGUOUS, "i").alias("ambiguous_files"), c.several_types(x).alias("several_types"), c.without_comments(x, True).alias("clean"))


APIS = {"Document": "Acme.Docs", "Generator": "Acme.Codes", "BarReader": "Acme.Codes", "License": "Acme"}


@query(f"""WITH a AS (SELECT *, list_filter([{', '.join(f"CASE WHEN {_any('code', [f'{chr(92)}bnew{chr(92)}s+{k}{chr(92)}b', f'{chr(92)}b{k}{chr(92)}.', f'{chr(92)}b{k}<', f'<{k}>', f'{chr(92)}({k}{chr(92)}s+{chr(92)}w+{chr(92)})'])} THEN {quoted(k)} END" for k in APIS)}], lambda z: z IS NOT NULL) AS apis FROM {SNIPPETS}),
u AS (SELECT *, list_distinct(list_concat(['System', 'System.IO'], list_transform(apis, lambda z: CASE z {' '.join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in APIS.items())} END))) AS needed FROM a)
SELECT doc_id, regexp_matches(code, '(?m)^\\s*using\\s+[\\w.]+\\s*;') AS has_usings, regexp_matches(code, '\\bnamespace\\s+[\\w.]+') AS has_namespace, len(list_filter({_LINES}, lambda z: regexp_matches(string_split(z, '//')[1], '\\bclass\\s+\\w+'))) > 0 AS has_class,
 {_any('code', c.ENTRY)} AS has_main, regexp_matches(code, '\\bawait\\s+|\\basync\\s+') AS is_async, apis, list_sort(list_filter(needed, lambda z: NOT list_contains(regexp_extract_all(code, 'using\\s+([\\w.]+)\\s*;', 1), z))) AS missing_usings FROM u""")
def code_structure(spark, sf_dir):
    """What a snippet holds, which known types it uses, and which namespaces it lacks for them."""
    x = F.col("code")
    flags = {k: v for k, v in c.structure(x).items() if k != "is_complete"}
    apis = F.filter(F.array(*(F.when(c.uses_type(x, k), k) for k in APIS)), lambda z: z.isNotNull())
    spaces = F.transform(F.col("apis"), lambda z: e.first_of([(v, k) for k, v in APIS.items()], lambda k: z == k, None))
    needed = F.array_distinct(F.concat(F.array(F.lit("System"), F.lit("System.IO")), spaces))
    there = F.regexp_extract_all(x, F.lit(r"using\s+([\w.]+)\s*;"), F.lit(1))
    return snippets(spark, sf_dir).withColumn("apis", apis).select("doc_id", *(v.alias(k) for k, v in flags.items()), "apis", F.array_sort(F.array_except(needed, there)).alias("missing_usings"))


_US = f"list_filter(list_transform(list_filter(list_transform(string_split({_CLEAN}, chr(10)), lambda z: {_BARE.format('z')}), lambda z: starts_with(z, 'using ') AND NOT starts_with(z, 'using static ') AND NOT contains(z, '=') AND NOT contains(z, 'using (')), lambda z: regexp_extract(z, '^using\\s+([A-Za-z_][\\w.]*)\\s*;', 1)), lambda z: z <> '')"


@query(f"""WITH u AS (SELECT doc_id, {_US} AS u FROM {SNIPPETS}) SELECT doc_id, u AS namespaces, list_filter(u, lambda z: NOT (z = 'System' OR starts_with(z, 'Acme.'))) AS outside, list_filter(u, lambda z: z = 'Acme' OR starts_with(z, 'System.')) AS blocked FROM u""")
def namespace_policy(spark, sf_dir):
    """A snippet's namespaces, those that a list of allowed patterns lacks, and those that a list of blocked ones names."""
    u = F.col("namespaces")
    outside = F.filter(u, lambda z: ~(c.fits(z, "System") | c.fits(z, "Acme.*")))
    blocked = F.filter(u, lambda z: c.fits(z, "Acme") | c.fits(z, "System.*"))
    return snippets(spark, sf_dir).select("doc_id", c.usings(F.col("code")).alias("namespaces")).select("doc_id", "namespaces", outside.alias("outside"), blocked.alias("blocked"))


ENUMS = ["SaveFormat", "Encode", "Decode", "Colors"]
CRITICAL_ENUMS = ["Encode", "Decode"]


def _signed(x: str) -> str:
    k = _NO_COMMENTS.format(x)
    found = f"regexp_extract_all({k}, '(?m)(\\.\\w+\\s*=\\s*[^;=]+?)(?:;|\\z)', 1)"
    return f"""struct_pack(members := list_sort(list_distinct(regexp_extract_all({k}, '\\b((?:{'|'.join(ENUMS)})\\.\\w+)\\b', 1))), calls := list_sort(list_filter(list_distinct(regexp_extract_all({k}, '\\.(\\w+)\\s*\\(', 1)), lambda z: z NOT IN ({', '.join(map(quoted, c.NOISE))}))),
 types := list_sort(list_distinct(regexp_extract_all({k}, '\\bnew\\s+(\\w+)\\s*[\\(\\{{]', 1))), p := list_transform({found}, lambda z: struct_pack(k := regexp_extract(z, '^\\.(\\w+)', 1), v := {_BARE.format("regexp_extract(z, '(?s)^\\.\\w+\\s*=\\s*(.*)$', 1)")})))"""


_LAST = "list_filter({0}, lambda q, i: len(list_filter({0}[i + 1:], lambda w: w.k = q.k)) = 0)"


@query(f"""WITH s AS (SELECT doc_id, {_signed('code')} AS g FROM {SNIPPETS}) SELECT doc_id, g.members, g.calls, g.types, list_sort(list_transform({_LAST.format('g.p')}, lambda q: concat(q.k, '=', q.v))) AS properties FROM s""")
def code_signature(spark, sf_dir):
    """Members of known enumerations, calls, constructed types and assigned properties."""
    s = snippets(spark, sf_dir).select("doc_id", c.signature(F.col("code"), ENUMS).alias("g"))
    props = F.array_sort(F.transform(F.map_entries("g.properties"), lambda p: F.concat_ws("=", p["key"], p["value"])))
    return s.select("doc_id", "g.members", "g.calls", "g.types", props.alias("properties"))


_EX = "list_filter({0}, lambda z: NOT list_contains({1}, z))"
_KEYS = "list_transform({0}, lambda q: q.k)"


@query(f"""WITH s AS (SELECT doc_id, {_signed('code')} AS a, {_signed('fixed')} AS b FROM {SNIPPETS}), t AS (SELECT doc_id, a, b, {_LAST.format('a.p')} AS pa, {_LAST.format('b.p')} AS pb FROM s),
u AS (SELECT doc_id, list_sort(list_distinct(list_transform(list_concat({_EX.format('a.members', 'b.members')}, {_EX.format('b.members', 'a.members')}), lambda z: string_split(z, '.')[1]))) AS kinds_changed, list_sort({_EX.format('b.calls', 'a.calls')}) AS calls_added, list_sort({_EX.format('a.calls', 'b.calls')}) AS calls_removed, a.types <> b.types AS types_changed,
 list_sort({_EX.format(_KEYS.format('pb'), _KEYS.format('pa'))}) AS properties_added, list_sort({_EX.format(_KEYS.format('pa'), _KEYS.format('pb'))}) AS properties_removed,
 list_sort(list_transform(list_filter(pa, lambda q: len(list_filter(pb, lambda w: w.k = q.k AND w.v <> q.v)) > 0), lambda q: q.k)) AS properties_changed FROM t)
SELECT *, round(least(1.0, CASE WHEN len(kinds_changed) > 0 THEN 0.8 ELSE 0 END + CASE WHEN types_changed THEN 0.7 ELSE 0 END + least(0.5, 0.1 * (len(calls_added) + len(calls_removed))) + least(0.4, 0.1 * (len(properties_removed) + len(properties_changed))))::DOUBLE, 6) AS score,
 len(list_filter(kinds_changed, lambda z: z IN ('Encode', 'Decode'))) > 0 AS critical FROM u""")
def signature_drift(spark, sf_dir):
    """What a fix changed in a snippet's meaning, scored; critical where an enumeration that must stay has changed."""
    s = snippets(spark, sf_dir).select("doc_id", c.signature(F.col("code"), ENUMS).alias("a"), c.signature(F.col("fixed"), ENUMS).alias("b"))
    found = s.select("doc_id", *(v.alias(k) for k, v in c.changes(F.col("a"), F.col("b")).items()))
    return found.withColumn("critical", F.arrays_overlap("kinds_changed", F.array(*(F.lit(k) for k in CRITICAL_ENUMS))))


def _mode(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '\\bGenerator\\b|\\.Generate\\s*\\(') AND regexp_matches({x}, '\\bBarReader\\b|\\.Read\\w*\\s*\\(') THEN 'both' WHEN regexp_matches({x}, '\\bGenerator\\b|\\.Generate\\s*\\(') THEN 'generation' WHEN regexp_matches({x}, '\\bBarReader\\b|\\.Read\\w*\\s*\\(') THEN 'recognition' ELSE 'unknown' END"


@query(f"""WITH s AS (SELECT doc_id, list_sort(list_distinct(regexp_extract_all(code, '(?:Decode|Encode)\\.(\\w+)', 1))) AS kinds, list_sort(list_distinct(regexp_extract_all(fixed, '(?:Decode|Encode)\\.(\\w+)', 1))) AS kinds_fixed, {_mode('code')} AS mode, {_mode('fixed')} AS mode_fixed,
 {_EX.format("list_distinct(regexp_extract_all(code, '\\.(\\w+)\\s*=[^=]', 1))", "regexp_extract_all(fixed, '\\.(\\w+)\\s*=[^=]', 1)")} AS lost FROM {SNIPPETS}),
i AS (SELECT *, list_filter([CASE WHEN len(kinds) > 0 AND len(kinds_fixed) > 0 AND len({_EX.format('kinds', 'kinds_fixed')}) > 0 THEN 'critical:type_change' END, CASE WHEN mode <> 'unknown' AND mode_fixed <> 'unknown' AND mode <> mode_fixed THEN 'critical:mode_change' END,
 CASE WHEN list_contains(lost, 'Size') THEN 'high:critical_property_loss' WHEN len(lost) >= 2 THEN 'high:customization_loss' END], lambda z: z IS NOT NULL) AS issues FROM s)
SELECT doc_id, kinds, mode, issues, len(list_filter(issues, lambda z: starts_with(z, 'critical'))) = 0 AS valid, round(least(1.0, 0.3 * len(issues))::DOUBLE, 6) AS score FROM i""")
def family_drift(spark, sf_dir):
    """A family's own rules: types may not vanish, the mode must stay, and properties that matter too."""
    kinds = lambda x: F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(r"(?:Decode|Encode)\.(\w+)"), F.lit(1))))
    props = lambda x: F.array_distinct(F.regexp_extract_all(x, F.lit(r"\.(\w+)\s*=[^=]"), F.lit(1)))
    a, b = F.col("code"), F.col("fixed")
    lost = F.array_except(props(a), props(b))
    gone = (F.size(kinds(b)) > 0) & (F.size(F.array_except(kinds(a), kinds(b))) > 0)
    moved = (c.mode(a) != "unknown") & (c.mode(b) != "unknown") & (c.mode(a) != c.mode(b))
    issues = F.array(F.when(gone, "critical:type_change"), F.when(moved, "critical:mode_change"), F.when(F.array_contains(lost, "Size"), "high:critical_property_loss").when(F.size(lost) >= 2, "high:customization_loss"))
    d = snippets(spark, sf_dir).select("doc_id", kinds(a).alias("kinds"), c.mode(a).alias("mode"), F.filter(issues, lambda z: z.isNotNull()).alias("issues"))
    return d.withColumn("valid", ~F.exists("issues", lambda z: z.startswith("critical"))).withColumn("score", F.round(F.least(F.lit(1.0), 0.3 * F.size("issues")), 6))


@query(f"""SELECT doc_id, regexp_replace(lower(code), '\\s+', '', 'g') = regexp_replace(lower(fixed), '\\s+', '', 'g') AS same, list_sort({_EX.format("list_distinct(regexp_extract_all(code, '(?i)\"([^\"]+\\.(?:docx|doc|pdf|xlsx|xls|pptx|ppt|odt|rtf|txt))\"', 1))", "regexp_extract_all(fixed, '(?i)\"([^\"]+\\.(?:docx|doc|pdf|xlsx|xls|pptx|ppt|odt|rtf|txt))\"', 1)")}) AS names_lost,
 len(list_filter([regexp_extract({_MSG}, '(?:CS0246|CS0103).*?''(\\w+)''', 1), regexp_extract({_MSG}, 'does not contain a definition for ''(\\w+)''', 1), regexp_extract({_MSG}, '''(\\w+)'' (?:is not|does not)', 1)], lambda t: t <> '' AND contains(code, t) AND NOT contains(fixed, t))) > 0 OR len(string_split(code, chr(10))) - len(string_split(fixed, chr(10))) > 3 AS deletion FROM {SNIPPETS}""")
def fix_guards(spark, sf_dir):
    """Whether a fix changes nothing, loses file names, or only deletes what the error names."""
    a, b = F.col("code"), F.col("fixed")
    names = lambda x: F.array_distinct(F.regexp_extract_all(x, F.lit(r'(?i)"([^"]+\.(?:docx|doc|pdf|xlsx|xls|pptx|ppt|odt|rtf|txt))"'), F.lit(1)))
    return snippets(spark, sf_dir).select("doc_id", c.identical(a, b).alias("same"), F.array_sort(F.array_except(names(a), names(b))).alias("names_lost"), c.deletion_fix(a, b, F.array(pick(MESSAGES, F.col("doc_id") * 5))).alias("deletion"))


@query(f"""WITH l AS (SELECT doc_id, code, string_split(code, chr(10)) AS l FROM {SNIPPETS}), i AS (SELECT *, coalesce(list_max(list_filter(range(1, len(l) + 1), lambda k: starts_with({_BARE.format('l[k]')}, 'using ') AND ends_with({_BARE.format('l[k]')}, ';'))), 0) AS i FROM l)
SELECT doc_id, CASE WHEN NOT contains(code, 'using Acme.Docs;') AND contains(code, 'Document') THEN array_to_string(list_concat(l[1:i], ['using Acme.Docs;'], l[i + 1:]), chr(10)) END AS new FROM i""")
def using_insertion(spark, sf_dir):
    """The code with a learned directive after its last using line, where its type is used and it isn't there yet."""
    return snippets(spark, sf_dir).select("doc_id", c.insert_using(F.col("code"), F.lit("using Acme.Docs;"), F.lit("Document")).alias("new"))


_ANSWER = f"concat(CASE doc_id % 4 WHEN 0 THEN concat('```csharp', chr(10)) WHEN 1 THEN 'I''m sorry, ' WHEN 2 THEN 'Note: ' ELSE '' END, code, CASE doc_id % 8 WHEN 0 THEN concat(chr(10), '```') ELSE '' END)"


@query(f"""WITH a AS (SELECT doc_id, {_BARE.format(_ANSWER)} AS a FROM {SNIPPETS}), l AS (SELECT *, string_split(a, chr(10)) AS l FROM a),
k AS (SELECT doc_id, CASE WHEN starts_with(a, '```') THEN array_to_string(CASE WHEN len(l) > 1 AND {_BARE.format('l[-1]')} = '```' THEN l[2:len(l) - 1] ELSE l[2:] END, chr(10)) ELSE a END AS clean FROM l), b AS (SELECT *, {_BARE.format('clean')} AS b, {' + '.join(f"CAST(contains({_BARE.format('clean')}, {quoted(w)}) AS INTEGER)" for w in c.CODE_WORDS)} AS n FROM k)
SELECT doc_id, coalesce(clean, '') AS clean, CASE WHEN b = '' THEN 'empty_response' WHEN {_has('lower(substr(b, 1, 100))', *c.REFUSALS)} THEN 'llm_refusal_detected' WHEN {' OR '.join(f'starts_with(b, {quoted(p)})' for p in c.PROSE)} THEN 'prose_explanation_detected' WHEN n < 2 THEN concat('insufficient_code_indicators (', n, '/2)') END AS reason FROM b""")
def response_validation(spark, sf_dir):
    """A model's answer without its fence, and why it is no code."""
    k = F.col("doc_id")
    head = F.when(k % 4 == 0, "```csharp\n").when(k % 4 == 1, "I'm sorry, ").when(k % 4 == 2, "Note: ").otherwise("")
    answer = F.concat(head, F.col("code"), F.when(k % 8 == 0, "\n```").otherwise(""))
    clean, reason = c.response(answer)
    return snippets(spark, sf_dir).select("doc_id", clean.alias("clean"), reason.alias("reason"))
