"""Rewriting code by rule: fixes in their fixed order, run-time patches, what people's fixes teach, and what a fix did to maps and contexts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import code as c
from ..functions import markdown as m
from . import markdown  # noqa: F401  its SQL is part of the SQL here
from .base import ORACLES, query, read
from .code import _mode
from .samples import SNIPPETS, articles, pick, pick_sql, quoted, snippets

BROKEN = [
    "class A\n{\n    void M()\n    {\n        Color c = Color.Red;\n        var l = new List<Color>();\n  ",
    "using System;\nvar a = new Archive();\nvar c = new Chart();\na.Save();",
    "var a = new Archive();\n{{{{{\n",
    "Paint(Color.Blue, new Color(1), x.Color);\nColor  picked = A.Color.Red;",
    "static void Main()\n{\n    Save(\"output_folder\");\n    Read(@\"C:\\in\\source/\", \"file.zip\", \"http://x/output\");\n}",
    "static async Task Main(string[] args) {\n    Go(\"extracted\");\n}",
    "Save(\"output\");",
]
ERRORS = [
    ["error CS1513: } expected", "error CS0104: 'Color' is an ambiguous reference between 'A.Color' and 'B.Color'"],
    ["error CS0246: The type or namespace name 'Archive' could not be found", "error CS0246: The type or namespace name 'Chart' could not be found"],
    ["error CS1513: } expected", "error CS0246: The type or namespace name 'Archive' could not be found"],
    ["error CS0104: 'Color' is an ambiguous reference between 'A.Color' and 'B.Color'"],
]
SPACES = {"Archive": "Acme.Zip", "Chart": "Acme.Charts"}


def _cases(spark, sf_dir):
    k = F.col("doc_id")
    errors = F.element_at(F.array(*(F.array(*map(F.lit, e)) for e in ERRORS)), (F.floor(k / len(BROKEN)) % len(ERRORS) + 1).cast("int"))
    return read(spark, sf_dir, "documents").select("doc_id", pick(BROKEN, k).alias("code"), errors.alias("errors"))


_CASES = f"(SELECT doc_id, {pick_sql(BROKEN, 'doc_id')} AS code, ([{', '.join('[' + ', '.join(map(quoted, e)) + ']' for e in ERRORS)}])[CAST(doc_id // {len(BROKEN)} % {len(ERRORS)} AS INTEGER) + 1] AS errors FROM documents)"
_MISSING = "(length(code) - length(replace(code, '{', '')) - length(code) + length(replace(code, '}', '')))"
_TRIMMED = "rtrim(code, concat(' ', chr(9), chr(10), chr(13)))"
_LAST = "coalesce(list_max(list_filter(range(1, len(string_split({0}, chr(10))) + 1), lambda i: starts_with(trim(string_split({0}, chr(10))[i]), 'using ') AND ends_with(trim(string_split({0}, chr(10))[i]), ';'))), 0)"


def _inserted(x: str, name: str, space: str) -> str:
    i = _LAST.format(x)
    return f"CASE WHEN len(list_filter(errors, lambda e: contains(e, 'CS0246') AND contains(e, '''{name}'''))) > 0 AND NOT contains({x}, 'using {space};') AND contains({x}, '{name}') THEN array_to_string(list_concat(string_split({x}, chr(10))[1:{i}], ['using {space};'], string_split({x}, chr(10))[{i} + 1:]), chr(10)) ELSE {x} END"


@query(f"""
WITH a AS (SELECT *, CASE WHEN len(list_filter(errors, lambda e: contains(e, 'CS1513'))) > 0 AND {_MISSING} BETWEEN 1 AND 3 THEN concat({_TRIMMED}, repeat(concat(chr(10), '}}'), {_MISSING})) ELSE code END AS c1 FROM {_CASES}),
b AS (SELECT *, CASE WHEN len(list_filter(errors, lambda e: contains(e, 'CS0104'))) > 0 AND NOT contains(c1, 'A.Color') THEN regexp_replace(regexp_replace(c1, '(^|[^.\\w])Color([.<]|\\s+\\w)', '\\1A.Color\\2', 'g'), '\\bnew\\s+Color\\b', 'new A.Color', 'g') ELSE c1 END AS c2 FROM a),
d AS (SELECT *, {_inserted('c2', 'Archive', 'Acme.Zip')} AS c3 FROM b), e AS (SELECT *, {_inserted('c3', 'Chart', 'Acme.Charts')} AS c4 FROM d)
SELECT doc_id, c4 AS fixed, list_filter([CASE WHEN c1 <> code THEN concat('CS1513: Added ', {_MISSING}, ' missing closing brace(s)') END, CASE WHEN c2 <> c1 THEN 'CS0104: Fully qualified ambiguous ''Color'' as ''A.Color''' END, CASE WHEN c3 <> c2 THEN 'CS0246: Added using Acme.Zip;' END, CASE WHEN c4 <> c3 THEN 'CS0246: Added using Acme.Charts;' END], lambda z: z IS NOT NULL) AS fixes FROM e""")
def micro_fixes(spark, sf_dir):
    """Code after the fixes that its errors call for, in their fixed order, and what was done: braces, ambiguous types, missing namespaces."""
    d = _cases(spark, sf_dir)
    said = lambda *words: F.exists("errors", lambda e: F.forall(F.array(*map(F.lit, words)), lambda w: F.contains(e, w)))
    gap = c.count(F.col("code"), "{") - c.count(F.col("code"), "}")
    closed = F.concat(F.rtrim("code", F.lit(" \t\n\r")), F.expr("repeat('\\n}', greatest(gap, 0))"))
    d = d.withColumn("gap", gap).withColumn("c1", F.when(said("CS1513") & F.col("gap").between(1, 3), closed).otherwise(F.col("code")))
    named = F.regexp_replace(F.regexp_replace("c1", r"(?<![.\w])Color(?=[.<]|\s+\w)", "A.Color"), r"\bnew\s+Color\b", "new A.Color")
    d = d.withColumn("c2", F.when(said("CS0104") & ~F.contains("c1", F.lit("A.Color")), named).otherwise(F.col("c1")))
    notes = [F.when(F.col("c1") != F.col("code"), F.concat(F.lit("CS1513: Added "), F.col("gap").cast("string"), F.lit(" missing closing brace(s)"))), F.when(F.col("c2") != F.col("c1"), "CS0104: Fully qualified ambiguous 'Color' as 'A.Color'")]
    at = "c2"
    for i, (name, space) in enumerate(SPACES.items(), 3):
        added = c.insert_using(F.col(at), F.lit(f"using {space};"), F.lit(name))
        d = d.withColumn(f"c{i}", F.when(said("CS0246", f"'{name}'"), F.coalesce(added, F.col(at))).otherwise(F.col(at)))
        notes.append(F.when(F.col(f"c{i}") != F.col(at), f"CS0246: Added using {space};"))
        at = f"c{i}"
    return d.select("doc_id", F.col(at).alias("fixed"), F.filter(F.array(*notes), lambda z: z.isNotNull()).alias("fixes"))


_DIRS = "list_sort(list_distinct(list_filter(list_concat(regexp_extract_all(code, '\"([^\"]+)\"', 1), regexp_extract_all(code, '@\"([^\"]+)\"', 1)), lambda z: NOT regexp_matches(z, '^(http|www)') AND NOT regexp_matches(z, '(?i)\\.(zip|rar|7z|gz|txt|cs|dll|exe|json|xml|png|jpg|pdf|doc)$') AND regexp_matches(lower(z), '_folder|_dir|[/\\\\]$|output|extracted|destination|source|input'))))"


@query(f"""
WITH a AS (SELECT doc_id, code, string_split(code, chr(10)) AS l, {_DIRS} AS d FROM {_CASES}), b AS (SELECT *, list_filter(range(1, len(l) + 1), lambda i: regexp_matches(l[i], '\\b(?:static\\s+)?(?:async\\s+)?(?:void|Task|int)\\s+Main\\s*\\('))[1] AS m FROM a),
e AS (SELECT *, list_filter(range(m, least(m + 5, len(l) + 1)), lambda i: contains(l[i], '{{'))[1] AS o FROM b), g AS (SELECT *, CASE WHEN trim(l[o + 1]) <> '' THEN regexp_extract(l[o + 1], '^\\s*') ELSE '        ' END AS ind FROM e)
SELECT doc_id, CASE WHEN len(d) > 0 AND o IS NOT NULL THEN array_to_string(list_concat(l[1:o], list_transform(d, lambda z: concat(ind, 'Directory.CreateDirectory(@"', z, '");')), [''], l[o + 1:]), chr(10)) END AS patched FROM g""")
def runtime_directories(spark, sf_dir):
    """The patch for a missing directory: folders that the code names are made at the start of Main; null where there is nothing to do."""
    x = F.col("code")
    text = F.concat(F.regexp_extract_all(x, F.lit('"([^"]+)"'), F.lit(1)), F.regexp_extract_all(x, F.lit('@"([^"]+)"'), F.lit(1)))
    folder = lambda z: ~z.rlike("^(http|www)") & ~z.rlike(r"(?i)\.(zip|rar|7z|gz|txt|cs|dll|exe|json|xml|png|jpg|pdf|doc)$") & F.lower(z).rlike(r"_folder|_dir|[/\\]$|output|extracted|destination|source|input")
    d = _cases(spark, sf_dir).select("doc_id", F.split("code", "\n").alias("l"), F.array_sort(F.array_distinct(F.filter(text, folder))).alias("d"))
    main = F.array_min(F.transform("l", lambda z, i: F.when(z.rlike(r"\b(?:static\s+)?(?:async\s+)?(?:void|Task|int)\s+Main\s*\("), i)))
    d = d.withColumn("m", main).withColumn("o", F.array_min(F.transform("l", lambda z, i: F.when(F.contains(z, F.lit("{")) & i.between(F.col("m"), F.col("m") + 4), i + 1))))
    after = F.get("l", F.col("o"))
    indent = F.when(F.trim(after) != "", F.regexp_extract(after, r"^\s*", 0)).otherwise("        ")
    calls = F.transform("d", lambda z: F.concat(indent, F.lit('Directory.CreateDirectory(@"'), z, F.lit('");')))
    new = F.array_join(F.concat(F.slice("l", F.lit(1), F.col("o")), calls, F.array(F.lit("")), F.slice("l", F.col("o") + 1, F.size("l"))), "\n")
    return d.select("doc_id", F.when((F.size("d") > 0) & F.col("o").isNotNull(), new).alias("patched"))


_EX = "list_filter(list_distinct({0}), lambda z: NOT list_contains({1}, z))"
_U = "regexp_extract_all({0}, '(?m)^using\\s+([\\w.]+)\\s*;', 1)"
_V = "regexp_extract_all({0}, '\\bvar\\s+(\\w+)\\s*=', 1)"
_N = "regexp_extract_all({0}, '\\bnew\\s+(\\w+)\\s*\\(', 1)"


@query(f"""
WITH s AS (SELECT {_EX.format(_U.format('fixed'), _U.format('code'))} AS u, {_EX.format(_V.format('fixed'), _V.format('code'))} AS v, {_EX.format(_N.format('code'), _N.format('fixed'))} AS gone, {_EX.format(_N.format('fixed'), _N.format('code'))} AS new FROM {SNIPPETS}),
a AS (SELECT 'using' AS kind, unnest(u) AS what FROM s UNION ALL SELECT 'variable', unnest(v) FROM s UNION ALL SELECT 'type', concat(gone[1], ' -> ', new[1]) FROM s WHERE len(gone) = 1 AND len(new) = 1)
SELECT kind, what, count(*) AS n FROM a GROUP BY 1, 2 HAVING count(*) >= 2""")
def fix_mining(spark, sf_dir):
    """What fixes keep adding: namespaces, variables, and one type for another; counted from two occurrences on."""
    a, b = F.col("code"), F.col("fixed")
    found = lambda x, p: F.array_distinct(F.regexp_extract_all(x, F.lit(p), F.lit(1)))
    more = lambda p: F.array_except(found(b, p), found(a, p))
    less = lambda p: F.array_except(found(a, p), found(b, p))
    use, var, new = r"(?m)^using\s+([\w.]+)\s*;", r"\bvar\s+(\w+)\s*=", r"\bnew\s+(\w+)\s*\("
    swap = F.when((F.size(less(new)) == 1) & (F.size(more(new)) == 1), F.array(F.concat(F.get(less(new), F.lit(0)), F.lit(" -> "), F.get(more(new), F.lit(0))))).otherwise(F.array().cast("array<string>"))
    rows = F.concat(*(F.transform(x, lambda z: F.struct(F.lit(k).alias("kind"), z.alias("what"))) for k, x in (("using", more(use)), ("variable", more(var)), ("type", swap))))
    return snippets(spark, sf_dir).select(F.inline(rows)).groupBy("kind", "what").agg(F.count("*").alias("n")).where("n >= 2")


_CONTEXT = ORACLES["app_context"]


@query(f"""WITH a AS ({_CONTEXT}), b AS ({_CONTEXT.replace(SNIPPETS, f'(SELECT doc_id, fixed AS code FROM {SNIPPETS})')})
SELECT a.doc_id, a.context AS original, b.context AS fixed, a.context <> b.context AS drift, a.context = b.context OR (a.context = 'console' AND b.context IN ('library', 'aspnet_minimal')) AS allowed FROM a JOIN b ON a.doc_id = b.doc_id""")
def context_drift(spark, sf_dir):
    """Whether a fix moved code into another application context, and whether that move is on the list. The list's
    name for minimal hosting isn't the classifier's, so that such a move is never allowed."""
    d = snippets(spark, sf_dir).select("doc_id", c.app_context(F.col("code")).alias("original"), c.app_context(F.col("fixed")).alias("fixed"))
    moved = F.col("original") != F.col("fixed")
    return d.select("doc_id", "original", "fixed", moved.alias("drift"), (~moved | ((F.col("original") == "console") & F.col("fixed").isin("library", "aspnet_minimal"))).alias("allowed"))


_PICK = "CASE event_id % 3 WHEN 0 THEN 'regex_replace' WHEN 1 THEN 'using_directive' ELSE 'template' END"


@query(f"""SELECT event_id, kind, CASE kind WHEN 'regex_replace' THEN regexp_replace(t, '[aeiou]+', '*', 'g') WHEN 'using_directive' THEN CASE WHEN contains(t, 'purchase') THEN t ELSE concat('using X;', chr(10), t) END ELSE t END AS code,
 CASE kind WHEN 'regex_replace' THEN concat('Replaced ', len(regexp_extract_all(t, '[aeiou]+')), ' occurrence(s) via regex') WHEN 'using_directive' THEN CASE WHEN contains(t, 'purchase') THEN 'Trigger not found' ELSE 'Added using X;' END ELSE 'Pattern is template-only (not executable)' END AS note FROM (SELECT event_id, event_type AS t, {_PICK} AS kind FROM events)""")
def pattern_dispatch(spark, sf_dir):
    """A learned pattern's kind decides how it is applied, and what is said of it."""
    t, k = F.col("event_type"), F.col("event_id") % 3
    kind = F.when(k == 0, "regex_replace").when(k == 1, "using_directive").otherwise("template")
    none = F.contains(t, F.lit("purchase"))
    code = F.when(k == 0, F.regexp_replace(t, "[aeiou]+", "*")).when((k == 1) & ~none, F.concat(F.lit("using X;\n"), t)).otherwise(t)
    note = F.when(k == 0, F.concat(F.lit("Replaced "), F.regexp_count(t, F.lit("[aeiou]+")).cast("string"), F.lit(" occurrence(s) via regex"))).when(k == 1, F.when(none, "Trigger not found").otherwise("Added using X;")).otherwise("Pattern is template-only (not executable)")
    return read(spark, sf_dir, "events").select("event_id", kind.alias("kind"), code.alias("code"), note.alias("note"))


# Rules of families, tried in this order; the first that changes the code wins.
FAMILY_FIXES = {"documents": [(r"\.pdf\"", '.docx"'), ("Save\\(", "SaveAs(")], "codes": [("Encode\\.QR", "Encode.Aztec")]}


@query(f"""WITH s AS (SELECT doc_id, code, CASE WHEN doc_id % 2 = 0 THEN 'documents' ELSE 'codes' END AS family FROM {SNIPPETS})
SELECT doc_id, family, CASE WHEN family = 'documents' AND regexp_matches(code, '\\.pdf"') THEN regexp_replace(code, '\\.pdf"', '.docx"', 'g') WHEN family = 'documents' AND regexp_matches(code, 'Save\\(') THEN regexp_replace(code, 'Save\\(', 'SaveAs(', 'g') WHEN family = 'codes' AND regexp_matches(code, 'Encode\\.QR') THEN regexp_replace(code, 'Encode\\.QR', 'Encode.Aztec', 'g') END AS fixed FROM s""")
def family_fixes(spark, sf_dir):
    """A family's registered fixes: the first that applies."""
    x, family = F.col("code"), F.when(F.col("doc_id") % 2 == 0, "documents").otherwise("codes")
    fixed = None
    for name, rules in FAMILY_FIXES.items():
        for pattern, new in rules:
            test, value = (F.col("family") == name) & x.rlike(pattern), F.regexp_replace(x, pattern, new)
            fixed = F.when(test, value) if fixed is None else fixed.when(test, value)
    return snippets(spark, sf_dir).withColumn("family", family).select("doc_id", "family", fixed.alias("fixed"))


@query(f"""WITH b AS ({ORACLES['fenced_blocks']}), f AS (SELECT doc_id, block_index, start_line, language, content, CASE WHEN language NOT IN ('csharp', 'cs', 'c#') THEN 'language' WHEN length(trim(content)) = 0 THEN 'empty' WHEN length(content) - length(replace(content, '{{', '')) <> length(content) - length(replace(content, '}}', '')) THEN 'unbalanced' WHEN contains(content, 'Open(') THEN 'foreign' END AS reason FROM b)
SELECT doc_id, block_index, start_line, content AS code, {_mode('content')} AS mode, reason FROM f""")
def inline_examples(spark, sf_dir):
    """Blocks of articles as candidates, with the reason for those left out; the index counts all blocks."""
    x = F.col("content")
    reason = F.when(~F.col("language").isin("csharp", "cs", "c#"), "language").when(F.trim(x) == "", "empty").when(c.count(x, "{") != c.count(x, "}"), "unbalanced").when(F.contains(x, F.lit("Open(")), "foreign")
    return articles(spark, sf_dir).select("doc_id", F.inline(m.blocks(F.col("md")))).select("doc_id", "block_index", "start_line", x.alias("code"), c.mode(x).alias("mode"), reason.alias("reason"))


@query(f"""WITH b AS ({ORACLES['fenced_blocks']}), n AS (SELECT doc_id, count(*) FILTER (language IN ('csharp', 'cs')) AS inline, count(*) AS blocks FROM b GROUP BY 1)
SELECT source, count(*) AS files, CAST(coalesce(sum(blocks), 0) AS BIGINT) AS blocks, CAST(coalesce(sum(inline), 0) AS BIGINT) AS examples, count(*) FILTER (coalesce(inline, 0) = 0) AS empty_files FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY 1""")
def discovery_stats(spark, sf_dir):
    """What a discovery finds by source, files without an example included."""
    b = m.blocks(F.col("md"))
    d = articles(spark, sf_dir).select("source", F.size(b).alias("n"), F.size(F.filter(b, lambda x: x["language"].isin("csharp", "cs"))).alias("k"))
    return d.groupBy("source").agg(F.count("*").alias("files"), F.sum("n").cast("long").alias("blocks"), F.sum("k").cast("long").alias("examples"), F.count_if(F.col("k") == 0).alias("empty_files"))


REFERENCE = "Document opens files. SaveFormat has Docx and Pdf. Generator makes codes."
REFS = ["Encode.QR", "Encode.Nothing", "Document.Title", "Colors.Red", "Unknown.Thing"]


@query(f"""WITH i AS (SELECT doc_id, {pick_sql(REFS, 'doc_id')} AS ref, CASE doc_id % 3 WHEN 0 THEN 'api_mismatch' ELSE 'style' END AS kind FROM documents)
SELECT doc_id, kind, ref, kind = 'api_mismatch' AND lower(ref) IN ('encode.qr', 'encode.aztec', 'colors.red', 'document.title') AS false_positive FROM i""")
def mismatch_evidence(spark, sf_dir):
    """Reported mismatches that the catalogue disproves, whatever their case, are false."""
    known = spark.createDataFrame([(x,) for x in ("encode.qr", "encode.aztec", "colors.red", "document.title")], "low string").withColumn("there", F.lit(True))
    k = F.col("doc_id")
    i = read(spark, sf_dir, "documents").select("doc_id", F.when(k % 3 == 0, "api_mismatch").otherwise("style").alias("kind"), pick(REFS, k).alias("ref"))
    j = i.withColumn("low", F.lower("ref")).join(F.broadcast(known), "low", "left")
    return j.select("doc_id", "kind", "ref", ((F.col("kind") == "api_mismatch") & F.coalesce("there", F.lit(False))).alias("false_positive"))


@query(f"""SELECT doc_id, CASE WHEN word = '' THEN substr(t, 1, 40) WHEN position(word IN t) = 0 THEN substr(t, 1, 40) ELSE substr(t, greatest(position(word IN t) - 15, 1), 15 + least(position(word IN t) - 1, 15)) END AS context FROM (SELECT doc_id, {quoted(REFERENCE)} AS t, {pick_sql(['Generator', 'Pdf', 'Nothing', ''], 'doc_id')} AS word FROM documents)""")
def targeted_context(spark, sf_dir):
    """The part of a reference around the first hit of what an error misses; its beginning where there is none."""
    word, t = pick(["Generator", "Pdf", "Nothing", ""], F.col("doc_id")), F.lit(REFERENCE)
    at = F.when(word == "", 0).otherwise(F.expr("0") + F.instr(t, word))
    around = F.substring(t, F.greatest(at - 15, F.lit(1)), 15 + F.least(at - 1, F.lit(15)))
    return read(spark, sf_dir, "documents").select("doc_id", F.when(at > 0, around).otherwise(F.substring(t, 1, 40)).alias("context"))


_ALL = "regexp_extract_all(t, '\\b([A-Z][A-Za-z0-9]{3,})\\b', 1)"
_WORDS = f"list_filter({_ALL}, lambda z, i: list_position({_ALL}, z) = i AND z IN ('Document', 'Generator', 'SaveFormat', 'Report', 'Chart', 'Archive'))"


@query(f"""WITH i AS (SELECT doc_id, concat('The ', ({'[' + ', '.join(map(quoted, ['Document', 'Generator', 'Widget', 'Chart'])) + ']'})[CAST(doc_id % 4 AS INTEGER) + 1], ' and SaveFormat or Archive, Report, Chart too') AS t FROM documents), w AS (SELECT doc_id, {_WORDS}[1:4] AS w FROM i)
SELECT doc_id, w AS types, list_filter(w, lambda z, i: list_position(list_transform(w, lambda q: CASE WHEN q IN ('Report', 'Chart') THEN 'views' ELSE q END), CASE WHEN z IN ('Report', 'Chart') THEN 'views' ELSE z END) = i) AS shown FROM w""")
def issue_catalog_context(spark, sf_dir):
    """Types of the catalogue that an issue names, the first four, one of each group of siblings."""
    name = F.element_at(F.array(*map(F.lit, ("Document", "Generator", "Widget", "Chart"))), (F.col("doc_id") % 4 + 1).cast("int"))
    text = F.concat(F.lit("The "), name, F.lit(" and SaveFormat or Archive, Report, Chart too"))
    known = ("Document", "Generator", "SaveFormat", "Report", "Chart", "Archive")
    w = F.slice(F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b([A-Z][A-Za-z0-9]{3,})\b"), F.lit(1))), lambda z: z.isin(*known)), 1, 4)
    group = lambda z: F.when(z.isin("Report", "Chart"), "views").otherwise(z)
    d = read(spark, sf_dir, "documents").select("doc_id", w.alias("types"))
    shown = F.filter("types", lambda z, i: ~F.exists(F.slice("types", F.lit(1), i), lambda q: group(q) == group(z)))
    return d.select("doc_id", "types", shown.alias("shown"))


_PROPS = "regexp_extract_all({0}, '\\.(\\w+)\\s*=\\s*([^;=]+?);', {1})"


@query(f"""WITH s AS (SELECT doc_id, list_transform(range(1, len({_PROPS.format('code', 1)}) + 1), lambda i: concat({_PROPS.format('code', 1)}[i], '=', {_PROPS.format('code', 2)}[i])) AS a, list_transform(range(1, len({_PROPS.format('fixed', 1)}) + 1), lambda i: concat({_PROPS.format('fixed', 1)}[i], '=', {_PROPS.format('fixed', 2)}[i])) AS b FROM {SNIPPETS})
SELECT doc_id, list_sort(list_filter(list_distinct(a), lambda z: NOT list_contains(b, z))) AS before, list_sort(list_filter(list_distinct(b), lambda z: NOT list_contains(a, z))) AS after FROM s""")
def property_changes(spark, sf_dir):
    """Assignments that a fix took away or changed, and those it brought."""
    props = lambda x: F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(r"(\.\w+\s*=\s*[^;=]+?;)"), F.lit(1)), lambda z: F.concat(F.regexp_extract(z, r"\.(\w+)\s*=\s*([^;=]+?);", 1), F.lit("="), F.regexp_extract(z, r"\.(\w+)\s*=\s*([^;=]+?);", 2))))
    a, b = props(F.col("code")), props(F.col("fixed"))
    return snippets(spark, sf_dir).select("doc_id", F.array_sort(F.array_except(a, b)).alias("before"), F.array_sort(F.array_except(b, a)).alias("after"))

