"""Articles: their code blocks, where a block is found again, how it is replaced, and what an article gets wrong."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markdown as m
from ..functions import paths as p
from .base import query
from .code import _BARE, _EX
from .errors import _any
from .samples import MARKDOWN, SNIPPETS, articles, pick, pick_sql, quoted, snippets

_B = _BARE.format
_SIGN = f"sha256(replace({_B('{0}')}, concat(chr(13), chr(10)), chr(10)))"
_LINED = f"l AS (SELECT doc_id, source, md, string_split(md, chr(10)) AS l FROM {MARKDOWN}), f AS (SELECT *, list_filter(range(1, len(l) + 1), lambda i: starts_with(l[i], '```')) AS f FROM l)"
_BLOCKS = f"""{_LINED}, b AS (SELECT *, list_transform(list_filter(range(1, len(f)), lambda k: k % 2 = 1), lambda k: struct_pack(block_index := CAST((k - 1) // 2 AS INTEGER), start_line := CAST(f[k] AS INTEGER), end_line := CAST(f[k + 1] AS INTEGER),
 language := lower({_B('substr(l[f[k]], 4)')}), content := coalesce(array_to_string(l[f[k] + 1:f[k + 1] - 1], chr(10)), ''))) AS b FROM f)"""


@query(f"WITH {_BLOCKS}, u AS (SELECT doc_id, unnest(b) AS x FROM b) SELECT doc_id, x.block_index, x.start_line, x.end_line, x.language, x.content, {_SIGN.format('x.content')} AS signature FROM u")
def fenced_blocks(spark, sf_dir):
    """Every closed fenced block with its place, language, content and signature."""
    return articles(spark, sf_dir).select("doc_id", F.inline(m.blocks(F.col("md"))))


_ABOVE = f"list_filter(range(1, x.start_line), lambda i: {_B('l[i]')} <> '')[-1]"
_STOP = f"coalesce(list_filter(range(1, last + 1), lambda i: {_B('l[i]')} = '' OR starts_with({_B('l[i]')}, '#') OR starts_with({_B('l[i]')}, '```') OR starts_with({_B('l[i]')}, '{{{{%'))[-1], 0)"
_PROSE = f"""{_BLOCKS}, u AS (SELECT doc_id, l, unnest(b) AS x FROM b), v AS (SELECT *, {_ABOVE} AS last FROM u), w AS (SELECT *, {_STOP} AS stop FROM v),
 pr AS (SELECT doc_id, x.block_index AS block_index, {_B(f"ltrim({_B(f'''list_filter(l[1:x.start_line - 1], lambda z: starts_with({_B('z')}, '#'))[-1]''')}, '#')")} AS heading, CAST(stop + 1 AS INTEGER) AS line, x.content AS code,
 {_B("array_to_string(list_transform(l[stop + 1:last], lambda z: rtrim(z)), chr(10))")} AS prose FROM w WHERE last IS NOT NULL)"""


@query(f"WITH {_PROSE} SELECT * FROM pr WHERE prose <> ''")
def prose_pairing(spark, sf_dir):
    """Blocks with the paragraph above them and their heading."""
    return articles(spark, sf_dir).select("doc_id", F.inline(m.paired_prose(F.col("md"))))


TARGETS = ["var x = 1;", "VAR x = 1", "x = 1", 'var d = new Document("report.docx");\nd.Save("step1.docx");\nd.Close();', 'var d = new Document("report.docx");;\n  d.Save("step1.docx");\nd.close()', "missing", ""]
_HEAD = f"list_transform(list_filter(list_transform(string_split({{0}}, chr(10))[1:5], lambda z: {_B('z')}), lambda z: z <> ''), lambda z: rtrim(lower(z), ';'))"


@query(f"""WITH {_BLOCKS}, t AS (SELECT doc_id, b, {pick_sql(TARGETS, 'doc_id')} AS t, CAST(doc_id % 3 AS INTEGER) AS i FROM b),
x AS (SELECT doc_id, i, list_transform(list_filter(b, lambda k: {_SIGN.format('k.content')} = {_SIGN.format('t')}), lambda k: k.block_index) AS e, list_transform(list_filter(b, lambda k: {_HEAD.format('k.content')} = {_HEAD.format('t')} AND len({_HEAD.format('t')}) > 0), lambda k: k.block_index) AS a FROM t)
SELECT doc_id, CASE WHEN list_contains(e, i) THEN i WHEN len(e) = 1 THEN e[1] WHEN len(e) = 0 AND len(a) = 1 THEN a[1] END AS block, NOT list_contains(e, i) AND (len(e) = 1 OR (len(e) = 0 AND len(a) = 1)) AS fallback,
 CASE WHEN list_contains(e, i) THEN NULL WHEN len(e) > 1 THEN concat('duplicate_signature: ', len(e), ' blocks at indices [', array_to_string(e, ', '), ']') WHEN len(e) = 0 AND len(a) > 1 THEN concat('fuzzy_ambiguous: ', len(a), ' blocks at indices [', array_to_string(a, ', '), ']') WHEN len(e) = 0 AND len(a) = 0 THEN 'signature_not_found' END AS reason FROM x""")
def block_target(spark, sf_dir):
    """Where a stored block is now: at its index, else by its signature, else by its first lines; else why it can't be told."""
    t = pick(TARGETS, F.col("doc_id"))
    d = articles(spark, sf_dir).select("doc_id", m.blocks(F.col("md")).alias("b"), t.alias("t"))
    return d.select("doc_id", m.resolved(F.col("b"), (F.col("doc_id") % 3).cast("int"), m.signature(F.col("t")), F.col("t")).alias("r")).select("doc_id", "r.block", "r.fallback", "r.reason")


VERIFIED = ["var x = 1;\n", "Console.WriteLine(2);", "x = 1"]


@query(f"""WITH {_BLOCKS}, t AS (SELECT doc_id, l, b[1] AS x, {pick_sql(VERIFIED, 'doc_id')} AS c FROM b WHERE len(b) > 0), g AS (SELECT *, coalesce(nullif(x.language, ''), 'csharp') AS g FROM t)
SELECT doc_id, CASE WHEN NOT (rtrim(x.content, chr(10)) = rtrim(c, chr(10)) AND x.language = g) THEN array_to_string(list_concat(l[1:x.start_line - 1], [concat('```', g), c, '```'], l[x.end_line + 1:]), chr(10)) END AS updated FROM g""")
def block_replacement(spark, sf_dir):
    """Each article with its first block's code exchanged; null where nothing would change."""
    d = articles(spark, sf_dir).withColumn("b", F.get(m.blocks(F.col("md")), F.lit(0))).where("b is not null")
    return d.select("doc_id", m.replaced(F.col("md"), F.col("b"), pick(VERIFIED, F.col("doc_id")), F.lit("")).alias("updated"))


@query(f"""WITH {_BLOCKS}, t AS (SELECT doc_id, source, unnest(b) AS x FROM b)
SELECT source, count(DISTINCT doc_id) AS files, count(*) AS blocks, CAST(sum(CASE WHEN x.language IN ('csharp', 'cs', 'c#') THEN 1 ELSE 0 END) AS BIGINT) AS code_blocks, list_sort(list(DISTINCT x.language)) AS languages FROM t GROUP BY 1""")
def update_totals(spark, sf_dir):
    """What an update of all files touches, by source. Languages are few; they are made distinct before they are gathered."""
    b = articles(spark, sf_dir).select("doc_id", "source", F.inline(m.blocks(F.col("md"))))
    n = b.groupBy("source").agg(F.countDistinct("doc_id").alias("files"), F.count("*").alias("blocks"), F.count_if(F.col("language").isin("csharp", "cs", "c#")).alias("code_blocks"))
    return n.join(b.select("source", "language").distinct().groupBy("source").agg(F.sort_array(F.collect_list("language")).alias("languages")), "source")


_HELD = "len(list_filter(f, lambda j: j < i)) % 2 = 1"


def _outside(patterns) -> str:
    return f"list_filter(range(1, len(l) + 1), lambda i: NOT ({_HELD}) AND NOT starts_with(l[i], '```') AND {_any('l[i]', patterns)})"


@query(f"WITH {_LINED}, o AS (SELECT doc_id, {_outside(m.CODE_LINES)} AS o FROM f) SELECT doc_id, list_transform(list_filter(o, lambda i: NOT list_contains(o, i - 1)), lambda i: CAST(i AS INTEGER)) AS lines FROM o")
def broken_fences(spark, sf_dir):
    """First line of each run of code outside the fences."""
    return articles(spark, sf_dir).select("doc_id", m.broken_fences(F.col("md")).alias("lines"))


_ENDS = "CASE WHEN len(f) % 2 = 1 THEN [CASE WHEN ends_with(md, chr(10)) OR md = '' THEN len(l) - 1 ELSE len(l) END] ELSE [] END"


@query(f"WITH {_LINED} SELECT doc_id, list_transform(list_concat({_outside(m.OUTSIDE)}, {_ENDS}), lambda i: CAST(i AS INTEGER)) AS lines FROM f")
def fence_validation(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", m.fence_warnings(F.col("md")).alias("lines"))


_FULL = f"list_filter(string_split(x.content, chr(10)), lambda z: {_B('z')} <> '')"
_LOOSE = f"len({_FULL}) >= 3 AND len(list_filter({_FULL}, lambda z: regexp_matches(z, {quoted(m.TOKENS)}))) / len({_FULL}) < 0.1"


@query(f"WITH {_BLOCKS}, u AS (SELECT doc_id, unnest(b) AS x FROM b) SELECT doc_id, x.start_line AS line, x.language, {_LOOSE} AS prose FROM u")
def prose_in_fence(spark, sf_dir):
    """Whether a block holds prose rather than code."""
    return articles(spark, sf_dir).select("doc_id", F.inline(m.blocks(F.col("md")))).select("doc_id", F.col("start_line").alias("line"), "language", m.prose(F.col("content")).alias("prose"))


def _names(x: str, pattern: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all({x}, {quoted(pattern)}, 1)))"


_CHAIN = f"""{_BLOCKS}, ss AS (SELECT doc_id, list_transform(b, lambda x: struct_pack(line := x.start_line, s := {_names('x.content', m.SAVED)}, o := {_names('x.content', m.LOADED)}, keep := CAST([] AS VARCHAR[]), hit := false, odd := CAST([] AS VARCHAR[]))) AS s FROM b WHERE len(b) > 0),
 st AS (SELECT doc_id, unnest(list_transform(range(1, len(s) + 1), lambda n: list_reduce(list_concat([struct_pack(line := CAST(0 AS INTEGER), s := CAST([] AS VARCHAR[]), o := CAST([] AS VARCHAR[]), keep := CAST([] AS VARCHAR[]), hit := false, odd := CAST([] AS VARCHAR[]))], s[1:n]),
 lambda a, x: struct_pack(line := x.line, s := a.keep, o := x.o, keep := CASE WHEN len(x.s) > 0 THEN x.s WHEN len(x.o) > 0 THEN CAST([] AS VARCHAR[]) ELSE a.keep END, hit := len(a.keep) > 0 AND len({_EX.format('x.o', 'a.keep')}) > 0, odd := {_EX.format('x.o', 'a.keep')})))) AS r FROM ss)"""


@query(f"WITH {_CHAIN} SELECT doc_id, r.line AS line, r.odd AS unexpected, r.s AS saved FROM st WHERE r.hit")
def filename_chain(spark, sf_dir):
    """Blocks that load another file than the one before them saved."""
    return articles(spark, sf_dir).select("doc_id", F.inline(m.chain_breaks(m.blocks(F.col("md")))))


_SECTION = f"""ln AS (SELECT doc_id, unnest(string_split(md, chr(10))) AS z, generate_subscripts(string_split(md, chr(10)), 1) AS i FROM {MARKDOWN}), se AS (SELECT *, sum(CASE WHEN starts_with(z, '#') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM ln),
 fe AS (SELECT *, starts_with(z, '```') AS fence, sum(CASE WHEN starts_with(z, '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, s ORDER BY i) AS n, sum(CASE WHEN starts_with(z, '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, s) AS total FROM se),
 co AS (SELECT doc_id, s, {_names("string_agg(z, chr(10) ORDER BY i) FILTER (WHERE NOT fence AND n % 2 = 1 AND n < total)", m.NAME)} AS code FROM fe GROUP BY 1, 2),
 mi AS (SELECT fe.doc_id, CAST(i AS INTEGER) AS line, list_sort(list_filter({_names('z', m.NAME)}, lambda q: NOT list_contains(code, q))) AS prose, code FROM fe JOIN co USING (doc_id, s) WHERE NOT fence AND n % 2 = 0 AND len(code) > 0)"""


@query(f"WITH {_SECTION} SELECT doc_id, line, prose, code FROM mi WHERE len(prose) > 0")
def section_filenames(spark, sf_dir):
    """Lines of prose that name files which the code of their section doesn't."""
    return articles(spark, sf_dir).select("doc_id", F.inline(m.name_mismatches(F.col("md"))))


_QUOTED = r"(?i)[\"']([^\"']+\.(?:docx|doc|pdf|odt|ott|rtf|txt|pfx))[\"']"


@query(f"WITH {_PROSE}, n AS (SELECT doc_id, line, {_names('prose', _QUOTED)} AS pn, {_names('code', _QUOTED)} AS cn FROM pr WHERE prose <> '') SELECT doc_id, line, list_filter(pn, lambda z: NOT list_contains(cn, z)) AS missing, cn AS code FROM n WHERE len(cn) > 0 AND len(list_filter(pn, lambda z: NOT list_contains(cn, z))) > 0")
def prose_filenames(spark, sf_dir):
    """Names in the paragraph above a block that the block lacks, where it names any."""
    s = articles(spark, sf_dir).select("doc_id", F.inline(m.paired_prose(F.col("md"))))
    n = s.select("doc_id", "line", m.names(F.col("prose"), _QUOTED).alias("p"), m.names(F.col("code"), _QUOTED).alias("code"))
    return n.select("doc_id", "line", F.array_sort(F.array_except("p", "code")).alias("missing"), "code").where((F.size("code") > 0) & (F.size("missing") > 0))


@query(f"""WITH {_CHAIN}, {_SECTION.replace('mi AS', 'mi AS')}, o AS (SELECT doc_id, {_outside(m.CODE_LINES)} AS o FROM f), a AS (
 SELECT doc_id, unnest(list_filter(o, lambda i: NOT list_contains(o, i - 1))) AS line, 'broken_fence' AS issue FROM o UNION ALL SELECT doc_id, line, 'filename_mismatch' FROM mi WHERE len(prose) > 0 UNION ALL SELECT doc_id, r.line, 'cross_step_filename_mismatch' FROM st WHERE r.hit)
SELECT doc_id, CAST(line AS INTEGER) AS line, issue FROM a""")
def article_check(spark, sf_dir):
    """All structural issues of an article, found in one pass over its row."""
    md = F.col("md")
    issue = lambda x, kind: F.transform(x, lambda q: F.struct((q if kind == "broken_fence" else q["line"]).alias("line"), F.lit(kind).alias("issue")))
    found = F.concat(issue(m.broken_fences(md), "broken_fence"), issue(m.name_mismatches(md), "filename_mismatch"), issue(m.chain_breaks(m.blocks(md)), "cross_step_filename_mismatch"))
    return articles(spark, sf_dir).select("doc_id", F.inline(found))


@query(f"""WITH {_PROSE}, u2 AS (SELECT doc_id, unnest(b) AS x FROM b), w1 AS (SELECT doc_id, unnest(list_concat({_outside(m.OUTSIDE)}, {_ENDS})) AS line FROM f),
n AS (SELECT doc_id, {_names('prose', _QUOTED)} AS pn, {_names('code', _QUOTED)} AS cn FROM pr WHERE prose <> ''),
a AS (SELECT doc_id, 'fence_warning' AS k FROM w1 UNION ALL SELECT doc_id, 'filename_mismatch' FROM n WHERE len(cn) > 0 AND len({_EX.format('pn', 'cn')}) > 0 UNION ALL SELECT doc_id, 'prose_inside_fence' FROM u2 WHERE x.language IN ('csharp', 'cs', 'c#') AND {_LOOSE}),
g AS (SELECT doc_id, count(*) AS n, list_sort(list(k)) AS kinds FROM a GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS warnings, coalesce(kinds, []) AS kinds FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id""")
def file_report(spark, sf_dir):
    """Each file's warnings, files without any included."""
    md = F.col("md")
    miss = F.filter(m.paired_prose(md), lambda s: (F.size(m.names(s["code"], _QUOTED)) > 0) & (F.size(F.array_except(m.names(s["prose"], _QUOTED), m.names(s["code"], _QUOTED))) > 0))
    loose = F.filter(m.blocks(md), lambda b: b["language"].isin("csharp", "cs", "c#") & m.prose(b["content"]))
    kinds = F.array_sort(F.concat(F.transform(m.fence_warnings(md), lambda _: F.lit("fence_warning")), F.transform(miss, lambda _: F.lit("filename_mismatch")), F.transform(loose, lambda _: F.lit("prose_inside_fence"))))
    return articles(spark, sf_dir).select("doc_id", kinds.alias("kinds")).select("doc_id", F.size("kinds").cast("long").alias("warnings"), "kinds")


_RB = _B("x.z")


@query(f"""WITH l AS (SELECT doc_id, md, CASE WHEN ends_with(md, chr(10)) OR md = '' THEN string_split(md, chr(10))[:-2] ELSE string_split(md, chr(10)) END AS l, ends_with(md, chr(10)) OR md = '' AS last FROM {MARKDOWN}),
r AS (SELECT doc_id, last, l, list_reduce(list_concat([struct_pack(z := '', o := false, n := 0, t := CAST([] AS VARCHAR[]))], list_transform(l, lambda z: struct_pack(z := z, o := false, n := 0, t := CAST([] AS VARCHAR[])))),
 lambda s, x: struct_pack(z := x.z, o := CASE WHEN starts_with({_RB}, '```') THEN NOT s.o WHEN s.o AND starts_with({_RB}, '#') THEN false ELSE s.o END, n := s.n + CASE WHEN s.o AND starts_with({_RB}, '#') THEN 1 ELSE 0 END, t := list_concat(s.t, CASE WHEN s.o AND starts_with({_RB}, '#') THEN ['```', x.z] ELSE [x.z] END))) AS r FROM l)
SELECT doc_id, concat(coalesce(array_to_string(r.t, chr(10)), ''), CASE WHEN last AND len(r.t) > 0 THEN chr(10) ELSE '' END, CASE WHEN r.o THEN concat('```', chr(10)) ELSE '' END) AS text, r.n + CASE WHEN r.o THEN 1 ELSE 0 END AS repairs FROM r""")
def fence_repair(spark, sf_dir):
    """Articles with the fences closed that were left open, and how many that took."""
    return articles(spark, sf_dir).select("doc_id", m.repaired(F.col("md")).alias("r")).select("doc_id", "r.text", "r.repairs")


@query(f"SELECT doc_id, replace(regexp_replace(replace(md, '](mailto:', chr(1)), '\\[([^\\]]+)\\]\\([^)]*\\)', '\\1', 'g'), chr(1), '](mailto:') AS plain FROM {MARKDOWN}")
def prose_links(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", m.strip_links(F.col("md")).alias("plain"))


def _role(x: str, op: str | None = None) -> str:
    words = f"string_split_regex(regexp_replace(lower(string_split(replace({x}, chr(92), '/'), '/')[-1]), '(.)\\.[^.]*$', '\\1'), '[^a-z0-9]+')"
    ladder = " ".join(f"WHEN len(list_filter({words}, lambda w: w IN ({', '.join(map(quoted, h))}))) > 0 THEN {quoted(k)}" for k, h in p.ROLES)
    return f"CASE {f'WHEN {op} = {chr(39)}write{chr(39)} THEN {chr(39)}output{chr(39)}' if op else ''} {ladder} {f'WHEN {op} = {chr(39)}read{chr(39)} THEN {chr(39)}input{chr(39)}' if op else ''} ELSE 'unknown' END"


def _found(x: str) -> str:
    return f"""(SELECT doc_id, i, pos, literal, op, {_role('literal', 'op')} AS role FROM (SELECT doc_id, i, op, unnest(a) AS literal, generate_subscripts(a, 1) AS pos FROM (SELECT doc_id, i, CASE WHEN {_any('z', p.WRITES, 'i')} THEN 'write' WHEN {_any('z', p.READS, 'i')} THEN 'read' ELSE 'unknown' END AS op,
 list_filter(list_transform(regexp_extract_all(z, '@?"([^"\\r\\n]+?\\.[A-Za-z0-9]{{1,8}})"', 1), lambda q: trim(q)), lambda q: NOT contains(q, '://')) AS a FROM (SELECT doc_id, unnest(string_split({x}, chr(10))) AS z, generate_subscripts(string_split({x}, chr(10)), 1) AS i FROM {SNIPPETS}))))"""


@query(f"SELECT doc_id, literal, role, op AS operation, CAST(i AS INTEGER) AS line FROM {_found('code')}")
def path_occurrences(spark, sf_dir):
    """File names in strings, with their role and whether the line reads or writes."""
    return snippets(spark, sf_dir).select("doc_id", F.inline(p.occurrences(F.col("code"))))


@query(f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY doc_id, op ORDER BY i, pos) AS n FROM {_found('code')}), b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, op ORDER BY i, pos) AS n FROM {_found('fixed')}),
j AS (SELECT a.doc_id, a.literal AS before, b.literal AS after, a.op AS operation, {_role('a.literal')} AS ra, {_role('b.literal')} AS rb, a.role AS ea, b.role AS eb FROM a JOIN b ON a.doc_id = b.doc_id AND a.op = b.op AND a.n = b.n WHERE a.literal <> b.literal),
k AS (SELECT *, CASE WHEN (CASE WHEN ra <> 'unknown' THEN ra ELSE ea END = 'output') <> (CASE WHEN rb <> 'unknown' THEN rb ELSE eb END = 'output') THEN 'crosses' WHEN operation = 'write' AND rb IN ('input', 'template', 'fixture') THEN 'source_like' END AS issue FROM j)
SELECT doc_id, before, after, operation, issue FROM k WHERE issue IS NOT NULL""")
def path_role_drift(spark, sf_dir):
    """File names whose role a fix turned from output to source or back: the n-th of each operation is compared."""
    return snippets(spark, sf_dir).select("doc_id", F.inline(p.role_issues(p.occurrences(F.col("code")), p.occurrences(F.col("fixed")))))


_STRINGS = "regexp_extract_all(code, '@\"((?:[^\"]|\"\")*)\"|\\$?\"([^\"\\\\]*(?:\\\\.[^\"\\\\]*)*)\"', 0)"


@query(f"""WITH s AS (SELECT doc_id, flatten(list_transform({_STRINGS}, lambda s: string_split(regexp_replace(regexp_replace(s, '^[@$]?"|"$', '', 'g'), '\\\\+', '/', 'g'), '/'))) AS s FROM {SNIPPETS}),
t AS (SELECT doc_id, list_filter(list_transform(s, lambda q: trim(regexp_replace(q, '\\{{[^}}]*\\}}', '', 'g'))), lambda q: regexp_matches(lower(q), '\\.(?:{'|'.join(p.EXTENSIONS)})$')) AS t FROM s) SELECT doc_id, list_filter(t, lambda z, i: list_position(t, z) = i) AS files FROM t""")
def file_literals(spark, sf_dir):
    return snippets(spark, sf_dir).select("doc_id", p.file_literals(F.col("code")).alias("files"))


_NORM = f"array_to_string(list_filter(list_transform(string_split(x.content, chr(10)), lambda z: {_B('z')}), lambda z: z <> ''), chr(10))"


@query(f"""WITH {_BLOCKS}, u AS (SELECT doc_id, unnest(b) AS x FROM b), h AS (SELECT doc_id, x.start_line AS line, sha256({_NORM}) AS h FROM u WHERE {_NORM} <> ''), n AS (SELECT h, count(*) AS n FROM h GROUP BY 1 HAVING count(*) >= 2)
SELECT doc_id, line, h AS digest, n FROM h JOIN n USING (h)""")
def duplicate_blocks(spark, sf_dir):
    """Blocks whose stripped lines stand in two places or more. Counts are aggregated first, so that a frequent block is no window."""
    from ..functions.code import bare

    norm = F.array_join(F.filter(F.transform(F.split("content", "\n"), bare), lambda z: z != ""), "\n")
    h = articles(spark, sf_dir).select("doc_id", F.inline(m.blocks(F.col("md")))).select("doc_id", F.col("start_line").alias("line"), norm.alias("norm")).where("norm <> ''").select("doc_id", "line", F.sha2("norm", 256).alias("digest"))
    return h.join(h.groupBy("digest").agg(F.count("*").alias("n")).where("n >= 2"), "digest").select("doc_id", "line", "digest", "n")
