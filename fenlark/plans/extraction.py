"""What is taken out of files: marked regions, method bodies, front matter, shortcodes, topics and surroundings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markdown as m
from ..functions.code import bare, count
from .base import query, read
from .code import _BARE
from .markdown import _BLOCKS
from .samples import CODE, articles, pick, pick_sql, quoted

_B = _BARE.format

FILES = [
    "// ExStart:Load\nvar doc = new Document();\ndoc.Open();\n// ExEnd:Load\nnothing\n  // ExStart:Save\n// only a comment\ndoc.Save();\n// ExEnd:Save\n",
    "class A\n{\n    public static void Run()\n    {\n        if (x)\n        {\n            Go();\n        }\n    }\n    void Other() { }\n}",
    "public static void Run ( ) { }\n",
    "   \n",
    "plain text file\nwith two lines",
    "// ExStart:Outer\na = 1;\nb = 2;\n// ExEnd:Inner\nc = 3;\n// ExEnd:Outer",
    "public static void Run() { var s = 1; while (s < 2) { s++; } Done(); } // tail }",
]
PATHS = ["docs/how-to-open_files.md", "blog/2024/index.md", "README.md", "content/blog.site.net/words/Convert-PDF.md", "content/docs.site.net/_index.md", "kb.site.net/Answers/how to print.txt", "src/Examples/Load.cs"]


def _files(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", pick(FILES, F.col("doc_id")).alias("text"), pick(PATHS, F.floor(F.col("doc_id") / len(FILES))).alias("path"))


_FILES = f"(SELECT doc_id, {pick_sql(FILES, 'doc_id')} AS text, {pick_sql(PATHS, f'doc_id // {len(FILES)}')} AS path FROM documents)"
MARKED = r"(?s)//\s*ExStart:(\S+)\s*\n(.*?)//\s*ExEnd:\1"


@query(f"""
WITH RECURSIVE s AS (SELECT doc_id, text, regexp_extract_all(text, '//\\s*ExStart:\\S+\\s*\\n') AS o FROM {_FILES}),
r(doc_id, rest, done, n, tag, body, line) AS (SELECT doc_id, text, CAST(0 AS BIGINT), 0, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT) FROM s UNION ALL
 SELECT doc_id, CASE WHEN hit THEN substr(tail, position(close IN tail) + length(close)) ELSE tail END, before + CASE WHEN hit THEN len(string_split(substr(rest, 1, length(rest) - length(substr(tail, position(close IN tail) + length(close)))), chr(10))) - 1 ELSE len(string_split(substr(rest, 1, length(rest) - length(tail)), chr(10))) - 1 END, n + 1,
  CASE WHEN hit THEN tag END, CASE WHEN hit THEN substr(tail, 1, position(close IN tail) - 1) END, CASE WHEN hit THEN before + len(string_split(substr(rest, 1, position(head IN rest)), chr(10))) END FROM
 (SELECT *, regexp_extract(tail, concat('//\\s*ExEnd:', tag)) AS close, regexp_matches(tail, concat('//\\s*ExEnd:', tag)) AS hit FROM (SELECT doc_id, rest, done AS before, n, regexp_extract(rest, '//\\s*ExStart:\\S+\\s*\\n') AS head, regexp_extract(rest, '//\\s*ExStart:(\\S+)\\s*\\n', 1) AS tag,
  substr(rest, position(regexp_extract(rest, '//\\s*ExStart:\\S+\\s*\\n') IN rest) + length(regexp_extract(rest, '//\\s*ExStart:\\S+\\s*\\n'))) AS tail FROM r WHERE regexp_matches(rest, '//\\s*ExStart:\\S+\\s*\\n') AND n < 50)))
SELECT doc_id, tag, regexp_replace(body, '\\s+$', '') AS code, CAST(line AS INTEGER) AS line FROM r WHERE tag IS NOT NULL AND len(list_filter(string_split(regexp_replace(body, '\\s+$', ''), chr(10)), lambda z: {_B('z')} <> '' AND NOT starts_with({_B('z')}, '//'))) >= 2""")
def marked_regions(spark, sf_dir):
    """Code between an opening marker and the closing one of the same name, with two lines of code at least, and the line it begins at."""
    d = _files(spark, sf_dir)
    found = F.transform(F.regexp_extract_all("text", F.lit(MARKED), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, MARKED, 1).alias("tag"), F.rtrim(F.regexp_extract(x, MARKED, 2), F.lit(" \n\t\r")).alias("code"), x.alias("all")))
    real = F.filter(found, lambda x: F.size(F.filter(F.split(x["code"], "\n"), lambda z: (bare(z) != "") & ~bare(z).startswith("//"))) >= 2)
    rows = d.select("doc_id", "text", F.inline(real))
    before = F.expr("substr(text, 1, instr(text, `all`) - 1)")
    return rows.select("doc_id", "tag", "code", (count(before, "\n") + 1).alias("line"))


@query(f"""
WITH x AS (SELECT doc_id, text, regexp_extract(text, 'public\\s+static\\s+void\\s+Run\\s*\\(\\s*\\)\\s*\\{{') AS head FROM {_FILES}), y AS (SELECT *, substr(text, position(head IN text) + length(head)) AS rest FROM x),
c AS (SELECT doc_id, unnest(string_split(rest, '')) AS ch, generate_subscripts(string_split(rest, ''), 1) AS i FROM y WHERE head <> ''),
d AS (SELECT doc_id, i, 1 + sum(CASE ch WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS depth FROM c), e AS (SELECT doc_id, min(i) AS e FROM d WHERE depth = 0 GROUP BY 1)
SELECT y.doc_id, CASE WHEN head = '' THEN 'whole_file' ELSE 'run_method' END AS strategy, CASE WHEN head = '' THEN text ELSE {_B('substr(rest, 1, e - 1)')} END AS code FROM y LEFT JOIN e ON e.doc_id = y.doc_id WHERE CASE WHEN head = '' THEN {_B('text')} ELSE {_B('substr(rest, 1, e - 1)')} END <> ''""")
def method_bodies(spark, sf_dir):
    """The body of Run() up to its matching brace; the whole file where there is none. Empty ones drop."""
    head = r"public\s+static\s+void\s+Run\s*\(\s*\)\s*\{"
    d = _files(spark, sf_dir).withColumn("rest", F.get(F.split("text", head, 2), F.lit(1)))
    # parts after each closing brace: the body ends at the first one where as many have closed as opened
    parts = F.split("rest", r"\}")
    zero = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"), F.lit(-1).alias("end"))

    def step(s, x):
        depth = s["depth"] + count(x, "{") - 1
        return F.struct(depth.alias("depth"), (s["n"] + 1).alias("n"), F.when((s["end"] < 0) & (depth == 0), s["n"] + 1).otherwise(s["end"]).alias("end"))

    end = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), zero, step, lambda s: s["end"])
    body = bare(F.array_join(F.slice(parts, F.lit(1), F.greatest(end, F.lit(0))), "}"))
    code = F.when(F.col("rest").isNull(), F.col("text")).otherwise(body)
    return d.select("doc_id", F.when(F.col("rest").isNull(), "whole_file").otherwise("run_method").alias("strategy"), code.alias("code")).where(bare(F.col("code")) != "")


FRONT = [
    '---\ntitle: Open a file\ndescription: How files are opened\nstep1: First\nstep2: Second\nstep4: Never\n---\n# Other\ntext',
    "---\nauthor: none\n---\n# Real title\n\nFirst line of prose.\n```\ncode line\nSecond line.\nThird line.",
    "# Only a heading",
    "no heading at all\nprose",
    '---\ntitle: "Quoted: title"\nstep1: One\n---\n',
    "---\nnever closed\n# T\nwords here",
]


@query(f"""
WITH d AS (SELECT doc_id, {pick_sql(FRONT, 'doc_id')} AS t FROM documents), b AS (SELECT *, CASE WHEN starts_with(t, '---') THEN regexp_extract(t, '(?s)^---(.*?)\\n---', 1) ELSE '' END AS b FROM d),
v AS (SELECT *, nullif(trim(regexp_extract(b, '(?m)^title: *(.*)$', 1), '"'), '') AS title, nullif(trim(regexp_extract(b, '(?m)^description: *(.*)$', 1), '"'), '') AS about,
 list_transform(range(1, 11), lambda i: nullif(regexp_extract(b, concat('(?m)^step', i, ': *(.*)$'), 1), '')) AS st FROM b),
s AS (SELECT * FROM (SELECT doc_id, t, title, about, CASE WHEN len(list_filter(st, lambda z: z IS NULL)) = 0 THEN st ELSE st[1:list_min(list_filter(range(1, 11), lambda i: st[i] IS NULL)) - 1] END AS st FROM v)),
y AS (SELECT doc_id, t, concat_ws(chr(10), 'Title: ' || title, 'Summary: ' || substr(about, 1, 300), CASE WHEN len(st) > 0 THEN 'Steps: ' || array_to_string(st, '; ') END) AS y FROM s),
l AS (SELECT doc_id, y, list_transform(string_split(t, chr(10)), lambda z: trim(z)) AS l FROM y), h AS (SELECT *, list_filter(range(1, len(l) + 1), lambda i: starts_with(l[i], '# '))[1] AS h FROM l),
p AS (SELECT doc_id, y, trim(substr(l[h], 3)) AS title, list_filter(l[h + 1:], lambda z: z <> '' AND NOT starts_with(z, '#') AND NOT starts_with(z, '```') AND NOT starts_with(z, '---'))[1:2] AS p FROM h)
SELECT doc_id, nullif(CASE WHEN y <> '' THEN substr(y, 1, 800) ELSE substr(concat_ws(chr(10), 'Title: ' || title, CASE WHEN len(p) > 0 THEN 'Context: ' || substr(array_to_string(p, ' '), 1, 400) END), 1, 600) END, '') AS intent FROM p""")
def front_matter(spark, sf_dir):
    """What an article is about: title, description and steps of its front matter up to the first gap; else its
    heading and the first two lines of prose. Front matter is read as single-line values."""
    t = pick(FRONT, F.col("doc_id"))
    block = F.when(t.startswith("---"), F.regexp_extract(t, r"(?s)^---(.*?)\n---", 1)).otherwise("")
    value = lambda k: F.nullif(F.btrim(F.regexp_extract(block, rf"(?m)^{k}: *(.*)$", 1), F.lit('"')), F.lit(""))
    steps = F.array(*(value(f"step{i}") for i in range(1, 11)))
    gap = F.coalesce(F.array_min(F.transform(steps, lambda z, i: F.when(z.isNull(), i))), F.lit(10))
    some = F.slice(steps, F.lit(1), gap)
    told = F.concat_ws("\n", F.concat(F.lit("Title: "), value("title")), F.concat(F.lit("Summary: "), F.substring(value("description"), 1, 300)), F.when(gap > 0, F.concat(F.lit("Steps: "), F.array_join(some, "; "))))
    rows = F.transform(F.split(t, "\n"), lambda z: F.trim(z))
    head = F.array_min(F.transform(rows, lambda z, i: F.when(z.startswith("# "), i)))
    prose = F.slice(F.filter(F.slice(rows, head + 2, F.size(rows)), lambda z: (z != "") & ~z.rlike("^(?:#|```|---)")), 1, 2)
    other = F.concat_ws("\n", F.concat(F.lit("Title: "), F.trim(F.substring(F.get(rows, head), F.lit(3), F.length(t)))), F.when(F.size(prose) > 0, F.concat(F.lit("Context: "), F.substring(F.array_join(prose, " "), 1, 400))))
    intent = F.when(told != "", F.substring(told, 1, 800)).otherwise(F.substring(other, 1, 600))
    return read(spark, sf_dir, "documents").select("doc_id", F.nullif(intent, F.lit("")).alias("intent"))


GISTS = ['See {{< gist alice abc123 "Load.cs" >}} and {{< gist bob 77ff >}}.\n<script src="https://gist.host/carol/99aa.js?file=Run.cs"></script>', "{{< gist mallory 0001 >}}", "nothing", "{{< gist alice abc123 >}} {{< gist alice abc124 x.cs >}}\n\n{{< gist bob 5 >}}"]
SHORTCODE, SCRIPT = r"\{\{<\s*gist\s+(\S+)\s+(\w+)(?:\s+\"?([^\">\s]+)\"?)?\s*>\}\}", r"<script\s+src=\"https://gist\.host/(\w+)/(\w+)\.js(?:\?file=([^\"]+))?\""


@query(f"""
WITH l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS z, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM (SELECT doc_id, {pick_sql(GISTS, 'doc_id')} AS t FROM documents)),
s AS (SELECT doc_id, i, 'shortcode' AS kind, unnest(regexp_extract_all(z, {quoted(SHORTCODE)})) AS g, {quoted(SHORTCODE)} AS p FROM l UNION ALL SELECT doc_id, i, 'script', unnest(regexp_extract_all(z, {quoted(SCRIPT)})), {quoted(SCRIPT)} FROM l),
o AS (SELECT doc_id, CAST(i AS INTEGER) AS line, kind, CASE kind WHEN 'shortcode' THEN regexp_extract(g, {quoted(SHORTCODE)}, 1) ELSE regexp_extract(g, {quoted(SCRIPT)}, 1) END AS owner, CASE kind WHEN 'shortcode' THEN regexp_extract(g, {quoted(SHORTCODE)}, 2) ELSE regexp_extract(g, {quoted(SCRIPT)}, 2) END AS gist,
 CASE kind WHEN 'shortcode' THEN regexp_extract(g, {quoted(SHORTCODE)}, 3) ELSE regexp_extract(g, {quoted(SCRIPT)}, 3) END AS file FROM s)
SELECT *, substr(sha256(concat(doc_id, ':', owner, '/', gist, '/', file)), 1, 16) AS id FROM o WHERE owner NOT IN ('mallory') AND owner IN ('alice', 'bob', 'carol')""")
def gist_references(spark, sf_dir):
    """Shortcodes and scripts that refer to shared files, by line; blocked owners go first, then those not on the list."""
    t = pick(GISTS, F.col("doc_id"))
    group = lambda z, i, p: F.regexp_extract(z, p, i)

    def refs(z, i):
        def one(pattern, kind):
            return F.transform(F.regexp_extract_all(z, F.lit(pattern), F.lit(0)), lambda g: F.struct((i + 1).alias("line"), F.lit(kind).alias("kind"), group(g, 1, pattern).alias("owner"), group(g, 2, pattern).alias("gist"), group(g, 3, pattern).alias("file")))

        return F.concat(one(SHORTCODE, "shortcode"), one(SCRIPT, "script"))

    d = read(spark, sf_dir, "documents").select("doc_id", F.inline(F.flatten(F.transform(F.split(t, "\n"), refs))))
    name = F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.concat_ws("/", "owner", "gist", "file"))
    return d.where(~F.col("owner").isin("mallory") & F.col("owner").isin("alice", "bob", "carol")).withColumn("id", F.substring(F.sha2(name, 256), 1, 16))


@query(f"""SELECT doc_id, concat(substr(t, 1, position(g IN t) - 1), concat('```csharp', chr(10), 'var x = 1;', chr(10), '```'), substr(t, position(g IN t) + length(g))) AS inlined FROM (SELECT doc_id, t, regexp_extract(t, {quoted(SHORTCODE)}) AS g FROM (SELECT doc_id, {pick_sql(GISTS, 'doc_id')} AS t FROM documents)) WHERE g <> ''""")
def gist_to_inline(spark, sf_dir):
    """Articles with their first shortcode exchanged for a fenced block."""
    d = read(spark, sf_dir, "documents").select("doc_id", pick(GISTS, F.col("doc_id")).alias("t")).withColumn("g", F.regexp_extract("t", SHORTCODE, 0)).where("g <> ''")
    return d.select("doc_id", F.expr("concat(substr(t, 1, instr(t, g) - 1), '```csharp\\nvar x = 1;\\n```', substr(t, instr(t, g) + length(g)))").alias("inlined"))


ROOTS = ["content/blog.site.net/words", "content/docs.site.net", "kb.site.net"]


@query(f"""
WITH p AS (SELECT doc_id, path, string_split(path, '/') AS s FROM {_FILES}), t AS (SELECT *, regexp_replace(s[-1], '(.)\\.[^.]*$', '\\1') AS stem FROM p),
u AS (SELECT *, CASE WHEN lower(stem) IN ('index', '_index', 'readme') AND len(s) > 1 THEN s[-2] ELSE stem END AS name FROM t), v AS (SELECT *, replace(replace(name, '-', ' '), '_', ' ') AS topic FROM u)
SELECT doc_id, path, trim(CASE WHEN starts_with(lower(topic), 'how to ') THEN substr(topic, 8) ELSE topic END) AS topic,
 coalesce(CASE {' '.join(f"WHEN starts_with(lower(path), {quoted(r + '/')}) OR lower(path) = {quoted(r)} THEN {quoted([x for x in r.split('/')[::-1] if '.' in x][0].split('.')[0])}" for r in ROOTS)} END, '') AS content_type FROM v""")
def topic_from_path(spark, sf_dir):
    """A readable topic (an index file's is its folder's) and, by content root, what kind of content a path holds."""
    parts = F.split("path", "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"(?<=.)\.[^.]*$", "")
    name = F.when(F.lower(stem).isin("index", "_index", "readme") & (F.size(parts) > 1), F.try_element_at(parts, F.lit(-2))).otherwise(stem)
    topic = F.translate(name, "-_", "  ")
    topic = F.trim(F.when(F.lower(topic).startswith("how to "), F.substring(topic, F.lit(8), F.length(topic))).otherwise(topic))
    low, kind = F.lower("path"), F.lit("")
    for r in reversed(ROOTS):
        label = next(x for x in r.split("/")[::-1] if "." in x).split(".")[0]
        kind = F.when(low.startswith(r + "/") | (low == r), label).otherwise(kind)
    return _files(spark, sf_dir).select("doc_id", "path", topic.alias("topic"), kind.alias("content_type"))


_W = f"list_transform(l[greatest(x.start_line - 20, 1):x.start_line - 1], lambda z: {_B('z')})"


@query(f"""WITH {_BLOCKS}, u AS (SELECT doc_id, l, unnest(b) AS x FROM b), w AS (SELECT doc_id, x.block_index AS block_index, {_W} AS w FROM u), h AS (SELECT *, list_filter(w, lambda z: starts_with(z, '#'))[-1] AS h, coalesce(list_max(list_filter(range(1, len(w) + 1), lambda i: starts_with(w[i], '#') OR starts_with(w[i], '```'))), 0) AS stop FROM w),
p AS (SELECT doc_id, block_index, coalesce({_B("ltrim(h, '#')")}, '') AS heading, list_filter(string_split_regex(array_to_string(w[stop + 1:], chr(10)), '\\n\\n+'), lambda q: {_B('q')} <> '') AS p FROM h),
t AS (SELECT *, array_to_string(list_transform(p[greatest(len(p) - 1, 1):], lambda q: replace({_B('q')}, chr(10), ' ')), concat(chr(10), chr(10))) AS d FROM p)
SELECT doc_id, block_index, heading, CASE WHEN length(d) < 10 THEN '' ELSE coalesce(d, '') END AS context FROM t""")
def context_window(spark, sf_dir):
    """Heading and up to two paragraphs in the 20 lines above each block, up to a heading or fence; under 10 characters none."""
    md = F.col("md")

    def around(rows, at):
        w = F.transform(F.slice(rows, F.greatest(at - 20, F.lit(0)) + 1, F.least(at, F.lit(20))), bare)
        stop = F.coalesce(F.array_max(F.transform(w, lambda z, i: F.when(z.startswith("#") | z.startswith("```"), i + 1))), F.lit(0))
        paragraphs = F.filter(F.split(F.array_join(F.slice(w, stop + 1, F.size(w)), "\n"), "\n\n+"), lambda q: bare(q) != "")
        last = F.slice(paragraphs, F.greatest(F.size(paragraphs) - 1, F.lit(1)), F.lit(2))
        text = F.array_join(F.transform(last, lambda q: F.replace(bare(q), F.lit("\n"), F.lit(" "))), "\n\n")
        return F.struct(F.coalesce(m.heading_before(w, F.size(w)), F.lit("")).alias("heading"), F.when(F.length(text) < 10, "").otherwise(text).alias("context"))

    found = m.once(m.lines(md), lambda rows: F.transform(m.blocks(md), lambda b: m.once(around(rows, b["start_line"] - 1), lambda c: F.struct(b["block_index"].alias("block_index"), c["heading"].alias("heading"), c["context"].alias("context")))))
    return articles(spark, sf_dir).select("doc_id", F.inline(found))


@query(f"""SELECT doc_id, array_to_string(list_filter(string_split(code, chr(10)), lambda z: {_B('z')} <> '' AND NOT starts_with({_B('z')}, '//') AND NOT starts_with({_B('z')}, '*') AND (contains(z, 'Document') OR contains(z, 'Generator') OR contains(z, 'License'))), chr(10)) AS lines FROM (SELECT doc_id, {pick_sql(CODE, 'doc_id')} AS code FROM documents)""")
def product_calls(spark, sf_dir):
    """Lines of code that name a type of the catalogue; comments don't count."""
    names = F.array(*(F.lit(n) for n in ("Document", "Generator", "License")))
    kept = F.filter(F.split(pick(CODE, F.col("doc_id")), "\n"), lambda z: (bare(z) != "") & ~bare(z).startswith("//") & ~bare(z).startswith("*") & F.exists(names, lambda n: F.contains(z, n)))
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(kept, "\n").alias("lines"))

