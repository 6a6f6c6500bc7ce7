"""Repairs that need no catalogue: quick fixes by errors, run-time repairs, and transformers that learned patterns name."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import portable as p
from .base import query, read
from .samples import _OWN, _own, pick, pick_sql, quoted

# Frames of code; folder and file stand for the row's source and for its language and id.
FRAMES = [
    'using System;\nclass P\n{\n    static async Task Main(string[] args)\n    {\n        var a = new Archive(@"C:\\in\\{folder}\\{file}.zip");\n        a.Save("{folder}_folder");\n        Read("x/output/{file}");\n    }\n}',
    'using System.IO.Compression;\nusing (var z = ZipFile.OpenRead("source.zip"))\n{\n    Open(z, ZipArchiveMode.Update);\n    // ZipArchiveMode.Read\n}',
    'var names = Directory.GetFiles("folder", "*.{file}");\nvar dir = "folder";\nvar info = new DirectoryInfo( "sourceDir" );\nstring root = "inputFolder";\nPath.Combine("zip_folder", "{file}");',
    'var s = new DeflateCompressionSettings(CompressionLevel.Normal);\nvoid Pack(string path, CompressionLevel level = CompressionLevel.High) { }\nawait archive.SaveAsync(stream);\nother.SaveAsync(stream);',
    'var o = new Options { Password = "your_password", Other = \'password\' };\nvar e = archive.Entries["{file}.txt"];\nvar f = archive.Entries [ "b" ];\narchive.SaveAsync("YourArchive.zip");',
    'using System;\nusing Acme.Docs;\nvar doc = new Document(MyDir + "{file}.docx");\ndoc.Save(ArtifactsDir);\nmaster.Append(doc);',
    'static async Task<int> Main()\n{\n    // await nothing\n    Log("await it");\n    Load("C:\\\\data\\\\{folder}\\\\{file}.png", "D:\\tmp");\n    return httpFile.Length;\n}',
    'static async Task Main()\n{\n    await Go("/srv/{folder}/{file}.json", @"D:\\{folder}", "C:\\\\{folder}");\n    Use("{folder}_dir", "{folder}_DIR.zip");\n    Directory.CreateDirectory(@"{folder}_dir");\n}',
    "",
]
ERRORS = [
    ["System.IO.DirectoryNotFoundException: Could not find a part of the path"],
    ["error CS0246: The type or namespace name 'DeflateCompressionSettings' could not be found", "error CS0246: The type or namespace name 'SevenZipArchive' could not be found"],
    [],
    ["error CS0246: The type or namespace name 'ArchiveEntrySettings' could not be found", "Unhandled exception. System.IO.DirectoryNotFoundException: gone"],
]
# Words of errors that call for a namespace.
NAMESPACES = {"Acme.Zip.Saving": ["CompressionSettings", "ParallelCompressionOptions", "ArchiveEntrySettings"], "Acme.Zip.SevenZip": ["SevenZipArchive"]}
NAMES = [*p.RUNTIME, "unknown_step", ""]


def _code(spark, sf_dir):
    k = F.col("doc_id")
    code = F.replace(F.replace(pick(FRAMES, k), F.lit("{folder}"), F.coalesce("source", F.lit(""))), F.lit("{file}"), F.concat(F.coalesce("lang", F.lit("")), k.cast("string")))
    errors = F.element_at(F.array(*(F.array(*map(F.lit, e)).cast("array<string>") for e in ERRORS)), (F.floor(k / len(FRAMES)) % len(ERRORS) + 1).cast("int"))
    return read(spark, sf_dir, "documents").select("doc_id", F.when(k % 2 == 0, F.concat(code, _own())).otherwise(code).alias("code"), errors.alias("errors"), pick(NAMES, F.floor(k / 2)).alias("name"))


_LISTS = "[" + ", ".join("CAST([" + ", ".join(map(quoted, e)) + "] AS VARCHAR[])" for e in ERRORS) + "]"
_BASE = f"replace(replace({pick_sql(FRAMES, 'doc_id')}, '{{folder}}', coalesce(source, '')), '{{file}}', concat(lang, doc_id))"
_CODE = f"""(SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat({_BASE}, {_OWN}) ELSE {_BASE} END AS code,
 ({_LISTS})[CAST(doc_id // {len(FRAMES)} % {len(ERRORS)} AS INTEGER) + 1] AS errors, {pick_sql(NAMES, 'doc_id // 2')} AS name FROM documents)"""


def _replaced(x: str, pairs) -> str:
    for old, new in pairs:
        x = f"replace({x}, {quoted(old)}, {quoted(new)})"
    return x


def _folders_sql(x: str) -> str:
    """One folder name after the other, in the first kind of place in which it occurs."""
    places = [(r"(Directory\.(?:GetFiles|GetDirectories|EnumerateFiles|Exists)\s*\(\s*)", "", r'\1"."'), (r"new\s+DirectoryInfo\s*\(\s*", r"\s*\)", 'new DirectoryInfo(".")'), (r"Path\.Combine\s*\(\s*", "", 'Path.Combine("."'), (r"(\.CreateEntries\s*\(\s*)", "", r'\1"."'), (r"=\s*", r"\s*;", '= ".";')]
    case = ""
    for before, after, new in places:
        pattern = f"""concat({quoted(before + '"')}, n, {quoted('"' + after)})"""
        case += f" WHEN regexp_matches(c, {pattern}) THEN regexp_replace(c, {pattern}, {quoted(new)}, 'g')"
    return f"list_reduce(list_concat([{x}], [{', '.join(map(quoted, p.FOLDERS))}]), lambda c, n: CASE{case} ELSE c END)"


def _absolute_sql(x: str) -> str:
    files = [r'@"[A-Za-z]:\\[^"]*\\([^"\\]+\.\w{2,5})"', r'"[A-Za-z]:\\\\[^"]*\\\\([^"\\]+\.\w{2,5})"', r'"/[^"]+/([^"/]+\.\w{2,5})"']
    for pattern in files:
        x = f"""regexp_replace({x}, {quoted(pattern)}, '"\\1"', 'g')"""
    for pattern in (r'@"[A-Za-z]:\\(?:[^"]*[\\/])?[^"\\/.]*"', r'"[A-Za-z]:\\\\(?:[^"]*[\\/])?[^"\\/.]*"'):
        x = f"""regexp_replace({x}, {quoted(pattern)}, '"."', 'g')"""
    return x


_STEPS = {
    "passwords": lambda x: _replaced(x, [(f"{q}{w}{q}", f"{q}p@s${q}") for w in p.PASSWORDS for q in "\"'"]),
    "folders": _folders_sql,
    "absolute_paths": _absolute_sql,
    "archives": lambda x: _replaced(x, [(f'"{a}"', '"sample.zip"') for a in p.ARCHIVES]),
    "level_parameter": lambda x: rf"regexp_replace({x}, ',\s*CompressionLevel\s+\w+\s*=\s*CompressionLevel\.\w+', '', 'g')",
    "levels": lambda x: _replaced(x, [(f"CompressionLevel.{a}", f"CompressionLevel.{b}") for a, b in p.LEVELS.items()]),
    "settings": lambda x: rf"regexp_replace(regexp_replace({x}, 'new\s+DeflateCompressionSettings\s*\(\s*CompressionLevel\.\w+\s*\)', 'new DeflateCompressionSettings()', 'g'), 'new\s+DeflateCompressionSettings\s*\(\s*[a-zA-Z_]\w*\s*\)', 'new DeflateCompressionSettings()', 'g')",
    "entries": lambda x: rf"""regexp_replace({x}, '\.Entries\s*\[\s*"(?:[^"\\]|\\.)*"\s*\]', '.Entries[0]')""",
    "save_async": lambda x: rf"CASE WHEN regexp_matches({x}, '\bawait\s+\w+\.SaveAsync\s*\(') THEN regexp_replace({x}, '\bawait\s+(\w+)\.SaveAsync\s*\(', '\1.Save(', 'g') ELSE regexp_replace({x}, '\.SaveAsync\s*\(', '.Save(', 'g') END",
}
_CHAIN = ", ".join(f"r{i + 1} AS (SELECT *, {step(f'c{i}')} AS c{i + 1} FROM r{i})" for i, step in enumerate(_STEPS.values()))
_DONE = ", ".join(f"CASE WHEN c{i + 1} <> c{i} THEN '{name}' END" for i, name in enumerate(_STEPS))


@query(f"WITH r0 AS (SELECT doc_id, code AS c0 FROM {_CODE}), {_CHAIN} SELECT doc_id, c{len(_STEPS)} AS fixed, list_filter([{_DONE}], lambda z: z IS NOT NULL) AS fixes FROM r{len(_STEPS)}")
def portable_code(spark, sf_dir):
    """Code as it runs elsewhere: test passwords, folders, paths, archives and calls that exist; and which repairs changed it."""
    return p.runtime_repairs(_code(spark, sf_dir)).select("doc_id", "fixed", "fixes")


_CASES = " ".join(f"WHEN '{name}' THEN {step('code')}" for name, step in _STEPS.items())


@query(f"""WITH t AS (SELECT *, CASE name {_CASES} ELSE code END AS fixed FROM {_CODE})
SELECT doc_id, name, fixed, fixed <> code AS applied, CASE WHEN name = '' THEN 'Missing transformer name' WHEN name = 'unknown_step' THEN 'Unknown transformer: unknown_step' WHEN fixed <> code THEN concat('Applied transformer ''', name, '''') ELSE 'Transformer made no changes' END AS note FROM t""")
def learned_transforms(spark, sf_dir):
    """Code after the registered transformer that its pattern names, whether that changed it, and what is said of it."""
    return p.transformed(_code(spark, sf_dir), "name").select("doc_id", "name", "fixed", "applied", "note")


KINDS = ["Zip", "words", "CELLS", "pdf"]
_RAR = r"""new\s+RarArchive\s*\(\s*("(?:[^"\\]|\\.)*")\s*,\s*("(?:[^"\\]|\\.)*")\s*\)"""
_ROWS = "string_split(x, chr(10))"
_LAST = f"list_max(list_filter(range(1, len({_ROWS}) + 1), lambda i: starts_with(trim({_ROWS}[i]), 'using ') AND ends_with(trim({_ROWS}[i]), ';')))"
_ZIP = ["entries", "archives", "level_parameter", "levels", "settings", "save_async"]
_ZIPPED = ", ".join(f"z{i + 1} AS (SELECT *, CASE WHEN zip THEN {_STEPS[name](f'z{i}')} ELSE z{i} END AS z{i + 1} FROM z{i})" for i, name in enumerate(_ZIP))
_ZIP_DONE = ", ".join(f"CASE WHEN z{i + 1} <> z{i} THEN '{name}' END" for i, name in enumerate(_ZIP))
_MORE = 'concat(\'using Acme.Words.Plugins;\', chr(10), code, chr(10), \'Open(new RarArchive("\', lang, doc_id, \'.rar", "\', source, \'"), Acme.Zip.Plugins.Run);\')'


@query(f"""WITH c AS (SELECT c.doc_id, {pick_sql(KINDS, 'c.doc_id // 3')} AS family, CASE WHEN c.doc_id % 3 = 0 THEN c.code ELSE {_MORE.replace('doc_id', 'c.doc_id')} END AS code FROM {_CODE} c JOIN (SELECT doc_id AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents) d ON d.id = c.doc_id),
a AS (SELECT *, lower(family) = 'zip' AS zip, regexp_replace(code, {quoted(_RAR)}, 'new RarArchive(\\1, new RarArchiveLoadOptions() {{ DecryptionPassword = \\2 }})') AS x FROM c),
z0 AS (SELECT *, CASE WHEN NOT zip OR x = code THEN code WHEN {_LAST} IS NULL OR contains(x, 'using Acme.Zip.Rar;') THEN x ELSE array_to_string(list_concat({_ROWS}[1:{_LAST}], ['using Acme.Zip.Rar;'], {_ROWS}[{_LAST} + 1:]), chr(10)) END AS z0 FROM a), {_ZIPPED},
f AS (SELECT *, CASE WHEN lower(family) IN ('words', 'cells', 'slides') THEN regexp_replace(code, '\\bAcme\\.(\\w+)\\.Plugins\\b', 'Acme.\\1.LowCode', 'g') ELSE z{len(_ZIP)} END AS fixed FROM z{len(_ZIP)})
SELECT doc_id, family, fixed, list_filter([CASE WHEN z0 <> code THEN 'archive_password' END, {_ZIP_DONE}, CASE WHEN NOT zip AND fixed <> code THEN 'low_code' END], lambda z: z IS NOT NULL) AS fixes FROM f""")
def family_repairs(spark, sf_dir):
    """Code after the repairs registered for its product family."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
    k, c = F.col("doc_id"), _code(spark, sf_dir)
    more = F.concat(F.lit("using Acme.Words.Plugins;\n"), F.col("code"), F.lit('\nOpen(new RarArchive("'), "lang", k.cast("string"), F.lit('.rar", "'), "source", F.lit('"), Acme.Zip.Plugins.Run);'))
    c = c.join(d, F.col("id") == k).select("doc_id", pick(KINDS, F.floor(k / 3)).alias("family"), F.when(k % 3 == 0, F.col("code")).otherwise(more).alias("code"))
    return p.family_repairs(c).select("doc_id", "family", "fixed", "fixes")


_MAIN = r"(?s)^.*?static\s+(?:async\s+)?(?:void|Task|int)\s+Main\s*\([^)]*\)\s*\{"
_USING = r"(?s)^.*using\s+[\w.]+\s*;"


def _behind(x: str, pattern: str, new: str) -> str:
    head = f"regexp_extract({x}, {quoted(pattern)})"
    return f"CASE WHEN {head} <> '' THEN concat({head}, {new}, substr({x}, length({head}) + 1)) END"


def _named(x: str, space: str) -> str:
    line = f"concat('using {space};', chr(10))"
    return f"CASE WHEN contains({x}, 'using {space};') THEN {x} ELSE coalesce({_behind(x, _USING, f'concat(chr(10), {line})')}, concat({line}, {x})) END"


def _silent(x: str, name: str, pattern: str) -> str:
    ind = r"regexp_extract(z, '^\s*')"
    return rf"array_to_string(list_transform(string_split({x}, chr(10)), lambda z: CASE WHEN regexp_matches(z, {quoted(pattern)}) AND NOT regexp_matches(z, '^\s*//') THEN concat({ind}, '// REMOVED: {name} is not available in Acme.Zip API', chr(10), {ind}, '// ', regexp_replace(z, '^\s+|\s+$', '', 'g')) ELSE z END), chr(10))"


def _said(*words: str) -> str:
    return "(" + " OR ".join(f"len(list_filter(errors, lambda e: contains(e, '{w}'))) > 0" for w in words) + ")"


_CALL = "concat('Directory.CreateDirectory(@\"', d, '\")')"
_FOUND = "list_concat(" + ", ".join(f"regexp_extract_all(c0, {quoted(x)}, 1)" for x in (r'(?i)"([^"]+_folder)"', r'(?i)"([^"]+_dir)"', r'(?i)"([^"]+\\+output[^"]*)"', r'(?i)"([^"]+/output[^"]*)"')) + ")"
_LACK = rf"list_sort(list_distinct(list_filter({_FOUND}, lambda d: NOT regexp_matches(d, '\.(?:zip|rar|7z|txt|gz)$') AND NOT contains(c0, {_CALL}))))"
_CALLS = f"concat(chr(10), array_to_string(list_transform(lack, lambda d: concat('        ', {_CALL}, ';')), chr(10)), chr(10))"
_DRIVE = r'"([A-Za-z]:\\[^"]+)"'
_PARTS = r"list_filter(string_split(replace(d, '\\', '\'), '\'), lambda z: z <> '')"
_COMBINED = f"""list_reduce(list_concat([c7], paths), lambda c, d: replace(c, concat('"', d, '"'), concat('Path.Combine(', array_to_string(list_transform({_PARTS}, lambda z: concat('"', z, '"')), ', '), ')')))"""
_BARE = r"regexp_replace(regexp_replace(c8, '(?m)//.*$', '', 'g'), '(?s)/\*.*?\*/', '', 'g')"
_USED = "\\b{0}\\s*\\+|\\(\\s*{0}\\s*[,)]|[,(]\\s*{0}\\s*\\)|\\$\"[^\"]*\\{{{0}\\}}[^\"]*\"|=\\s*{0}\\s*;|\\b{0}\\s*\\."
_NEED = ", ".join(f"CASE WHEN regexp_matches({_BARE}, {quoted(_USED.format(n))}) AND NOT regexp_matches(c8, '(?:string|var|Document|const)\\s+{n}\\b') THEN {quoted(line)} END" for n, line in p.HARNESS.items())
_BLOCK = "concat(chr(10), array_to_string(list_transform(need, lambda z: concat('{0}', z)), chr(10)), chr(10))"


@query(rf"""WITH a AS (SELECT doc_id, errors, code AS c0 FROM {_CODE}), a1 AS (SELECT *, {_LACK} AS lack FROM a),
b AS (SELECT *, CASE WHEN {_said('DirectoryNotFoundException')} AND len(lack) > 0 THEN {_behind('c0', _MAIN, _CALLS)} END AS n1 FROM a1), b1 AS (SELECT *, coalesce(n1, c0) AS c1 FROM b),
c AS (SELECT *, CASE WHEN {_said('CompressionSettings', 'ParallelCompressionOptions', 'ArchiveEntrySettings')} AND NOT contains(c1, 'using Acme.Zip.Saving;') THEN {_named('c1', 'Acme.Zip.Saving')} END AS n2 FROM b1), d AS (SELECT *, coalesce(n2, c1) AS c2 FROM c),
e AS (SELECT *, CASE WHEN {_said('SevenZipArchive')} AND NOT contains(c2, 'using Acme.Zip.SevenZip;') THEN {_named('c2', 'Acme.Zip.SevenZip')} END AS n3 FROM d), f AS (SELECT *, coalesce(n3, c2) AS c3, regexp_replace(coalesce(n3, c2), 'using\s+System\.IO\.Compression\s*;[\r\n]*', '', 'g') AS without FROM e),
g AS (SELECT *, CASE WHEN contains(c3, 'using System.IO.Compression;') THEN {_named('without', 'Acme.Zip')} END AS n4 FROM f), h AS (SELECT *, coalesce(n4, c3) AS c4 FROM g),
i AS (SELECT *, {_silent('c4', 'ZipArchiveMode', r'ZipArchiveMode\.\w+')} AS s1 FROM h), j AS (SELECT *, {_silent('s1', 'ZipFile.OpenRead', r'ZipFile\.OpenRead\s*\([^)]*\)')} AS s2 FROM i),
k AS (SELECT *, {_silent('s2', 'ZipFile.CreateFromDirectory', r'ZipFile\.CreateFromDirectory\s*\([^)]*\)')} AS s3 FROM j), l AS (SELECT *, CASE WHEN s3 <> c4 THEN {_named('s3', 'Acme.Zip')} ELSE s3 END AS c6 FROM k),
m AS (SELECT *, CASE WHEN regexp_matches(c6, 'static\s+async\s+Task(?:<int>)?\s+Main\s*\([^)]*\)\s*\{{') AND NOT regexp_matches(regexp_replace(regexp_replace(c6, '"[^"]*"', '', 'g'), '//[^\n]*', '', 'g'), '\bawait\s+')
 THEN regexp_replace(regexp_replace(c6, 'static\s+async\s+Task\s+Main\s*\(', 'static void Main(', 'g'), 'static\s+async\s+Task<int>\s+Main\s*\(', 'static int Main(', 'g') END AS n6 FROM l),
n AS (SELECT *, coalesce(n6, c6) AS c7, regexp_extract_all(coalesce(n6, c6), {quoted(_DRIVE)}, 1) AS paths FROM m), o AS (SELECT *, {_COMBINED} AS joined FROM n),
q AS (SELECT *, CASE WHEN len(paths) > 0 THEN {_named('joined', 'System.IO')} ELSE c7 END AS c8 FROM o), r AS (SELECT *, list_filter([{_NEED}], lambda z: z IS NOT NULL) AS need FROM q),
s AS (SELECT *, CASE WHEN len(need) > 0 THEN coalesce({_behind('c8', _MAIN, _BLOCK.format('        '))}, {_behind('c8', _USING, _BLOCK.format(''))}, concat(array_to_string(need, chr(10)), chr(10), c8)) ELSE c8 END AS fixed FROM r)
SELECT doc_id, fixed, list_filter([CASE WHEN n1 IS NOT NULL THEN 'directory_create_injection' END, CASE WHEN n2 IS NOT NULL THEN 'using_acme_zip_saving' END, CASE WHEN n3 IS NOT NULL THEN 'using_acme_zip_sevenzip' END, CASE WHEN n4 IS NOT NULL THEN 'platform_archives' END,
 CASE WHEN s1 <> c4 THEN 'foreign_call_ziparchivemode' END, CASE WHEN s2 <> s1 THEN 'foreign_call_zipfile_openread' END, CASE WHEN s3 <> s2 THEN 'foreign_call_zipfile_createfromdirectory' END, CASE WHEN n6 IS NOT NULL THEN 'async_main' END,
 CASE WHEN len(paths) > 0 THEN 'drive_paths' END, CASE WHEN len(need) > 0 THEN 'harness_names' END], lambda z: z IS NOT NULL) AS fixes FROM s""")
def quick_fixes(spark, sf_dir):
    """Code after the quick fixes that its errors or it itself call for, and their names."""
    return p.quick_fixes(_code(spark, sf_dir), NAMESPACES, "Acme.Zip").select("doc_id", "fixed", "fixes")
