"""Repairs that need no catalogue, as steps of built-in functions over a table of code: what fails at run time away from
its author's machine, and what always fails in one way. A null code stays null, an empty one stays as it is unless an
error asks for a line; null errors ask for nothing. Rows are read one by one, and other columns are carried along."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.code import insert_using

Step = Callable[[Column], Column]

# Passwords of examples and the one of the test files; names that stand for a folder; archives that
# stand for the sample; values that an enumeration lacks, and the ones meant.
PASSWORDS, PASSWORD = ["your_password", "your-password", "mypassword", "my_password", "secretpassword", "your_secret", "my_secret", "password"], "p@s$"
FOLDERS = ["zip_folder", "folder", "YourFolderPath", "AnimationImages", "sourceDir", "inputFolder", "sourceFolder", "inputDirectory", "folderPath", "directoryPath", "sourcePath"]
ARCHIVES = ["compressed_files.zip", "your_archive.zip", "source.zip", "input.zip", "YourArchive.zip", "my_archive.zip", "files.zip"]
LEVELS = {"Normal": "Optimal", "Low": "Fastest", "High": "SmallestSize"}

# Where a folder's name stands in code; the first that occurs is replaced.
FOLDER_PLACES = [
    (r"(Directory\.(?:GetFiles|GetDirectories|EnumerateFiles|Exists)\s*\(\s*)", "", "$1"),
    (r"new\s+DirectoryInfo\s*\(\s*", r"\s*\)", "new DirectoryInfo("),
    (r"Path\.Combine\s*\(\s*", "", "Path.Combine("),
    (r"(\.CreateEntries\s*\(\s*)", "", "$1"),
    (r"=\s*", r"\s*;", "= "),
]
FOLDER_ENDS = ["", ")", "", "", ";"]

# Absolute paths of files by their names, of folders as the current one.
ABSOLUTE = [
    (r'@"[A-Za-z]:\\[^"]*\\([^"\\]+\.\w{2,5})"', '"$1"'),
    (r'"[A-Za-z]:\\\\[^"]*\\\\([^"\\]+\.\w{2,5})"', '"$1"'),
    (r'"/[^"]+/([^"/]+\.\w{2,5})"', '"$1"'),
    (r'@"[A-Za-z]:\\(?:[^"]*[\\/])?[^"\\/.]*"', '"."'),
    (r'"[A-Za-z]:\\\\(?:[^"]*[\\/])?[^"\\/.]*"', '"."'),
]

# The start of a program, a line that names a namespace.
MAIN = r"static\s+(?:async\s+)?(?:void|Task|int)\s+Main\s*\([^)]*\)\s*\{"
USING = r"using\s+[\w.]+\s*;"
ASYNC_MAIN = r"static\s+async\s+Task(?:<int>)?\s+Main\s*\([^)]*\)\s*\{"

# Names that stand for a folder in code, and what declares them.
FOLDER_NAMES = [r'(?i)"([^"]+_folder)"', r'(?i)"([^"]+_dir)"', r'(?i)"([^"]+\\+output[^"]*)"', r'(?i)"([^"]+/output[^"]*)"']
HARNESS = {
    "MyDir": 'string MyDir = @"./";',
    "ArtifactsDir": 'string ArtifactsDir = @"./artifacts/";',
    "master": "var master = new Document();",
    "httpFile": "var httpFile = Request.Files[0];",
    "sourceStreams": "var sourceStreams = new List<Stream>();",
}
# Calls of the platform's archives, which the product doesn't have.
FOREIGN = {"ZipArchiveMode": r"ZipArchiveMode\.\w+", "ZipFile.OpenRead": r"ZipFile\.OpenRead\s*\([^)]*\)", "ZipFile.CreateFromDirectory": r"ZipFile\.CreateFromDirectory\s*\([^)]*\)"}


def passwords(x: Column) -> Column:
    """Passwords that examples invent are those of the test files."""
    for word in PASSWORDS:
        for q in "\"'":
            x = F.replace(x, F.lit(f"{q}{word}{q}"), F.lit(f"{q}{PASSWORD}{q}"))
    return x


def folders(x: Column) -> Column:
    """Names that stand for a folder are the current one, in the first kind of place that each occurs in."""

    def one(code: Column, name: Column) -> Column:
        out = None
        for (before, after, new), end in zip(FOLDER_PLACES, FOLDER_ENDS, strict=True):
            pattern = F.concat(F.lit(before + '"'), name, F.lit('"' + after))
            hit, value = F.regexp_like(code, pattern), F.regexp_replace(code, pattern, F.lit(f'{new}"."{end}'))
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out.otherwise(code)

    there = F.filter(F.array(*map(F.lit, FOLDERS)), lambda n: F.contains(x, F.concat(F.lit('"'), n, F.lit('"'))))
    return F.aggregate(there, x, one)


def absolute(x: Column) -> Column:
    """Absolute paths are the names of their files; those of folders are the current one."""
    for pattern, new in ABSOLUTE:
        x = F.regexp_replace(x, pattern, new)
    return x


def archives(x: Column) -> Column:
    for name in ARCHIVES:
        x = F.replace(x, F.lit(f'"{name}"'), F.lit('"sample.zip"'))
    return x


def levels(x: Column) -> Column:
    for old, new in LEVELS.items():
        x = F.replace(x, F.lit(f"CompressionLevel.{old}"), F.lit(f"CompressionLevel.{new}"))
    return x


def settings(x: Column) -> Column:
    """The constructor of deflate settings takes nothing, neither a level nor a variable."""
    return F.regexp_replace(x, r"new\s+DeflateCompressionSettings\s*\(\s*(?:CompressionLevel\.\w+|[a-zA-Z_]\w*)\s*\)", "new DeflateCompressionSettings()")


def level_parameter(x: Column) -> Column:
    return F.regexp_replace(x, r",\s*CompressionLevel\s+\w+\s*=\s*CompressionLevel\.\w+", "")


def entries(x: Column) -> Column:
    """The first entry that is asked for by its name is asked for by its number."""
    return F.regexp_replace(x, r'(?s)^(.*?)\.Entries\s*\[\s*"(?:[^"\\]|\\.)*"\s*\]', "$1.Entries[0]")


def save_async(x: Column) -> Column:
    """Archives are saved, not awaited; without await only where none is awaited."""
    waited = F.regexp_replace(x, r"\bawait\s+(\w+)\.SaveAsync\s*\(", "$1.Save(")
    return F.when(waited != x, waited).otherwise(F.regexp_replace(x, r"\.SaveAsync\s*\(", ".Save("))


def archive_password(x: Column) -> Column:
    """The first archive that is given a password takes it in its options; their namespace is added behind the last using line, if there is one."""
    new = F.regexp_replace(x, r'(?s)^(.*?)new\s+RarArchive\s*\(\s*("(?:[^"\\]|\\.)*")\s*,\s*("(?:[^"\\]|\\.)*")\s*\)', "$1new RarArchive($2, new RarArchiveLoadOptions() { DecryptionPassword = $3 })")
    named = F.coalesce(insert_using(new, F.lit("using Acme.Zip.Rar;"), F.lit("RarArchiveLoadOptions")), new)
    return F.when(new == x, x).when(new.rlike(r"(?m)^\s*using [^\n]*;\s*$"), named).otherwise(new)


def low_code(x: Column) -> Column:
    """The namespace that was renamed."""
    return F.regexp_replace(x, r"\bAcme\.(\w+)\.Plugins\b", "Acme.$1.LowCode")


#: Repairs in their order, with what is said of them.
RUNTIME: dict[str, Step] = {"passwords": passwords, "folders": folders, "absolute_paths": absolute, "archives": archives, "level_parameter": level_parameter, "levels": levels, "settings": settings, "entries": entries, "save_async": save_async}

#: Repairs of product families, in their order; other families have none.
FAMILIES: dict[str, dict[str, Step]] = {
    "zip": {"archive_password": archive_password, "entries": entries, "archives": archives, "level_parameter": level_parameter, "levels": levels, "settings": settings, "save_async": save_async},
    "words": {"low_code": low_code},
    "cells": {"low_code": low_code},
    "slides": {"low_code": low_code},
}

#: Transformers that learned patterns may name.
TRANSFORMERS: dict[str, Step] = dict(RUNTIME)


def register(name: str, step: Step) -> None:
    """A further transformer, or another one of a name that is taken."""
    TRANSFORMERS[name] = step


def _in_turn(df: DataFrame, code: str, steps: list[tuple[str, Step, Column | None]]) -> DataFrame:
    """df with fixed and fixes: code after the steps, each where its condition holds; a projection each, so that code isn't computed again for each use."""
    df = df.withColumn("fixed", F.col(code)).withColumn("fixes", F.array().cast("array<string>"))
    for name, step, where in steps:
        new = step(F.col("fixed"))
        df = df.withColumn("_new", new if where is None else F.when(where, new).otherwise(F.col("fixed")))
        df = df.withColumn("fixes", F.when(F.col("_new") != F.col("fixed"), F.concat("fixes", F.array(F.lit(name)))).otherwise(F.col("fixes"))).withColumn("fixed", F.col("_new"))
    return df.drop("_new")


def runtime_repairs(df: DataFrame, code: str = "code") -> DataFrame:
    """df with fixed and fixes: code after all run-time repairs in their order, and the names of those that changed it."""
    return _in_turn(df, code, [(name, step, None) for name, step in RUNTIME.items()])


def family_repairs(df: DataFrame, family: str = "family", code: str = "code") -> DataFrame:
    """df with fixed and fixes: code after the repairs registered for each row's family, which is told in any case. A null
    family and one without repairs leave it as it is."""
    name = F.lower(family)
    return _in_turn(df, code, [(n, step, name == known) for known, steps in FAMILIES.items() for n, step in steps.items()])


def transformed(df: DataFrame, name: str, code: str = "code") -> DataFrame:
    """df with fixed, applied and note: code after the transformer that each row names, one of many a row. A null name
    and one that isn't registered leave it as it is, and the note says so."""
    x, n, new = F.col(code), F.col(name), None
    for known, step in TRANSFORMERS.items():
        new = F.when(n == known, step(x)) if new is None else new.when(n == known, step(x))
    df = df.withColumn("fixed", F.coalesce(new, x))
    applied = F.coalesce(F.col("fixed") != x, F.lit(False))
    said = F.when(n.isNull() | (n == ""), "Missing transformer name").when(~n.isin(*TRANSFORMERS), F.concat(F.lit("Unknown transformer: "), n)).when(applied, F.concat(F.lit("Applied transformer '"), n, F.lit("'")))
    return df.withColumn("applied", applied).withColumn("note", said.otherwise("Transformer made no changes"))


def _behind(x: Column, pattern: str, new: Column) -> Column:
    """x with new behind what pattern matches from the start on; null where it doesn't."""
    head = F.regexp_extract(x, pattern, 0)
    return F.when(head != "", F.concat(head, new, F.substr(x, F.length(head) + 1)))


def named(x: Column, namespace: str) -> Column:
    """Code that names the namespace, behind its last using line or at its beginning; as it is where it does already."""
    line = F.lit(f"using {namespace};\n")
    added = F.coalesce(_behind(x, rf"(?s)^.*{USING}", F.concat(F.lit("\n"), line)), F.concat(line, x))
    return F.when(F.contains(x, F.lit(f"using {namespace};")), x).otherwise(added)


def _made(x: Column) -> Column:
    """Folders that the code names are made at the start of Main, unless the code makes them."""
    found = F.concat(*(F.regexp_extract_all(x, F.lit(p), F.lit(1)) for p in FOLDER_NAMES))
    call = lambda d: F.concat(F.lit('Directory.CreateDirectory(@"'), d, F.lit('")'))
    lack = F.array_sort(F.array_distinct(F.filter(found, lambda d: ~d.rlike(r"\.(?:zip|rar|7z|txt|gz)$") & ~F.contains(x, call(d)))))
    lines = F.array_join(F.transform(lack, lambda d: F.concat(F.lit("        "), call(d), F.lit(";"))), "\n")
    return F.when(F.size(lack) > 0, _behind(x, f"(?s)^.*?{MAIN}", F.concat(F.lit("\n"), lines, F.lit("\n"))))


def _silenced(x: Column, name: str, pattern: str, product: str) -> Column:
    """Lines that call what the product lacks become comments."""
    gone = lambda z: F.when(z.rlike(pattern) & ~z.rlike(r"^\s*//"), F.concat(F.regexp_extract(z, r"^\s*", 0), F.lit(f"// REMOVED: {name} is not available in {product} API\n"), F.regexp_extract(z, r"^\s*", 0), F.lit("// "), F.regexp_replace(z, r"^\s+|\s+$", ""))).otherwise(z)
    return F.array_join(F.transform(F.split(x, "\n"), gone), "\n")


def _waitless(x: Column) -> Column:
    """A Main that awaits nothing isn't asynchronous; strings and comments don't count."""
    bare = F.regexp_replace(F.regexp_replace(x, '"[^"]*"', ""), "//[^\n]*", "")
    new = F.regexp_replace(F.regexp_replace(x, r"static\s+async\s+Task\s+Main\s*\(", "static void Main("), r"static\s+async\s+Task<int>\s+Main\s*\(", "static int Main(")
    return F.when(x.rlike(ASYNC_MAIN) & ~bare.rlike(r"\bawait\s+"), new)


def _combined(x: Column) -> Column:
    """Paths of a drive are combined from their parts."""
    parts = lambda p: F.filter(F.split(F.replace(p, F.lit("\\\\"), F.lit("\\")), r"\\"), lambda z: z != "")
    call = lambda p: F.concat(F.lit("Path.Combine("), F.array_join(F.transform(parts(p), lambda z: F.concat(F.lit('"'), z, F.lit('"'))), ", "), F.lit(")"))
    found = F.regexp_extract_all(x, F.lit(r'"([A-Za-z]:\\[^"]+)"'), F.lit(1))
    new = F.aggregate(found, x, lambda acc, p: F.replace(acc, F.concat(F.lit('"'), p, F.lit('"')), call(p)))
    return F.when(F.size(found) > 0, new)


def _declared(x: Column) -> Column:
    """Names of the test harness that the code uses and doesn't declare are declared: in Main, behind the last using line, or first."""
    bare = F.regexp_replace(F.regexp_replace(x, "(?m)//.*$", ""), r"(?s)/\*.*?\*/", "")
    lack = []
    for name, line in HARNESS.items():
        used = rf'\b{name}\s*\+|\(\s*{name}\s*[,)]|[,(]\s*{name}\s*\)|\$"[^"]*\{{{name}\}}[^"]*"|=\s*{name}\s*;|\b{name}\s*\.'
        lack.append(F.when(bare.rlike(used) & ~x.rlike(rf"(?:string|var|Document|const)\s+{name}\b"), F.lit(line)))
    lines = F.array_compact(F.array(*lack))
    block = lambda indent: F.concat(F.lit("\n"), F.array_join(F.transform(lines, lambda z: F.concat(F.lit(indent), z)), "\n"), F.lit("\n"))
    new = F.coalesce(_behind(x, f"(?s)^.*?{MAIN}", block("        ")), _behind(x, rf"(?s)^.*{USING}", block("")), F.concat(F.array_join(lines, "\n"), F.lit("\n"), x))
    return F.when(F.size(lines) > 0, new)


def quick_fixes(df: DataFrame, namespaces: dict[str, list[str]], product: str, code: str = "code", errors: str = "errors") -> DataFrame:
    """df with fixed and fixes: code after the quick fixes that its errors or it itself call for, in their order.

    A missing folder in an error makes folders; an error that holds one of a namespace's words (namespaces: namespace
    to words) names it; the platform's archives give way to the product's; calls that the product lacks become
    comments; a Main that awaits nothing is plain; paths of a drive are combined; names of the harness are declared.
    """
    said = lambda word: F.coalesce(F.exists(errors, lambda e: F.contains(e, F.lit(word))), F.lit(False))
    x = F.col("fixed")
    df = df.withColumn("fixed", F.col(code)).withColumn("fixes", F.array().cast("array<string>"))

    def step(df: DataFrame, name: str, new: Column) -> DataFrame:
        """new where it isn't null; each step is a projection of its own, so that code isn't computed again for each use."""
        df = df.withColumn("_new", new)
        return df.withColumn("fixes", F.when(F.col("_new").isNotNull(), F.concat("fixes", F.array(F.lit(name)))).otherwise(F.col("fixes"))).withColumn("fixed", F.coalesce("_new", "fixed"))

    df = step(df, "directory_create_injection", F.when(said("DirectoryNotFoundException"), _made(x)))
    for space, words in namespaces.items():
        asked = F.lit(False)
        for word in words:
            asked = asked | said(word)
        df = step(df, f"using_{space.lower().replace('.', '_')}", F.when(asked & ~F.contains(x, F.lit(f"using {space};")), named(x, space)))
    bare = F.regexp_replace(x, r"using\s+System\.IO\.Compression\s*;[\r\n]*", "")
    df = df.withColumn("_bare", F.when(F.contains(x, F.lit("using System.IO.Compression;")), bare))
    df = step(df, "platform_archives", named(F.col("_bare"), product))
    for name, pattern in FOREIGN.items():
        new = _silenced(x, name, pattern, product)
        df = step(df, f"foreign_call_{name.lower().replace('.', '_')}", F.when(new != x, new))
    hit = F.exists("fixes", lambda z: z.startswith("foreign_call_"))
    df = df.withColumn("fixed", F.when(hit, named(x, product)).otherwise(x))
    df = step(df, "async_main", _waitless(x))
    df = df.withColumn("_bare", _combined(x))
    df = step(df, "drive_paths", named(F.col("_bare"), "System.IO"))
    return step(df, "harness_names", _declared(x)).drop("_new", "_bare")
