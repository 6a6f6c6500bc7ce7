"""Paths in code as column expressions: what role a file has, whether a line reads or writes it, and what a fix did to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .errors import any_of, has
from .markdown import once

# Words of a file's name by role, tried in this order.
ROLES = [
    ("output", "dest destination export generated outfile output rendered result".split()),
    ("template", "blank empty master skeleton stub template".split()),
    ("input", "data import in input load read source src".split()),
    ("fixture", "demo example fixture sample test".split()),
]
# Calls that write and that read.
WRITES = [r"\.Save\s*\(", r"\bFile\.(?:WriteAllText|WriteAllBytes|WriteAllLines|Create)\s*\(", r"\bDirectory\.CreateDirectory\s*\(", r"\.(?:Export|Render|WriteTo)\w*\s*\("]
READS = [r"\bnew\s+[A-Z][A-Za-z0-9_<>]*\s*\(", r"\.(?:Load|Open|Import|Read|FromFile)\w*\s*\(", r"\bFile\.(?:OpenRead|ReadAllText|ReadAllBytes|ReadAllLines)\s*\("]
EXTENSIONS = ["docx", "doc", "pdf", "html", "htm", "txt", "csv", "xml", "rtf", "odt", "xls", "xlsx", "png", "jpg", "zip", "7z", "gz", "rar"]
SOURCES = ["input", "template", "fixture"]


def base(path: Column) -> Column:
    return F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)


def role(path: Column, operation: Column | None = None) -> Column:
    """A written file is an output; else the words of the name tell, else a file that is read is an input."""
    stem = F.regexp_replace(F.lower(base(path)), r"(?<=.)\.[^.]*$", "")

    def told(words: Column) -> Column:
        out = F.when(F.lit(False) if operation is None else operation == "write", "output")
        for name, hints in ROLES:
            out = out.when(F.arrays_overlap(words, F.array(*(F.lit(h) for h in hints))), name)
        return out.when(F.lit(False) if operation is None else operation == "read", "input").otherwise("unknown")

    return once(F.split(stem, "[^a-z0-9]+"), told)


def operation(line: Column) -> Column:
    return F.when(any_of(line, WRITES, "i"), "write").when(any_of(line, READS, "i"), "read").otherwise("unknown")


def crosses(a: Column, b: Column) -> Column:
    return (a == "output") != (b == "output")


def occurrences(code: Column) -> Column:
    """array<struct<literal, role, operation, line>> of the file names in strings; addresses don't count."""

    def of_line(z: Column, i: Column) -> Column:
        found = F.filter(F.transform(F.regexp_extract_all(z, F.lit(r'@?"([^"\r\n]+?\.[A-Za-z0-9]{1,8})"'), F.lit(1)), lambda x: F.trim(x)), lambda x: ~has(x, "://"))
        return once(operation(z), lambda op: F.transform(found, lambda x: F.struct(x.alias("literal"), role(x, op).alias("role"), op.alias("operation"), (i + 1).alias("line"))))

    return F.flatten(F.transform(F.split(code, "\r?\n"), of_line))


def role_issues(before: Column, after: Column) -> Column:
    """array<struct<before, after, operation, issue>>: n-th literal against n-th literal of each operation, where
    an output became a source or the other way round, or a written name now reads like a source."""

    def of_kind(op: str) -> Column:
        x, y = (F.filter(z, lambda o: o["operation"] == op) for z in (before, after))
        pairs = F.filter(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: p["x"].isNotNull() & p["y"].isNotNull())

        def judged(p: Column) -> Column:
            a, b = role(p["x"]["literal"]), role(p["y"]["literal"])
            ea, eb = F.when(a != "unknown", a).otherwise(p["x"]["role"]), F.when(b != "unknown", b).otherwise(p["y"]["role"])
            issue = F.when(p["x"]["literal"] == p["y"]["literal"], None).when(crosses(ea, eb), "crosses").when(F.lit(op == "write") & b.isin(*SOURCES), "source_like")
            return F.struct(p["x"]["literal"].alias("before"), p["y"]["literal"].alias("after"), F.lit(op).alias("operation"), issue.alias("issue"))

        return F.filter(F.transform(pairs, judged), lambda q: q["issue"].isNotNull())

    return F.concat(*(of_kind(op) for op in ("write", "read", "unknown")))


def file_literals(code: Column) -> Column:
    """Parts of string literals that end in a known extension, in order, each once."""
    strings = F.regexp_extract_all(code, F.lit(r'@"((?:[^"]|"")*)"|\$?"([^"\\]*(?:\\.[^"\\]*)*)"'), F.lit(0))
    inner = F.transform(strings, lambda s: F.regexp_replace(F.regexp_replace(s, r'^[@$]?"|"$', ""), r"\\+", "/"))
    parts = F.transform(F.flatten(F.transform(inner, lambda s: F.split(s, "/"))), lambda p: F.trim(F.regexp_replace(p, r"\{[^}]*\}", "")))
    return F.array_distinct(F.filter(parts, lambda p: F.lower(p).rlike(r"\.(?:" + "|".join(EXTENSIONS) + ")$")))
