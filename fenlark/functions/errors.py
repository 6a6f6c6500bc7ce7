"""Reading of compiler and run-time errors: classes, signatures, risk, complexity and routing, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category of a compiler error and the pattern that names it, first match wins.
CATEGORIES = [
    ("missing_type", r"CS0246.*type.*'(\w+)'"),
    ("undefined_variable", r"CS0103.*name.*'(\w+)'"),
    ("missing_semicolon", r"CS1002.*;.*expected"),
    ("missing_brace", r"CS1513.*}.*expected"),
    ("type_mismatch", r"CS0029.*Cannot.*convert"),
    ("member_not_found", r"CS0117.*does not contain"),
    ("member_not_found", r"CS1061.*does not contain.*definition"),
    ("missing_namespace", r"CS0246.*namespace"),
    ("top_level_statements_error", r"CS8803.*Top-level statements"),
]
# What is advised in a category.
HINTS = [
    ("undefined_variable", "Declare variables before use or check for typos"),
    ("missing_semicolon", "Add missing semicolons"),
    ("missing_brace", "Check for missing closing braces"),
    ("type_mismatch", "Use explicit type casting or correct types"),
    ("top_level_statements_error", "Wrap code in class and Main method - top-level statements must come before other declarations"),
]
# Patterns of risk, tried in this order.
CRITICAL = [r"license.*violation", r"copyright.*infringement", r"malicious.*code", r"security.*critical", r"credential.*exposed", r"private.*key"]
HIGH = [r"file.*delete", r"directory.*remove", r"database.*drop", r"System\.IO\.File\.Delete", r"Directory\.Delete", r"DROP\s+TABLE", r"DROP\s+DATABASE", r"DELETE\s+FROM.*WHERE\s+1\s*=\s*1", r"security.*warning", r"certificate.*invalid", r"authentication.*failed"]
LOW = [r"using directive.*expected", r"namespace.*does not exist", r"type.*could not be found", r"'.*' does not contain a definition", r"The name '.*' does not exist", r"cannot convert from.*to", r"missing semicolon", r"expected '\)'", r"expected '\}'"]
LOW_RUNTIME = ["FileNotFoundException", "ArgumentNullException", "ArgumentException", "InvalidOperationException", "NullReferenceException"]
RETRIES = [("critical", 0), ("high", 1), ("medium", 3), ("low", 5)]
# Category of a compiler code, and how hard a category is.
CODE_CATEGORY = [("CS0103", "undefined_variable"), ("CS0246", "missing_type"), ("CS0029", "type_mismatch"), ("CS1002", "missing_semicolon"), ("CS1513", "missing_brace"), ("CS1061", "member_not_found"), ("CS0104", "ambiguous_reference"), ("CS7036", "missing_argument"), ("CS0117", "member_not_found")]
BASE_SCORE = [("missing_type", 0.2), ("undefined_variable", 0.3), ("missing_namespace", 0.25), ("missing_argument", 0.45), ("type_mismatch", 0.5), ("missing_semicolon", 0.2), ("missing_brace", 0.2), ("member_not_found", 0.75), ("ambiguous_reference", 0.75), ("runtime_exception", 0.85), ("io_exception", 0.75), ("null_reference", 0.7), ("unknown", 0.55)]
# Words of the domain, and signs that a message is cryptic.
DOMAIN = [r"Acme\.\w+", r"Archive\(", "RarArchive", "SevenZipArchive", "CompressionLevel", "CompressionMethod", "EncryptionSettings", "DeflateCompressionSettings", "BZip2CompressionSettings", "ChartType", "DocumentBuilder", "Watermark"]
CRYPTIC = [r"System\.", r"at\s+\w+\.", r"---.*---", r"\.\.\."]
# Classes of run-time failures and the words (any of them) that name them, in this order.
RUNTIME = [
    ("missing_directory", ["directorynotfound", "could not find a part of the path"]),
    ("disposed_stream", ["disposed", "cannot access a closed"]),
    ("invalid_password", ["password", "decrypt", "invalid password"]),
    ("sevenz_format_issue", ["wrong compression method", "encoded header"]),
]
API_MISMATCH = ["CS0246", "CS0117", "CS1061", r"Microsoft\.AspNetCore", r"RarArchive\.Open", "CompressionLevel"]
EXCEPTION_WORDS = ["Exception", "Error", "NullReference", "ArgumentNull", "FileNotFound", "IOException"]


def any_of(x: Column, patterns: list[str], flags: str = "") -> Column:
    """Whether any pattern is found. One alternation, so that a text is read once."""
    return x.rlike(f"(?{flags})" * bool(flags) + "|".join(f"(?:{p})" for p in patterns))


def has(x: Column, *words: str) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(x, F.lit(w)) for w in words])


def first_of(pairs, test, otherwise) -> Column:
    out = None
    for value, key in pairs:
        out = F.when(test(key), value) if out is None else out.when(test(key), value)
    return out.otherwise(otherwise)


def joined(errors: Column, by: str = "\n") -> Column:
    return F.array_join(errors, by)


def diagnostics(output: Column, kind: str) -> Column:
    """Stripped lines of a build's output that report an error or a warning."""
    lines = F.filter(F.split(output, "\n"), lambda z: has(z, f": {kind} ", f"{kind} CS"))
    return F.transform(lines, F.trim)


def category(error: Column) -> Column:
    return first_of(CATEGORIES, lambda p: error.rlike("(?i)" + p), "unknown")


def hints(errors: Column, namespaces: dict[str, str]) -> Column:
    """Advice for a list of errors: namespaces of missing types first, then a line a category."""
    missing = F.filter(errors, lambda e: category(e) == "missing_type")
    names = F.transform(missing, lambda e: F.regexp_extract(e, r"type.*'(\w+)'", 1))
    spaces = F.array_sort(F.array_distinct(F.filter(F.transform(names, lambda t: first_of([(v, k) for k, v in namespaces.items()], lambda k: t == k, None)), lambda s: s.isNotNull())))
    out = [F.when(F.size(spaces) > 0, F.concat(F.lit("Add using statements: "), F.array_join(spaces, ", ")))]
    kinds = F.transform(errors, category)
    out += [F.when(F.array_contains(kinds, c), F.lit(h)) for c, h in HINTS]
    return F.filter(F.array(*out), lambda h: h.isNotNull())


def risk(text: Column, low: list[str]) -> Column:
    """critical, high, low or medium; without a text medium."""
    return F.when(text == "", "medium").when(any_of(text, CRITICAL, "i"), "critical").when(any_of(text, HIGH, "i"), "high").when(any_of(text, low, "i"), "low").otherwise("medium")


def budget(level: Column) -> Column:
    return first_of([(n, k) for k, n in RETRIES], lambda k: level == k, 3)


def routed(level: Column, attempt: Column, kind: str) -> tuple[Column, Column]:
    """Whether to try again, and why not."""
    most = budget(level)
    over = F.concat(level, F.lit(" risk error exceeded max retries ("), most.cast("string"), F.lit(") at attempt "), attempt.cast("string"))
    reason = F.when(level == "critical", F.concat(F.lit(f"CRITICAL risk {kind} error detected at attempt "), attempt.cast("string"))).when(attempt > most, over)
    return reason.isNull(), reason


def code_category(code: Column) -> Column:
    io = has(code, "FileNotFoundException", "DirectoryNotFoundException", "IOException")
    runtime = has(code, *EXCEPTION_WORDS) & has(F.upper(code), "EXCEPTION", "ERROR")
    kind = F.when(has(code, "NullReferenceException", "ArgumentNullException"), "null_reference").when(io, "io_exception").otherwise("runtime_exception")
    return F.coalesce(first_of([(v, k) for k, v in CODE_CATEGORY], lambda k: code == k, None), F.when(runtime, kind), F.lit("unknown"))


def base_score(code: Column) -> Column:
    """How hard an error of this code is. The category is told once and looked up: a branch for each score would hold the whole of it again."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in BASE_SCORE for x in pair)), code_category(code)), F.lit(0.55))


def domain(message: Column) -> Column:
    return any_of(message, DOMAIN, "i") | has(message, "ArchiveEntry", "RarArchiveLoadOptions", "SevenZipArchiveLoadOptions")


def cryptic(message: Column) -> Column:
    return (F.length(message) > 200) | has(message, "\n") | any_of(message, CRYPTIC)


def complexity(code: Column, message: Column, retries: Column, errors: Column, history: Column) -> Column:
    """0 to 1: the category's score, more for retries, further errors, domain words, cryptic messages and a history of over two."""
    more = 0.1 * F.least(F.greatest(retries, F.lit(0)), F.lit(2)) + F.when(errors > 1, F.least(F.lit(0.15), 0.05 * (errors - 1))).otherwise(0.0)
    flags = F.when(domain(message), 0.1).otherwise(0.0) + F.when(cryptic(message), 0.08).otherwise(0.0) + F.when(history > 2, 0.05).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), base_score(code) + more + flags))


def tier(score: Column, names: tuple[str, str, str] = ("small", "medium", "large")) -> Column:
    return F.when(score < 0.4, names[0]).when(score < 0.7, names[1]).otherwise(names[2])


def signature(errors: Column) -> Column:
    """The first compiler code, else the first exception (a missing file with its name), else a class of trouble."""
    text = joined(errors, " ")
    low, name = F.lower(text), F.regexp_extract(text, r"\b(\w+Exception):", 1)
    file = F.regexp_extract(text, r"'([^']+\.\w+)'", 1)
    code = F.get(F.filter(F.transform(errors, lambda e: F.regexp_extract(e, r"(CS[0-9]{4})", 1)), lambda c: c != ""), F.lit(0))
    found = F.when(name == "", None).when((name == "FileNotFoundException") & (file != ""), F.concat(F.lit("MISSING_FILE:"), file)).otherwise(name)
    rest = F.when(has(low, "password"), "PASSWORD_ISSUE").when(has(low, "file") & has(low, "not found", "missing"), "MISSING_FILE").when(has(low, "directory") & has(low, "not found"), "MISSING_DIRECTORY").when(has(low, "disposed"), "DISPOSED_STREAM").otherwise("RUNTIME_ERROR")
    return F.coalesce(code, found, rest)


def signatures(errors: Column) -> Column:
    """All of them, in order, each once."""
    text = joined(errors, " ")
    low, file = F.lower(text), F.regexp_extract(text, r"'([^']+\.\w+)'", 1)
    codes = F.filter(F.transform(errors, lambda e: F.regexp_extract(e, r"(CS[0-9]{4})", 1)), lambda c: c != "")
    names = F.transform(F.regexp_extract_all(text, F.lit(r"\b(\w+Exception):"), F.lit(1)), lambda n: F.when((n == "FileNotFoundException") & (file != ""), F.concat(F.lit("MISSING_FILE:"), file)).otherwise(n))
    words = [F.when(has(low, "password"), "PASSWORD_ISSUE"), F.when(has(low, "file") & has(low, "not found", "missing"), "MISSING_FILE")]
    found = F.array_distinct(F.concat(codes, names, F.filter(F.array(*words), lambda w: w.isNotNull())))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("RUNTIME_ERROR")))


def exception(output: Column) -> tuple[Column, Column, Column]:
    """Type, message up to the stack, and the first lines of the stack (null without)."""
    pattern = r"(?s)([A-Za-z.]+Exception):\s*(.+?)(?=\n\s+at\s|\z)"
    unhandled = r"(?s)Unhandled exception[.:]\s*([A-Za-z.]+Exception):\s*(.+?)(?=\n\s+at\s|\z)"
    kind = F.nullif(F.when(output.rlike(unhandled), F.regexp_extract(output, unhandled, 1)).otherwise(F.regexp_extract(output, pattern, 1)), F.lit(""))
    message = F.trim(F.when(output.rlike(unhandled), F.regexp_extract(output, unhandled, 2)).otherwise(F.regexp_extract(output, pattern, 2)))
    stack = F.nullif(F.regexp_extract(output, r"(?s)(\n\s+at\s.+)", 1), F.lit(""))
    first = F.btrim(F.array_join(F.slice(F.split(stack, "\n"), 1, 5), "\n"), F.lit(" \n"))
    return kind, F.when(kind.isNotNull(), message), F.when(kind.isNotNull(), first)


def runtime_class(text: Column) -> Column:
    low = F.lower(text)
    missing = has(low, "filenotfound", "could not find file")
    return first_of([("missing_rar_file", None)], lambda _: missing & has(low, ".rar"), F.when(missing, "missing_file").otherwise(first_of(RUNTIME, lambda w: has(low, *w), "unhandled_exception")))


def build_failure(stderr: Column) -> Column:
    return F.coalesce(F.startswith(stderr, F.lit("Build failed:")) | has(stderr, "Restore failed:", "error CS", "error MSB"), F.lit(False))


def api_mismatch(log: Column) -> Column:
    return any_of(log, API_MISMATCH, "i")


def missing_name(text: Column, word: str, what: str) -> Column:
    """Base name of the quoted path after the first of three phrases; null without."""
    phrases = [rf"(?i){what} '([^']+)'", rf'(?i){what} "([^"]+)"', rf"(?i){word}[^'\"]*['\"]([^'\"]+)['\"]"]
    base = lambda p: F.nullif(F.element_at(F.split(F.regexp_replace(F.replace(F.regexp_extract(text, p, 1), F.lit("\\"), F.lit("/")), "/+$", ""), "/"), -1), F.lit(""))
    return F.coalesce(*map(base, phrases))


def missing_file(text: Column) -> Column:
    return missing_name(text, "FileNotFoundException", "Could not find file")


def missing_directory(text: Column) -> Column:
    name = missing_name(text, "DirectoryNotFoundException", "Could not find a part of the path")
    return F.when(~has(name, "."), name)


def strategy(log: Column) -> Column:
    """Hints by the codes and words in a log, as lines; null without."""
    rules = [
        (has(log, "CS0246", "could not be found"), ["Add missing 'using' statements for the namespace containing the missing type."]),
        (has(log, "CS8803", "Top-level statements"), ["Wrap all code in 'class Program { static void Main() { ... } }' structure."]),
        (has(log, "FileNotFoundException", "DirectoryNotFoundException"), ["Check file paths - use paths from the available test data list.", "Replace placeholder paths with actual test file names."]),
        (has(log, "CS0029") | has(F.lower(log), "type mismatch"), ["Check type compatibility - use explicit casting if needed."]),
        (has(log, "CS1061", "does not contain"), ["Verify API method/property names against documentation.", "The member may not exist in this API version."]),
    ]
    lines = F.concat_ws("\n", *(F.when(test, "\n".join(f"- {h}" for h in say)) for test, say in rules))
    return F.nullif(lines, F.lit(""))


def regressed(before: Column, after: Column) -> Column:
    """More errors by half and by two, or two new codes; any error where there was none."""
    codes = lambda x: F.array_distinct(F.filter(F.transform(x, lambda e: F.regexp_extract(e, r"\b(CS[0-9]+)\b", 1)), lambda c: c != ""))
    more = (F.size(after) > 1.5 * F.size(before)) & (F.size(after) >= F.size(before) + 2)
    return F.when(F.size(before) == 0, F.size(after) > 0).otherwise(more | (F.size(F.array_except(codes(after), codes(before))) >= 2))


def enrichment(attempt: Column) -> Column:
    return F.when(attempt == 0, "tier1_minimal").when(attempt == 1, "tier2_with_examples").otherwise("tier3_expanded")
