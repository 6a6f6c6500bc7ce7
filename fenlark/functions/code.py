"""Source code as column expressions: what a snippet holds, what it lacks, and how two versions differ.

All of it runs in the row, on arrays of lines or matches; nothing is exploded or shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .errors import any_of, first_of, has

PRODUCT = "Acme"  # the namespace root of the documented product; a parameter of the queries
# Signs of a placeholder in a string.
PLACEHOLDERS = [r'"path[\\/]to[\\/]', r'"your[\s_-]', '"YOUR_', r'@"[A-Z]:\\[^"]*path\\to', '"<[^>]+>"']
# What no snippet begins with, and what one has at least one of.
EXCLUDED = [r"^[\s\n]*\{[\s\n]*[\"']", r"^\s*<\?xml", r"^\s*Output:"]
INDICATORS = [r"\bclass\b", r"\bpublic\b", r"\bvoid\b", r"\bvar\b", r"\bnew\b", r"\busing\b", ";"]
# Words before a dot that are no variable.
NO_VARIABLES = "var string int bool Console File Path Directory Environment Math Convert Task Thread Image Bitmap Graphics Color new return if for foreach while using await this base typeof nameof sizeof default".split()
COLLECTIONS = r"var|string|int|bool|List|IEnumerable|string\[\]|Image\[\]|RasterImage\[\]|IList|ICollection"
METHOD = r"^\s*(public|private|protected|internal)?\s*(static\s+)?(async\s+)?(override\s+)?(virtual\s+)?(void|Task|string|int|bool|[\w.<>]+)\s+\w+\s*\("
# Patterns of application contexts.
MINIMAL = [r"\bWebApplication\s*\.", r"\bWebApplicationBuilder\b", r"\.CreateBuilder\s*\(", r"\bapp\.Map(Get|Post|Put|Delete|Patch)\s*\(", r"\bbuilder\.Services\s*\.", r"\bapp\.Run\s*\(", r"\bapp\.UseRouting\s*\("]
MVC = [r"\bController\b", r"\bIActionResult\b", r"\bViewResult\b", r"\bView\s*\(", r"\bMicrosoft\.AspNetCore\.Mvc\b", r"\bHttpContext\b", r"\bRedirectToAction\s*\(", r"\[HttpGet\]", r"\[HttpPost\]", r"\bActionResult<"]
WEBAPI = [r"\[ApiController\]", r"\bControllerBase\b", r"\bFromBody\]", r"\bFromQuery\]", r"\bFromRoute\]", r"\bMapControllers\s*\(", r"\bOk\s*\(", r"\bBadRequest\s*\(", r"\bNotFound\s*\("]
LIBRARY = [r"^\s*public\s+class\s+\w+", r"^\s*public\s+interface\s+\w+", r"^\s*public\s+static\s+class\s+\w+", r"^\s*static\s+class\s+\w+", r"^\s*internal\s+(?:static\s+)?class\s+\w+"]
ENTRY = [r"\bstatic\s+(?:async\s+)?(?:void|Task|Task<int>|int)\s+Main\s*\("]
TYPE_LINE = r"^(public|private|protected|internal|static|sealed|abstract|\s)+(class|interface|struct|enum|record)\s+\w+"
# Patterns of escalation reasons.
USAGE = [rf"using\s+{PRODUCT}\.", rf"{PRODUCT}\.\w+", r"new\s+Archive\(", r"new\s+Zip\w+", r"License\(\)", r"SetLicense\("]
SETUP = [r"License\(\)", r"SetLicense\(", r"license\.lic", rf"{PRODUCT}\..*\.License"]
STRUCTURE = [r"\b(public|private|protected|internal|static)?\s*(void|int|string|bool|var|class|interface)\s+\w+\s*\(", r"\bclass\s+\w+", r"\bnamespace\s+\w+", r"\bstatic\s+void\s+Main\s*\("]
READS, CREATES = [r"File\.ReadAllText\(", r"File\.ReadAllBytes\(", r"Directory\.GetFiles\(", r"Path\.Combine\("], [r"File\.WriteAllText\(", r"File\.WriteAllBytes\(", r"File\.Create\("]
AMBIGUOUS = [r"[\"']sample\.(zip|txt|pdf|doc)", r"[\"']test\.(zip|txt|pdf|doc)", r"[\"']input\.(zip|txt|pdf|doc)", r"[\"']archive\.(zip|rar|7z)", r"[\"']your", r"[\"']path/to/", r"[\"']<.*?>"]
SKELETON = ["further processing", "your code here", "add your", "todo", "processing steps follow", "processing follows here"]
FATAL = ["empty_code", "only_comments", "no_csharp_code_block", "snippet_too_incomplete"]
# Calls that say nothing about meaning.
NOISE = ["ToString", "GetType", "Equals", "GetHashCode", "get", "set", "Add", "Remove", "Contains"]


def bare(x: Column) -> Column:
    return F.btrim(x, F.lit(" \t\n\r\x0b\f"))


def lines(code: Column) -> Column:
    return F.split(code, "\n")


def stripped_lines(code: Column, *starts: str) -> Column:
    """Non-blank stripped lines that begin with none of starts."""
    rows = F.transform(lines(bare(code)), bare)
    out = F.filter(rows, lambda z: z != "")
    return F.filter(out, lambda z: ~z.rlike("^(?:" + "|".join(map(re.escape, starts)) + ")")) if starts else out


def meaningful(code: Column) -> Column:
    return stripped_lines(code, "//", "#", "/*", "*/", "*")


def count(x: Column, word: str) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(word), F.lit("")))


def without_comments(code: Column, block_first: bool = False) -> Column:
    """Without // and /* */ comments; which goes first matters where one holds the other's signs."""
    line, block = (lambda c: F.regexp_replace(c, "//[^\n]*", "")), (lambda c: F.regexp_replace(c, r"(?s)/\*.*?\*/", ""))
    return line(block(code)) if block_first else block(line(code))


def extraction_error(code: Column) -> Column:
    """A loop or condition that isn't closed, or braces that don't balance outside strings and comments; else empty."""
    plain = F.regexp_replace(F.regexp_replace(code, r'"(?:[^"\\]|\\.)*"', ""), r"'(?:[^'\\]|\\.)*'", "")
    plain = without_comments(plain)
    opened, closed = count(plain, "{"), count(plain, "}")
    uneven = F.concat(F.lit("malformed_extraction_unbalanced_braces (open:"), opened.cast("string"), F.lit(", close:"), closed.cast("string"), F.lit(")"))
    return F.when(code.rlike(r"(?m)\b(foreach|for|if|while)\s*\([^)]*$"), "malformed_extraction_incomplete_statement").when(opened != closed, uneven).otherwise("")


def undeclared_loop(code: Column) -> Column:
    """Whether a foreach runs over a name that the snippet never declares, sets or takes as a parameter."""
    names = F.regexp_extract_all(code, F.lit(r"foreach\s*\([^)]*\bin\s+(\w+)\)"), F.lit(1))
    known = lambda n: F.regexp_like(code, F.concat(F.lit(rf"(?:(?:{COLLECTIONS})\s+"), n, F.lit(r"\b)|(?:\b"), n, F.lit(r"\s*=)|(?:\(\s*(?:[\w.<>\[\]]+\s+)*"), n, F.lit(r"\s*[,)])")))
    return F.exists(names, lambda n: ~known(n))


def undeclared_context(code: Column) -> Column:
    """Whether a line begins with a member of a lower-case name that no line declares."""
    rows = stripped_lines(code, "//")
    names = F.array_distinct(F.filter(F.transform(rows, lambda z: F.regexp_extract(z, r"^\s*(\w+)\s*\.", 1)), lambda n: (n != "") & ~n.isin(*NO_VARIABLES) & ~n.rlike("^[A-Z]")))
    text = F.array_join(rows, "\n")
    known = lambda n: F.regexp_like(text, F.concat(F.lit(r"(?:\b"), n, F.lit(r"[^\S\n]*=)|(?:(?:var|[\w.<>\[\]]+)[^\S\n]+"), n, F.lit(r"[^\S\n]*[=;,)])|(?:\([^\S\n]*[\w.<>\[\]]+[^\S\n]+"), n, F.lit(r"[^\S\n]*[,)])|(?:foreach[^\S\n]*\(.*\b"), n, F.lit(r"[^\S\n]+in\b)")))
    return F.exists(names, lambda n: ~known(n))


def stub(code: Column) -> Column:
    """Whether a type's methods all lack bodies: a signature ends with ;, or with ) and no { in the two lines below."""

    def judged(rows: Column) -> Column:
        at = F.filter(F.transform(rows, lambda z, i: F.when(z.rlike(METHOD), i)), lambda i: i.isNotNull())
        below = lambda i: F.concat(F.coalesce(F.get(rows, i + 1), F.lit("")), F.coalesce(F.get(rows, i + 2), F.lit("")))
        open_ = F.filter(at, lambda i: F.endswith(F.get(rows, i), F.lit(";")) | (F.endswith(F.get(rows, i), F.lit(")")) & ~F.contains(below(i), F.lit("{"))))
        typed = F.exists(rows, lambda z: z.rlike(r"^(public\s+)?(abstract\s+)?(class|interface|struct)\s+\w+"))
        return typed & (F.size(at) > 0) & (F.size(open_) == F.size(at))

    return F.element_at(F.transform(F.array(stripped_lines(code, "//")), judged), 1)


def meaningless(code: Column, least: int = 3) -> Column:
    """Why a snippet means nothing by itself; null if it does."""
    rows = meaningful(code)
    used = F.filter(rows, lambda z: ~z.startswith("using ") & ~z.startswith("namespace "))
    few = F.concat(F.lit("snippet_too_incomplete (only "), F.size(rows).cast("string"), F.lit(" meaningful lines)"))
    short = F.size(rows) <= 25
    return F.when(bare(code) == "", "empty_code").when(F.size(rows) < least, few).when(F.size(used) == 0, "using_only_snippet").when(short & undeclared_loop(code), "fragment_outer_context").when(short & undeclared_context(code), "fragment_undeclared_context_variable").when(stub(code), "interface_stub_no_implementation")


def placeholders(code: Column) -> Column:
    out = None
    for p in PLACEHOLDERS:
        n = F.regexp_count(code, F.lit("(?i)" + p))
        out = n if out is None else out + n
    return out


def license_only(code: Column) -> Column:
    """A snippet of up to 8 lines that sets a licence or a meter."""
    rows = stripped_lines(code, "//", "using ")
    metered = F.exists(rows, lambda z: has(z, "Metered", "SetMeteredKey"))
    licensed = F.exists(rows, lambda z: F.contains(z, F.lit("License")) & has(z, "SetLicense", ".License(", "new License"))
    return (F.size(rows) <= 8) & (metered | licensed)


def rejected(code: Column, least: int = 1, most: int = 500) -> Column:
    """Why a snippet is left out; null if it passes. The first reason wins."""
    n = F.size(lines(bare(code)))
    sized = lambda word, sign, limit: F.concat(F.lit(f"Too {word} ("), n.cast("string"), F.lit(f" lines {sign} {limit})"))
    out = F.when(meaningless(code).isNotNull(), meaningless(code)).when(n < least, sized("short", "<", least)).when(n > most, sized("long", ">", most))
    for p in EXCLUDED:
        out = out.when(code.rlike("(?m)" + p), f"Matched exclusion pattern: {p}")
    return out.when(~any_of(code, INDICATORS, "mi"), "No C# code indicators found").when(placeholders(code) >= 3, "excessive_placeholder_content").when(license_only(code), "license_api_key_required")


def top_level(code: Column) -> Column:
    """Whether a statement stands outside all types and namespaces: a walk along the lines that keeps the depth of braces."""
    zero = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("space"), F.lit(False).alias("type"), F.lit(False).alias("found"))

    def step(s: Column, z: Column) -> Column:
        skip = (z == "") | z.startswith("//") | z.startswith("[") | z.startswith("using ")
        space, kind = ~skip & z.startswith("namespace "), ~skip & z.rlike(TYPE_LINE)
        depth = s["depth"] + count(z, "{") - count(z, "}")
        content = bare(F.replace(F.replace(z, F.lit("{"), F.lit("")), F.lit("}"), F.lit("")))
        here = (s["depth"] == 0) & ~s["space"] & ~s["type"] & (content != "") & ~content.startswith("//")
        plain = ~skip & ~space & ~kind
        return F.struct(
            F.when(space | kind, 0).when(plain, depth).otherwise(s["depth"]).alias("depth"),
            (s["space"] | space).alias("space"),
            F.when(kind, True).when(plain & (depth == 0), False).otherwise(s["type"]).alias("type"),
            (s["found"] | (plain & here)).alias("found"),
        )

    return F.aggregate(F.transform(lines(bare(code)), bare), zero, step, lambda s: s["found"])


def app_context(code: Column) -> Column:
    c = bare(code)
    mvc, api = any_of(c, MVC, "mi"), any_of(c, WEBAPI, "mi")
    library = any_of(c, LIBRARY, "mi") & ~any_of(c, ENTRY, "mi") & ~top_level(c)
    out = F.when(c == "", "unknown").when(any_of(c, MINIMAL, "mi"), "aspnet_core_minimal")
    out = out.when((c.rlike(r":\s*Controller\b") | c.rlike(r"\bView\s*\(")) & mvc, "aspnet_core_mvc").when((c.rlike(r"\[ApiController\]") | c.rlike(r":\s*ControllerBase\b")) & api, "aspnet_core_webapi")
    return out.when(mvc, "aspnet_core_mvc").when(api, "aspnet_core_webapi").when(library, "library").otherwise("console")


def fragment(code: Column) -> Column:
    """No structure, and seven of ten lines end with a semicolon."""
    rows = F.filter(F.transform(lines(code), bare), lambda z: z != "")
    ends = F.filter(rows, lambda z: F.endswith(z, F.lit(";")))
    return ~any_of(code, STRUCTURE) & (F.size(ends) >= F.size(rows) * 0.7)


def missing_context(code: Column, error: Column) -> Column:
    """Words of the error, or files that are read and never created. A missing directive can be mended."""
    low = F.lower(error)
    reads = any_of(F.regexp_replace(code, '"[^"]*"', ""), READS) & ~any_of(code, CREATES)
    return F.when(has(low, "does not exist", "not found", "undefined", "is not defined", "name does not exist in"), True).when(has(low, "missing") & has(low, "directive"), False).otherwise(reads)


def several_types(code: Column) -> Column:
    return (F.regexp_count(code, F.lit(r"\bclass\s+\w+")) > 1) | (F.regexp_count(code, F.lit(r"\bnamespace\s+\w+")) > 1)


def escalation(code: Column, language: Column, error: Column) -> Column:
    """Why a snippet needs people; the first reason wins."""
    c = bare(code)
    plain = without_comments(c, True)
    rows = F.filter(lines(plain), lambda z: bare(z) != "")
    statements = F.filter(rows, lambda z: ~z.startswith("using ") & ~z.startswith("{") & ~z.startswith("}"))
    setup = any_of(c, SETUP, "i") | has(F.lower(error), "license", "trial", "activation")
    out = F.when(c == "", "empty_code").when(~F.lower(language).isin("csharp", "c#", "cs"), "no_csharp_code_block").when(bare(plain) == "", "only_comments").when(F.size(rows) < 3, "snippet_too_incomplete")
    out = out.when(has(F.lower(c), *SKELETON) & (F.size(statements) <= 3), "snippet_too_incomplete").when(~any_of(c, USAGE, "i"), "no_product_usage").when(setup, "requires_product_specific_setup")
    return out.when(fragment(c), "fragment_without_method").when(missing_context(c, error), "missing_required_context").when(any_of(c, AMBIGUOUS, "i"), "ambiguous_input_file").when(several_types(c), "multiple_classes_or_namespaces").otherwise("other")


def usings(code: Column) -> Column:
    """Namespaces that a snippet uses: no statics, aliases or statements."""
    rows = F.filter(F.transform(F.split(without_comments(code, True), "\r?\n"), bare), lambda z: z.startswith("using ") & ~z.startswith("using static ") & ~has(z, "=", "using ("))
    return F.filter(F.transform(rows, lambda z: F.regexp_extract(z, r"^using\s+([A-Za-z_][\w.]*)\s*;", 1)), lambda n: n != "")


def fits(namespace: Column, pattern: str) -> Column:
    """x.* stands for what lies below x, anything else for itself."""
    return namespace.startswith(pattern[:-1]) if pattern.endswith(".*") else namespace == pattern


def structure(code: Column) -> dict[str, Column]:
    flags = {
        "has_usings": code.rlike(r"(?m)^\s*using\s+[\w.]+\s*;"),
        "has_namespace": code.rlike(r"\bnamespace\s+[\w.]+"),
        "has_class": F.exists(lines(code), lambda z: F.substring_index(z, "//", 1).rlike(r"\bclass\s+\w+")),
        "has_main": any_of(code, ENTRY),
        "is_async": code.rlike(r"\bawait\s+|\basync\s+"),
    }
    return flags | {"is_complete": flags["has_namespace"] | (flags["has_class"] & flags["has_main"])}


def uses_type(code: Column, name: str) -> Column:
    return any_of(code, [rf"\bnew\s+{name}\b", rf"\b{name}\.", rf"\b{name}<", rf"<{name}>", rf"\({name}\s+\w+\)"])


def calls(code: Column) -> Column:
    return F.array_sort(F.array_except(F.array_distinct(F.regexp_extract_all(code, F.lit(r"\.(\w+)\s*\("), F.lit(1))), F.array(*(F.lit(n) for n in NOISE))))


def constructed(code: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(code, F.lit(r"\bnew\s+(\w+)\s*[\(\{]"), F.lit(1))))


def members(code: Column, kinds: list[str]) -> Column:
    """Kind.Member of the given kinds, sorted, each once."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(code, F.lit(rf"\b((?:{'|'.join(kinds)})\.\w+)\b"), F.lit(1))))


def properties(code: Column) -> Column:
    """Map of assigned properties; the last assignment wins, event handlers don't count."""
    found = F.regexp_extract_all(code, F.lit(r"(?m)(\.\w+\s*=\s*[^;=]+?)(?:;|\z)"), F.lit(1))
    pairs = F.transform(found, lambda z: F.struct(F.regexp_extract(z, r"^\.(\w+)", 1).alias("k"), bare(F.regexp_extract(z, r"(?s)^\.\w+\s*=\s*(.*)$", 1)).alias("v")))
    kept = F.filter(pairs, lambda p: ~(p["v"].startswith("new ") & has(p["v"], "EventHandler")))
    last = F.filter(kept, lambda p, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def signature(code: Column, kinds: list[str]) -> Column:
    """struct of members, calls, types and properties of the code without comments."""
    c = without_comments(code)
    return F.struct(members(c, kinds).alias("members"), calls(c).alias("calls"), constructed(c).alias("types"), properties(c).alias("properties"))


def changes(a: Column, b: Column) -> dict[str, Column]:
    """What differs between two signatures: members by kind, calls, types, properties; and the score, 0 to 1."""
    kind = lambda x: F.array_distinct(F.transform(x, lambda m: F.substring_index(m, ".", 1)))
    moved = F.array_sort(F.array_union(F.array_except(a["members"], b["members"]), F.array_except(b["members"], a["members"])))
    added, gone = F.array_sort(F.array_except(b["calls"], a["calls"])), F.array_sort(F.array_except(a["calls"], b["calls"]))
    ka, kb = F.map_keys(a["properties"]), F.map_keys(b["properties"])
    lost, new = F.array_sort(F.array_except(ka, kb)), F.array_sort(F.array_except(kb, ka))
    other = F.array_sort(F.filter(F.array_intersect(ka, kb), lambda k: F.try_element_at(a["properties"], k) != F.try_element_at(b["properties"], k)))
    types = F.array_sort(a["types"]) != F.array_sort(b["types"])
    score = F.when(F.size(moved) > 0, 0.8).otherwise(0.0) + F.when(types, 0.7).otherwise(0.0) + F.least(F.lit(0.5), 0.1 * (F.size(added) + F.size(gone))) + F.least(F.lit(0.4), 0.1 * (F.size(lost) + F.size(other)))
    return {"kinds_changed": F.array_sort(kind(moved)), "calls_added": added, "calls_removed": gone, "types_changed": types, "properties_added": new, "properties_removed": lost, "properties_changed": other, "score": F.round(F.least(F.lit(1.0), score), 6)}


def mode(code: Column) -> Column:
    makes, reads = code.rlike(r"\bGenerator\b|\.Generate\s*\("), code.rlike(r"\bBarReader\b|\.Read\w*\s*\(")
    return F.when(makes & reads, "both").when(makes, "generation").when(reads, "recognition").otherwise("unknown")


def identical(a: Column, b: Column) -> Column:
    """Equal but for white space and case."""
    return F.regexp_replace(F.lower(a), r"\s+", "") == F.regexp_replace(F.lower(b), r"\s+", "")


def insert_using(code: Column, directive: Column, trigger: Column) -> Column:
    """The code with the directive after its last using line; null where it is there already or the trigger isn't."""
    rows = lines(code)
    last = F.coalesce(F.array_max(F.transform(rows, lambda z, i: F.when(bare(z).startswith("using ") & F.endswith(bare(z), F.lit(";")), i + 1))), F.lit(0))
    new = F.array_join(F.concat(F.slice(rows, F.lit(1), last), F.array(directive), F.slice(rows, last + 1, F.size(rows))), "\n")
    return F.when(~F.contains(code, directive) & F.contains(code, trigger), new)


def response(content: Column) -> tuple[Column, Column]:
    """A model's answer without its fence, and why it is no code (null if it is)."""
    c = bare(content)
    rows = F.slice(lines(c), 2, F.size(lines(c)))
    body = F.when(bare(F.element_at(rows, -1)) == "```", F.slice(rows, F.lit(1), F.size(rows) - 1)).otherwise(rows)
    clean = F.when(c.startswith("```"), F.when(F.size(lines(c)) > 1, F.array_join(body, "\n")).otherwise(F.lit(""))).otherwise(c)
    return clean, refused(clean)


# How answers that are no code begin, and what code holds.
REFUSALS = ["i cannot", "i can't", "i'm unable", "i apologize", "as an ai", "i don't have", "i'm sorry"]
PROSE = ["I ", "I'm ", "The ", "This ", "Here ", "To ", "You ", "Sorry", "Unfortunately", "Note:", "Note that"]
CODE_WORDS = ["using ", "class ", "void ", "public ", "private ", "static ", "new ", "(", ")", "{", "}", ";", "var ", "string ", "int ", "bool ", "return "]


def refused(content: Column, least: int = 2) -> Column:
    c = bare(content)
    n = sum((F.contains(c, F.lit(w)).cast("int") for w in CODE_WORDS), F.lit(0))
    prose = first_of([(True, p) for p in PROSE], lambda p: c.startswith(p), False)
    few = F.concat(F.lit("insufficient_code_indicators ("), n.cast("string"), F.lit(f"/{least})"))
    return F.when(c == "", "empty_response").when(has(F.lower(F.substring(c, 1, 100)), *REFUSALS), "llm_refusal_detected").when(prose, "prose_explanation_detected").when(n < least, few)


def deletion_fix(code: Column, fixed: Column, errors: Column) -> Column:
    """Whether a fix only took away what the errors name, or more than three lines."""
    tokens = F.concat(F.transform(errors, lambda z: F.regexp_extract(z, r"(?:CS0246|CS0103).*?'(\w+)'", 1)), F.transform(errors, lambda z: F.regexp_extract(z, r"does not contain a definition for '(\w+)'", 1)), F.transform(errors, lambda z: F.regexp_extract(z, r"'(\w+)' (?:is not|does not)", 1)))
    gone = F.exists(tokens, lambda t: (t != "") & F.contains(code, t) & ~F.contains(fixed, t))
    return gone | (F.size(lines(code)) - F.size(lines(fixed)) > 3)
