"""Articles as column expressions: fenced blocks, sections, the prose around a block, and what is wrong with them.

A document is read in its own row, as an array of lines; nothing is exploded, shuffled or gathered again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .code import bare

# Lines that look like code; words that make a line code; names in quotes.
CODE_LINES = [r"^\s*using\s+[A-Za-z]", r"^\s*(?:public|private|internal|protected|static)?\s*(?:class|struct|interface|enum|record)\s+\w+", r"^\s*namespace\s+[A-Za-z]", r"^\s{4}(?:static|public|private|internal|protected)\s"]
OUTSIDE = [r"^\s*using\s+[A-Z]\w*(?:\.[A-Z]\w*)*;", r"^\s*(?:public|private|internal|protected)?\s*(?:class|struct|interface|enum|record)\s+\w+", r"^\s*namespace\s+[A-Z]\w*(?:\.[A-Z]\w*)*"]
TOKENS = r";\s*$|^\s*[{}]|\busing\b|\bvar\b|\bpublic\b|\bprivate\b|\bclass\b|\bvoid\b|\bnamespace\b|\bstatic\b|\bnew\b"
NAME = r'(?i)"([\w\s.\-]+\.(?:docx|pdf|xlsx|zip|cs|txt|html|odt|rtf))"'
SAVED = r'(?i)\.Save\s*\(\s*"([\w\s.\-]+\.(?:docx|pdf|odt|rtf))"'
LOADED = r'(?i)new\s+Document\s*\(\s*"([\w\s.\-]+\.(?:docx|doc|odt|rtf))"'


def once(x: Column, f) -> Column:
    """f(x) with x computed once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def lines(md: Column) -> Column:
    return F.split(md, "\n")


def fence_lines(rows: Column) -> Column:
    """Places, from 0, of the lines that open or close a fence."""
    return F.filter(F.transform(rows, lambda z, i: F.when(z.startswith("```"), i)), lambda i: i.isNotNull())


def part(rows: Column, start: Column, end: Column) -> Column:
    """Lines start to end (exclusive), joined."""
    return F.array_join(F.slice(rows, start + 1, F.greatest(end - start, F.lit(0))), "\n")


def signature(code: Column) -> Column:
    return F.sha2(F.replace(bare(code), F.lit("\r\n"), F.lit("\n")), 256)


def blocks(md: Column) -> Column:
    """array<struct<block_index, start_line, end_line, language, content, signature>> of the closed fences; lines from 1."""

    def paired(rows: Column) -> Column:
        return once(fence_lines(rows), lambda f: F.transform(
            F.filter(F.transform(f, lambda i, k: F.struct(i.alias("a"), F.get(f, k + 1).alias("b"), k.alias("k"))), lambda p: (p["k"] % 2 == 0) & p["b"].isNotNull()),
            lambda p: once(part(rows, p["a"] + 1, p["b"]), lambda code: F.struct((p["k"] / 2).cast("int").alias("block_index"), (p["a"] + 1).alias("start_line"), (p["b"] + 1).alias("end_line"), F.lower(bare(F.substring(F.get(rows, p["a"]), F.lit(4), F.length(F.get(rows, p["a"]))))).alias("language"), code.alias("content"), signature(code).alias("signature")))))

    return once(lines(md), paired)


def head(code: Column, n: int = 5) -> Column:
    """The first n lines, stripped, lowered, without closing semicolons; blank ones drop."""
    some = F.filter(F.transform(F.slice(lines(code), 1, n), bare), lambda z: z != "")
    return F.transform(some, lambda z: F.rtrim(F.lower(z), F.lit(";")))


def resolved(found: Column, index: Column, wanted: Column, original: Column) -> Column:
    """struct<block, fallback, reason>: the block at the index if it has the signature; else the only one
    that has it; else the only one with the same head; else why none is taken."""
    exact = F.filter(found, lambda b: b["signature"] == wanted)
    alike = F.filter(found, lambda b: (head(b["content"]) == head(original)) & (F.size(head(original)) > 0))
    there = F.exists(found, lambda b: (b["block_index"] == index) & (b["signature"] == wanted))
    places = lambda x: F.concat(F.lit("["), F.array_join(F.transform(x, lambda b: b["block_index"].cast("string")), ", "), F.lit("]"))

    def decided(x: Column) -> Column:
        one = F.get(F.when(F.size(x["exact"]) > 0, x["exact"]).otherwise(x["alike"]), F.lit(0))["block_index"]
        n, m = F.size(x["exact"]), F.size(x["alike"])
        reason = F.when(n > 1, F.concat(F.lit("duplicate_signature: "), n.cast("string"), F.lit(" blocks at indices "), places(x["exact"]))).when((n == 0) & (m > 1), F.concat(F.lit("fuzzy_ambiguous: "), m.cast("string"), F.lit(" blocks at indices "), places(x["alike"]))).when((n == 0) & (m == 0), "signature_not_found")
        return F.struct(F.when(there, index).when(reason.isNull(), one).alias("block"), (~there & reason.isNull()).alias("fallback"), F.when(~there, reason).alias("reason"))

    return once(F.struct(exact.alias("exact"), alike.alias("alike")), decided)


def replaced(md: Column, block: Column, code: Column, language: Column) -> Column:
    """md with the block's fence, language and content exchanged; null where both are as wanted already."""
    tag = F.coalesce(F.nullif(block["language"], F.lit("")), F.nullif(language, F.lit("")), F.lit("csharp"))
    same = (F.rtrim(block["content"], F.lit("\n")) == F.rtrim(code, F.lit("\n"))) & (block["language"] == tag)
    rows = lines(md)
    new = F.array_join(F.concat(F.slice(rows, F.lit(1), block["start_line"] - 1), F.array(F.concat(F.lit("```"), tag), code, F.lit("```")), F.slice(rows, block["end_line"] + 1, F.size(rows))), "\n")
    return F.when(~same, new)


def heading_before(rows: Column, at: Column) -> Column:
    """Text of the last heading above line at (from 0); null without."""
    above = F.filter(F.slice(rows, F.lit(1), at), lambda z: bare(z).startswith("#"))
    return F.when(F.size(above) > 0, bare(F.ltrim(bare(F.element_at(above, -1)), F.lit("#"))))


def prose_before(rows: Column, at: Column) -> Column:
    """struct<text, start>: the paragraph nearest above line at, up to a blank line, heading, fence or shortcode; start from 1."""
    last = F.array_max(F.transform(F.slice(rows, F.lit(1), at), lambda z, i: F.when(bare(z) != "", i)))
    stops = lambda z: (bare(z) == "") | bare(z).startswith("#") | bare(z).startswith("```") | bare(z).startswith("{{%")
    stop = F.coalesce(F.array_max(F.transform(F.slice(rows, F.lit(1), last + 1), lambda z, i: F.when(stops(z), i))), F.lit(-1))
    some = F.transform(F.slice(rows, stop + 2, last - stop), lambda z: F.rtrim(z))
    return F.struct(F.coalesce(bare(F.array_join(some, "\n")), F.lit("")).alias("text"), (stop + 2).alias("start"))


def paired_prose(md: Column) -> Column:
    """array<struct<block_index, heading, prose, line, code>>: blocks with the prose above them, if there is any."""
    found = once(lines(md), lambda rows: F.transform(blocks(md), lambda b: once(prose_before(rows, b["start_line"] - 1), lambda p: F.struct(b["block_index"].alias("block_index"), heading_before(rows, b["start_line"] - 1).alias("heading"), p["text"].alias("prose"), p["start"].alias("line"), b["content"].alias("code")))))
    return F.filter(found, lambda s: s["prose"] != "")


def names(text: Column, pattern: str = NAME) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))))


def inside(rows: Column) -> Column:
    """For each line whether a fence is open above it."""
    return once(fence_lines(rows), lambda f: F.transform(rows, lambda _, i: F.size(F.filter(f, lambda j: j < i)) % 2 == 1))


def outside_code(rows: Column, patterns: list[str]) -> Column:
    """Places, from 0, of code-like lines outside fences."""
    test = "|".join(f"(?:{p})" for p in patterns)
    return once(inside(rows), lambda held: F.filter(F.transform(rows, lambda z, i: F.when(~F.get(held, i) & ~z.startswith("```") & z.rlike(test), i)), lambda i: i.isNotNull()))


def broken_fences(md: Column) -> Column:
    """Line, from 1, at which each run of code outside fences begins."""
    return once(outside_code(lines(md), CODE_LINES), lambda at: F.transform(F.filter(at, lambda i: ~F.array_contains(at, i - 1)), lambda i: i + 1))


def fence_warnings(md: Column) -> Column:
    """Lines, from 1, with code outside fences, and the last line if a fence stays open."""
    rows = lines(md)
    n = F.when(F.endswith(md, F.lit("\n")) | (md == ""), F.size(rows) - 1).otherwise(F.size(rows))
    return F.concat(F.transform(outside_code(rows, OUTSIDE), lambda i: i + 1), F.when(F.size(fence_lines(rows)) % 2 == 1, F.array(n)).otherwise(F.array().cast("array<int>")))


def prose(content: Column) -> Column:
    """Three lines or more, under a tenth of them code."""
    rows = F.filter(lines(content), lambda z: bare(z) != "")
    return (F.size(rows) >= 3) & (F.size(F.filter(rows, lambda z: z.rlike(TOKENS))) / F.size(rows) < 0.1)


def chain_breaks(found: Column) -> Column:
    """array<struct<line, unexpected, saved>>: blocks that load what the block saved last didn't save. A
    block that only loads ends the chain."""
    none = F.array().cast("array<string>")
    zero = F.struct(none.alias("saved"), F.array().cast("array<struct<line:int,unexpected:array<string>,saved:array<string>>>").alias("out"))

    def step(s: Column, b: Column) -> Column:
        saved, loaded = names(b["content"], SAVED), names(b["content"], LOADED)
        odd = F.array_sort(F.array_except(loaded, s["saved"]))
        hit = (F.size(s["saved"]) > 0) & (F.size(odd) > 0)
        now = F.when(F.size(saved) > 0, saved).when(F.size(loaded) > 0, none).otherwise(s["saved"])
        return F.struct(now.alias("saved"), F.when(hit, F.concat(s["out"], F.array(F.struct(b["start_line"].alias("line"), odd.alias("unexpected"), s["saved"].alias("saved"))))).otherwise(s["out"]).alias("out"))

    return F.aggregate(found, zero, step, lambda s: s["out"])


def sections(rows: Column) -> Column:
    """array<struct<start, end>>: from each heading line to the next, the lines before the first as one; from 0, end exclusive."""
    heads = F.filter(F.transform(rows, lambda z, i: F.when(z.startswith("#"), i)), lambda i: i.isNotNull())
    starts = F.array_distinct(F.concat(F.array(F.lit(0)), heads))
    return once(starts, lambda s: F.transform(s, lambda a, k: F.struct(a.alias("start"), F.coalesce(F.get(s, k + 1), F.size(rows)).alias("end"))))


def name_mismatches(md: Column) -> Column:
    """array<struct<line, prose, code>>: lines of prose that name files which their section's code doesn't, where that names any."""

    def judged(rows: Column, s: Column) -> Column:
        own = F.slice(rows, s["start"] + 1, s["end"] - s["start"])

        def found(x: Column) -> Column:
            closed = F.size(fence_lines(x["own"])) - F.size(fence_lines(x["own"])) % 2
            code = F.array_join(F.filter(x["own"], lambda z, i: F.get(x["held"], i) & ~z.startswith("```") & (F.size(F.filter(fence_lines(x["own"]), lambda j: j < i)) < closed)), "\n")
            return once(names(code), lambda c: F.filter(F.transform(x["own"], lambda z, i: F.struct((s["start"] + i + 1).alias("line"), F.when(~F.get(x["held"], i) & ~z.startswith("```") & (F.size(c) > 0), F.array_sort(F.array_except(names(z), c))).alias("prose"), c.alias("code"))), lambda m: F.size(m["prose"]) > 0))

        return once(F.struct(own.alias("own"), inside(own).alias("held")), found)

    return once(lines(md), lambda rows: F.flatten(F.transform(sections(rows), lambda s: judged(rows, s))))


def repaired(md: Column) -> Column:
    """struct<text, repairs>: a fence that is still open is closed before the next heading and at the end. A
    fence or heading may be indented."""
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("open"), F.lit(0).alias("n"))
    last = F.endswith(md, F.lit("\n")) | (md == "")
    rows = F.when(last, F.slice(lines(md), F.lit(1), F.size(lines(md)) - 1)).otherwise(lines(md))

    def step(s: Column, z: Column) -> Column:
        fence, cut = bare(z).startswith("```"), s["open"] & bare(z).startswith("#") & ~bare(z).startswith("```")
        return F.struct(F.concat(s["out"], F.when(cut, F.array(F.lit("```"), z)).otherwise(F.array(z))).alias("out"), F.when(fence, ~s["open"]).when(cut, False).otherwise(s["open"]).alias("open"), (s["n"] + cut.cast("int")).alias("n"))

    def end(s: Column) -> Column:
        text = F.concat(F.array_join(s["out"], "\n"), F.when(last & (F.size(s["out"]) > 0), "\n").otherwise(""))
        return F.struct(F.concat(text, F.when(s["open"], "```\n").otherwise("")).alias("text"), (s["n"] + s["open"].cast("int")).alias("repairs"))

    return F.aggregate(rows, zero, step, end)


def strip_links(md: Column) -> Column:
    """Links become their text; mail addresses stay links."""
    return F.regexp_replace(md, r"\[([^\]]+)\]\((?!mailto:)[^)]*\)", "$1")
