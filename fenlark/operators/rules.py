"""Many rules on many texts: one pass finds which literals occur, and only rules whose literals do are tried."""

from __future__ import annotations

import re._constants as sre
import re._parser as parser

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 3  # characters of a literal that is worth looking for
BYTES = 8 << 20  # bytes of rules that are sent to the texts at once; more rules are looked for in several passes
_LOWER = {i: i + 32 for i in range(65, 91)}
FIELDS = "id string, severity string, issue string, code string, missing string, required string, intent array<string>, context array<string>, types array<string>"


def literal(pattern: str) -> str:
    """The longest stretch of characters, A-Z in lower case, that all matches of a pattern hold; empty if none is known."""
    try:
        tree = parser.parse(pattern)
    except Exception:  # another dialect: the rule is tried everywhere
        return ""
    runs = [""]

    def walk(items, ignore: bool) -> None:
        for op, value in items:
            if op is sre.LITERAL and (not ignore or value < 128):
                runs[-1] += chr(value)
                continue
            if op is sre.SUBPATTERN:
                walk(value[-1], ignore or bool(value[1] & parser.SRE_FLAG_IGNORECASE))
                continue
            runs.append("")
            if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] >= 1:
                walk(value[2], ignore)
                runs.append("")

    walk(tree, bool(tree.state.flags & parser.SRE_FLAG_IGNORECASE))
    if tree.state.flags & parser.SRE_FLAG_VERBOSE:
        return ""
    return max((r.translate(_LOWER) for r in runs), key=len)


def _hits(automata):
    """Texts with the numbers of the rules whose literal is in the text, or one of whose words is in the context."""

    def run(batches):
        code, words = automata.value
        for batch in batches:
            out = []
            for text, blob in zip(batch.column("text").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                found: set[int] = set()
                for machine, x in ((code, text), (words, blob)):
                    if machine is not None and x:
                        for _, rules in machine.iter(x.translate(_LOWER)):
                            found.update(rules)
                out.append(sorted(found))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "rules"])

    return run


def _machine(keys: dict[str, list[int]]):
    if not keys:
        return None
    machine = ahocorasick.Automaton()
    for key, numbers in keys.items():
        machine.add_word(key, numbers)
    machine.make_automaton()
    return machine


def _blocks(rules: list, bound: int) -> list[tuple[dict, dict, list[int], list[int]]]:
    """Rules in blocks of `bound` bytes: literals of code and words of intent with the rules' numbers, the numbers of
    the rules that are tried everywhere, and all of the block's numbers."""
    blocks, size = [({}, {}, [], [])], 0
    for n, r in enumerate(rules):
        keys = [w.translate(_LOWER) for w in r["intent"] or [] if w] if r["required"] is not None else [literal(r["code"])] if r["code"] is not None else []
        size += _bytes(r)
        if size > bound and blocks[-1][3]:
            blocks.append(({}, {}, [], []))
            size = _bytes(r)
        code, words, always, numbers = blocks[-1]
        numbers.append(n)
        if r["required"] is None and keys and len(keys[0]) < LEAST or r["required"] is not None and len(keys) < len(r["intent"] or []):
            always.append(n)
            continue
        for k in keys:
            (code if r["required"] is None else words).setdefault(k, []).append(n)
    return blocks


def _bytes(rule) -> int:
    """About what a rule takes, its patterns and words."""
    return sum(len(x) if isinstance(x, str) else sum(map(len, filter(None, x))) for x in rule.values() if x)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("blob", F.lit("")).alias("blob"), *(c for c in docs.columns if c not in ("id", "text", "blob")))


def _tried(docs: DataFrame, block: tuple) -> DataFrame:
    """docs with rule, the number of each rule of a block that isn't ruled out by a literal."""
    code, words, always, _ = block
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", rules array<int>"
    sent = docs.sparkSession.sparkContext.broadcast((_machine(code), _machine(words)))
    found = docs.mapInArrow(_hits(sent), kinds)
    every = F.concat("rules", F.array(*map(F.lit, always))) if always else F.col("rules")
    return found.select(*docs.columns, F.explode(every).alias("rule"))


def candidates(docs: DataFrame, rules: list, bound: int = BYTES) -> DataFrame:
    """docs (id, text, blob, further columns) with rule, the number of each rule that isn't ruled out by a literal.

    A rule with code needs that pattern's longest literal in the text; one with required code speaks only
    where one of its intent words is in blob. Rules without a literal of LEAST characters are tried on all
    texts. Rules are a table of configuration, read by the caller; they go out in blocks of `bound` bytes at
    most, one after the other.
    """
    docs, out = _plain(docs), None
    for block in _blocks(rules, bound):
        found = _tried(docs, block)
        out = found if out is None else out.unionByName(found)
    return out


def findings(docs: DataFrame, rules: DataFrame, bound: int = BYTES) -> DataFrame:
    """(id, rule, severity, issue, matched): what rules find in docs (id, text, blob, type).

    A rule with code speaks where that pattern is in the text, its missing pattern isn't, and one of its
    intent and one of its context words are in blob (no words: always); one with required code where that is
    absent and an intent word is there. A rule with types speaks of these alone. Patterns are multi-line, dots
    match line feeds; matched is the first 120 characters of the match. Null texts are empty; empty tables
    give an empty result. Texts stay where they are read: a block's rules, `bound` bytes at most, are sent to
    them, so that no text is shuffled or written for a rule.
    """
    listed = [r.asDict() for r in rules.select(*(c.split(" ")[0] for c in FIELDS.split(", "))).orderBy("id").collect()]
    spark, out = docs.sparkSession, None
    docs = _plain(docs.select("id", "text", "blob", "type"))
    for block in _blocks(listed, bound):
        table = F.broadcast(spark.createDataFrame([(n, *listed[n].values()) for n in block[3]], "rule int, " + FIELDS.replace("id string", "name string", 1)))
        x = _tried(docs, block).join(table, "rule").where((F.size(F.coalesce("types", F.array().cast("array<string>"))) == 0) | F.array_contains("types", F.col("type")))
        x = x.where(speaks()).select("id", F.col("name").alias("rule"), "severity", "issue", F.when(F.col("required").isNull(), F.substring(F.regexp_substr("text", _flags("code")), 1, 120)).alias("matched"))
        out = x if out is None else out.unionByName(x)
    return out


def _flags(k: str) -> Column:
    return F.concat(F.lit("(?ms)"), F.col(k))


def speaks() -> Column:
    """Whether a rule beside a text speaks of it."""
    said = lambda k: F.exists(F.coalesce(k, F.array().cast("array<string>")), lambda w: F.contains("blob", w))
    none = lambda k: F.size(F.coalesce(k, F.array().cast("array<string>"))) == 0
    absent = F.col("required").isNotNull() & ~F.regexp_like("text", _flags("required")) & said("intent")
    present = F.col("required").isNull() & F.regexp_like("text", _flags("code")) & (F.col("missing").isNull() | ~F.regexp_like("text", _flags("missing"))) & (none("intent") | said("intent")) & (none("context") | said("context"))
    return F.coalesce(absent, F.lit(False)) | F.coalesce(present, F.lit(False))
