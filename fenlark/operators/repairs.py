"""Repairs of code that its compiler errors call for, resolved against a catalogue by joins and applied in their fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.code import insert_using, lines
from . import fuzzy
from .scratch import dealt, spread, written

# An error's number, the pattern that reads it, and what is read (the name's last part counts).
READS = [
    ("CS0246", r"The type or namespace name '(\w+)' could not be found()"),
    ("CS0234", r"The type or namespace name '(\w+)' does not exist in the namespace '([\w.]+)'"),
    ("CS1069", r"The type name '(\w+)' could not be found in the namespace '([\w.]+)'"),
    ("CS0103", r"The name '(\w+)' does not exist in the current context()"),
    ("CS7036", r"parameter '(\w+)'()"),
    ("CS0117", r"'(\w+)' does not contain a definition for '(\w+)'"),
    ("CS1503", r"cannot convert from '([\w.]+)' to '([\w.]+)'"),
    ("CS1061", r"'([\w.]+)' does not contain a definition for '(\w+)'"),
]
# Methods that get a default argument first, what it is, and variables that stand for an empty folder.
METHODS = ["ExtractToDirectory", "Save", "Extract", "Create", "Open", "SaveToFile", "ExtractToFile", "CreateDirectory", "MoveTo", "CopyTo", "WriteTo"]
DEFAULT = 'Path.Combine(Path.GetTempPath(), "output")'
FOLDERS = ["dataDir", "baseDir", "sourceDir", "outputDir", "baseFolder", "SourceDir", "OutputDir", "outputFolder", "output"]
MEMBER, TYPE = 0.4, 0.7  # how alike a member and a type must be
# The order of the repairs.
ORDER = ["using", "redirect", "forward", "define", "argument", "value", "options", "member", "spelling", "wrap"]
_EDIT = "array<struct<rank:int,pos:int,kind:string,a:string,b:string,c:string,note:string,other:string>>"


def read(errors: DataFrame) -> DataFrame:
    """(id, pos, number, a, b): what each error names, once. Errors of other numbers and null ones are left out."""
    each = errors.select("id", F.posexplode("errors").alias("pos", "e")).withColumn("number", F.regexp_extract("e", r"\b(CS\d{4})\b", 1))
    out = None
    for number, pattern in READS:
        groups = [F.regexp_extract("e", pattern, i) for i in (1, 2)]
        if number in ("CS1503", "CS1061"):
            groups = [F.element_at(F.split(g, r"\."), -1) for g in groups]
        part = each.where((F.col("number") == number) & F.col("e").rlike(pattern)).select("id", "pos", "number", groups[0].alias("a"), groups[1].alias("b"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("id", "number", "a", "b").agg(F.min("pos").alias("pos"))


def edits(errors: DataFrame, types: DataFrame, members: DataFrame, constructors: DataFrame) -> DataFrame:
    """(id, rank, pos, kind, a, b, c, note, other): what is to be done, from types (type, namespace), members (type,
    member, member_kind) and constructors (type, params). Of a type's namespaces the first by name counts."""
    e = written(read(errors))
    spaces = dealt(types.groupBy(F.col("type").alias("t")).agg(F.min("namespace").alias("namespace")))
    using = F.concat(F.lit("using "), F.col("namespace"), F.lit(";"))
    of = lambda number: e.where(F.col("number") == number)

    def rows(df: DataFrame, kind: str, a, b, c, note, other="") -> DataFrame:
        named = [x if isinstance(x, Column) else F.lit(x) for x in (a, b, c, note, other)]
        return df.select("id", F.lit(ORDER.index(kind)).alias("rank"), "pos", F.lit(kind).alias("kind"), *(x.alias(n) for x, n in zip(named, ("a", "b", "c", "note", "other"), strict=True)))

    said = lambda *x: F.concat(*(F.lit(y) if i % 2 == 0 else F.col(y) if isinstance(y, str) else y for i, y in enumerate(x)))
    known = spaces.withColumnRenamed("t", "a")
    missing = written(of("CS0246").join(known, "a", "left"))
    out = rows(missing.where("namespace is not null"), "using", F.col("a"), using, "", said("CS0246: Added '", using, "' for type '", "a", "'"))

    moved = of("CS0234").join(known, "a").where("namespace <> b")
    out = out.unionByName(rows(moved, "redirect", said("using ", "b", ";"), using, F.col("a"), said("CS0234: Replaced 'using ", "b", "' with 'using ", "namespace", "' for type '", "a", "'"), said("CS0234: Added 'using ", "namespace", "' for type '", "a", "' (was missing from '", "b", "')")))
    moved = of("CS1069").join(known, "a").where("namespace <> b")
    out = out.unionByName(rows(moved, "forward", said("using ", "b", ";"), using, "", said("CS1069: Type '", "a", "' forwarded; replaced 'using ", "b", "' with 'using ", "namespace", "'"), said("CS1069: Added 'using ", "namespace", "' for forwarded type '", "a", "'")))

    names = of("CS0103").join(known, "a", "left")
    out = out.unionByName(rows(names.where("namespace is not null"), "using", F.col("a"), using, "", said("CS0246: Added '", using, "' for type '", "a", "'")).withColumn("rank", F.lit(ORDER.index("define"))))
    value = F.when(F.col("a").isin(*FOLDERS), '""').otherwise(DEFAULT)
    out = out.unionByName(rows(names.where("namespace is null"), "define", F.col("a"), said("string ", "a", " = ", value, ";"), "", said("CS0103: Defined variable '", "a", "' with safe default")))
    out = out.unionByName(rows(of("CS7036"), "argument", F.col("a"), "", "", said("CS7036: Supplied default argument for parameter '", "a", "'")))

    held = members.select("type", F.col("member").alias("name"), F.col("member_kind") == "value")
    held = held.toDF("type", "name", "value")
    asked = e.where("number in ('CS0117', 'CS1061')").select("id", "pos", "number", F.col("a").alias("type"), F.col("b").alias("name"))
    best = fuzzy.closest_within(asked.where("number = 'CS0117'"), held.where("value"), "type", MEMBER)
    wrong = asked.where("number = 'CS0117'").join(dealt(best), ["type", "name"])
    out = out.unionByName(rows(wrong, "value", said("", "type", ".", "name"), said("", "type", ".", "word"), "", said("CS0117: Replaced '", "type", ".", "name", "' with catalog-matched valid member")))
    apart = asked.where("number = 'CS1061'").join(dealt(held.where("not value").select("type", "name").distinct()), ["type", "name"], "left_anti")
    wrong = apart.join(dealt(fuzzy.closest_within(apart, held.where("not value"), "type", MEMBER)), ["type", "name"])
    out = out.unionByName(rows(wrong, "member", said(".", "name"), said(".", "word"), "", said("CS1061: Fuzzy-matched '", "type", ".", "name", "' to catalog member")))

    unknown = missing.where("namespace is null").select("id", "pos", F.col("a").alias("name"))
    low = dealt(types.groupBy(F.lower("type").alias("low")).agg(F.min("type").alias("cased")))
    cased = unknown.withColumn("low", F.lower("name")).join(low, "low", "left")
    alike = fuzzy.closest(cased.where("cased is null").select("name"), types.select(F.col("type").alias("name")), TYPE)
    right = cased.join(dealt(alike), "name", "left").withColumn("word", F.coalesce("cased", "word")).where("word is not null").join(spaces, F.col("word") == F.col("t"))
    out = out.unionByName(rows(right, "spelling", F.col("name"), F.col("word"), using, said("CS0246: Fuzzy-matched type '", "name", "' -> '", "word", "' (catalog lookup)")))

    shown = dealt(constructors.select(F.col("type").alias("b"), "params"))
    options = shown.withColumn("option", F.regexp_extract("params", r"(?:^|,)\s*(\w*(?:Options|Settings)\w*)\??", 1)).where("option <> ''").groupBy("b").agg(F.min("option").alias("option"))
    wrong = of("CS1503").join(options, "b")
    prop = F.when(F.contains("option", F.lit("Load")), "DecryptionPassword").when(F.contains("option", F.lit("Sav")), "Password").otherwise("DecryptionPassword")
    out = out.unionByName(rows(wrong, "options", F.col("b"), F.col("option"), prop, said("CS1503: Applied catalog-driven constructor fix for '", "b", "'")))
    takes = of("CS1503").join(shown, "b").where(F.contains(F.lower("params"), F.lower("a"))).select("id", "pos", "a", "b").distinct().join(spaces, F.col("b") == F.col("t"))
    return out.unionByName(rows(takes, "wrap", F.col("a"), F.col("b"), using, said("CS1503: Wrapped ", "a", " arg with new ", "b", "(...) (catalog constructor match)")))


def _quoted(x: Column) -> Column:
    return F.concat(F.lit(r"\Q"), x, F.lit(r"\E"))


def _with_using(code: Column, directive: Column) -> Column:
    return F.coalesce(insert_using(code, directive, F.lit("")), code)


def _argument(code: Column) -> Column:
    """The default argument in the first line that can take it; null if there is none."""
    rows = lines(code)
    ok = lambda z: ~z.rlike(r"void Main|static void|public void|= Path\.Combine\(Path\.GetTempPath\(\)")
    first = lambda test: F.array_min(F.transform(rows, lambda z, i: F.when(ok(z) & test(z), i)))
    put = lambda at, f: F.array_join(F.transform(rows, lambda z, i: F.when(i == at, f(z)).otherwise(z)), "\n")
    listed = lambda z: [(F.contains(z, F.lit(f"{m}()")), F.replace(z, F.lit(f"{m}()"), F.lit(f"{m}({DEFAULT})"))) for m in METHODS]

    def priority(z: Column) -> Column:
        out = None
        for test, new in listed(z):
            out = F.when(test, new) if out is None else out.when(test, new)
        return out

    comma, empty = r"(\w+\s*\([^)]*,)\s*\)", r"(\w+)\s*\(\s*\)\s*;"
    plain = lambda z: z.rlike(empty) & ~(F.contains(z, F.lit("new ")) & F.contains(z, F.lit("= ")))
    a, b, c = first(lambda z: F.lit(False) if not METHODS else priority(z).isNotNull()), first(lambda z: z.rlike(comma)), first(plain)
    return F.when(a.isNotNull(), put(a, priority)).when(b.isNotNull(), put(b, lambda z: F.regexp_replace(z, comma, f"$1 {DEFAULT})"))).when(c.isNotNull(), put(c, lambda z: F.regexp_replace(z, empty, f"$1({DEFAULT});")))


def _defined(code: Column, name: Column, definition: Column) -> Column:
    """The code with the definition at the start of the block of the name's first use; null where it is defined or not used."""
    rows = lines(code)
    use = F.array_min(F.transform(rows, lambda z, i: F.when(F.regexp_like(z, F.concat(F.lit(r"\b"), name, F.lit(r"\b"))), i)))
    opens = lambda z: F.regexp_replace(z, r"^\s+|\s+$", "").rlike(r"\{$|static void Main|public static void")
    block = F.array_max(F.transform(rows, lambda z, i: F.when((i < use) & opens(z), i + 1)))
    at = F.coalesce(block, use)
    indent = F.regexp_extract(F.get(rows, use), r"^(\s*)", 1)
    new = F.array_join(F.concat(F.slice(rows, F.lit(1), at), F.array(F.concat(indent, definition)), F.slice(rows, at + 1, F.size(rows))), "\n")
    declared = F.regexp_like(code, F.concat(F.lit(r"(?:string|var|int|bool|object)\s+"), name, F.lit(r"\s*[=;]")))
    return F.when(~declared & use.isNotNull(), new)


def _applied(state: Column, e: Column) -> Column:
    code, kind = state["code"], e["kind"]
    text = r"(\"(?:[^\"\\\\]|\\\\.)*\")".replace("\\\"", '"').replace("\\\\\\\\", "\\\\")
    pair = F.concat(F.lit(r"(?s)^(.*?)new\s+"), e["a"], F.lit(r"\s*\(\s*" + text + r"\s*,\s*" + text + r"\s*\)"))
    options = F.regexp_replace(code, pair, F.concat(F.lit("$1new "), e["a"], F.lit("($2, new "), e["b"], F.lit("() { "), e["c"], F.lit(" = $3 })")))
    single = r'(?s)^(.*)(new\s+\w+\s*\(\s*)("[^"]*")(\s*[,)])'  # the last such call
    wrapped = F.when(code.rlike(single), _with_using(F.regexp_replace(code, F.lit(single), F.concat(F.lit("$1$2new "), e["b"], F.lit("($3)$4"))), e["c"]))
    redirected = F.when(F.contains(code, e["b"]), F.lit(None)).when(F.contains(code, e["a"]), F.overlay(code, e["b"], F.position(e["a"], code), F.length(e["a"])))
    placed = F.when(~F.contains(code, e["b"]) & ((kind == "forward") | F.contains(code, e["c"])), _with_using(code, e["b"]))
    new = (
        F.when(kind == "using", insert_using(code, e["b"], e["a"]))
        .when(kind.isin("redirect", "forward"), F.coalesce(redirected, placed))
        .when(kind == "define", _defined(code, e["a"], e["b"]))
        .when(kind == "argument", _argument(code))
        .when(kind.isin("value", "member"), F.when(F.contains(code, e["a"]), F.replace(code, e["a"], e["b"])))
        .when(kind == "options", F.when(F.regexp_like(code, pair), options))
        .when(kind == "spelling", _with_using(F.regexp_replace(code, F.concat(F.lit(r"\b"), _quoted(e["a"]), F.lit(r"\b")), e["b"]), e["c"]))
        .when(kind == "wrap", wrapped)
    )
    note = F.when(kind.isin("redirect", "forward") & redirected.isNull(), e["other"]).otherwise(e["note"])
    return F.struct(F.coalesce(new, code).alias("code"), F.when(new.isNotNull(), F.array_append(state["fixes"], note)).otherwise(state["fixes"]).alias("fixes"))


def repaired(cases: DataFrame, types: DataFrame, members: DataFrame, constructors: DataFrame) -> DataFrame:
    """(id, fixed, fixes): the code of cases (id, code, errors) after its repairs, and what was done, in order.

    ids are unique. What names the catalogue's entries is resolved by joins for all cases at once; a case's
    edits, of which there are as many as errors at most, are gathered and folded over its code. Null
    code and null or empty errors come back as they are.
    """
    found = edits(cases, types, members, constructors)
    each = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "pos", "kind", "a", "b", "c", "note", "other"))).cast(_EDIT).alias("edits"))
    start = F.struct(F.col("code"), F.array().cast("array<string>").alias("fixes"))
    after = F.aggregate(F.coalesce("edits", F.array().cast(_EDIT)), start, _applied)
    return spread(cases.select("id", "code").join(dealt(each), "id", "left"), "id").select("id", after.alias("r")).select("id", F.col("r.code").alias("fixed"), F.col("r.fixes").alias("fixes"))
