"""Names most alike against difflib, declarations by hand and on broken sources, inheritance, and repairs against a plain version."""

import difflib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fenlark.functions import csharp
from fenlark.operators import catalogue, fuzzy, repairs
from fenlark.plans import sources


def _names(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def _damaged(r, word):
    x = list(word)
    for _ in range(r.randint(0, 3)):
        i = r.randrange(len(x) + 1)
        if r.random() < 0.4 and len(x) > 1:
            x.pop(min(i, len(x) - 1))
        else:
            x.insert(i, r.choice("aeXY_"))
    return "".join(x)


@pytest.mark.parametrize("cutoff", [0.7, 0.85])
def test_closest_equals_difflib(spark, monkeypatch, cutoff):
    monkeypatch.setattr(fuzzy, "SHARERS", 20)
    r = random.Random(1)
    parts = ["Arch", "ive", "Load", "Save", "Opt", "Bar", "Code", "x", "É"]
    words = sorted({"".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(250)} | {"".join(r.choices("abAB", k=r.randint(1, 6))) for _ in range(80)})
    names = sorted({_damaged(r, w) for w in r.sample(words, 120)} | {"a" * 220, "zzz"})
    got = {x["name"]: (x["score"], x["word"]) for x in fuzzy.closest(_names(spark, names + names[:5] + ["", None]), _names(spark, words + [None, ""]), cutoff).collect()}
    want = {n: m for n in names for m in [difflib.get_close_matches(n, words, 1, cutoff)] if m}
    assert got == {n: (difflib.SequenceMatcher(None, m[0], n).ratio(), m[0]) for n, m in want.items()}
    assert fuzzy.candidates(_names(spark, names), _names(spark, words), cutoff).count() < 0.25 * len(names) * len(words)
    assert fuzzy.closest(_names(spark, []), _names(spark, words), cutoff).count() == fuzzy.closest(_names(spark, names), _names(spark, []), cutoff).count() == 0


def test_closest_within_a_key_for_low_cutoffs(spark):
    r = random.Random(2)
    held = {t: sorted({"".join(r.choices("abcdeX", k=r.randint(1, 8))) for _ in range(30)}) for t in "pq"}
    asked = {t: sorted({_damaged(r, w) for w in held[t]}) for t in "pq"}
    frame = lambda x: spark.createDataFrame([(t, n) for t in x for n in x[t]], "type string, name string")
    got = {(x["type"], x["name"]): x["word"] for x in fuzzy.closest_within(frame(asked), frame(held), "type", 0.4).collect()}
    assert got == {(t, n): m[0] for t in asked for n in asked[t] for m in [difflib.get_close_matches(n, held[t], 1, 0.4)] if m}


SOURCE = r'''using System;
#if X class No { }
#endif
namespace Acme.Zip {
  // class Decoy { "
  [Serializable("{")]
  public sealed class Archive<T> : Base.Thing<T, int>, IDisposable where T : new() {
    const string S = "class X { } // \" }", Z = "a";
    string path = @"C:\dir\""class Y {""";
    char c = '{'; string i = $"x{{ {1} }}";
    Dictionary<string, int> map = new Dictionary<string, int> { { "a", 1 } }, more;
    [Obsolete("x{")] public Archive(string name, LoadOptions? options = null) : base(name) { if (true) { } }
    ~Archive() { }
    public int Count { get; set; } = 4;
    public List<string> Names => new List<string> { "a", "b" };
    public static async Task<int> Run<U>(int a, Dictionary<string, int> b) => 3;
    void Plain(int a) { foreach (var x in y) { class q; } }
    int a, b = 3;
    enum Inner { One = 1, Two = (2 + 3), [X] Three }
  }
  interface IThing : A.IOther { void Go(); int P { get; } }
  public record Point(int X, int Y) : Shape(X);
}
class Unclosed { void M() { "'''


def test_declarations():
    rows = csharp.declarations(SOURCE)
    types = [(n, t, k, b) for n, t, k, b, m, _, _ in rows if m is None]
    assert types == [("Acme.Zip", "Archive", "class", ["Base.Thing", "IDisposable"]), ("Acme.Zip", "Archive.Inner", "enum", []), ("Acme.Zip", "IThing", "interface", ["A.IOther"]), ("Acme.Zip", "Point", "record", ["Shape"]), ("", "Unclosed", "class", [])]
    found = {(t, m): (k, p) for _, t, _, _, m, k, p in rows if m}
    assert found == {
        **{("Archive", f): ("field", "") for f in ("S", "Z", "path", "c", "i", "map", "more", "a", "b")}, ("Archive", "Archive"): ("constructor", "string name, LoadOptions? options=null"), ("Archive", "Count"): ("property", ""), ("Archive", "Names"): ("property", ""),
        ("Archive", "Run"): ("method", "int a, Dictionary<string, int> b"), ("Archive", "Plain"): ("method", "int a"), **{("Archive.Inner", v): ("value", "") for v in ("One", "Two", "Three")}, ("IThing", "Go"): ("method", ""), ("IThing", "P"): ("property", ""), ("Unclosed", "M"): ("method", ""),
    }
    assert csharp.declarations("namespace A.B;\nclass C { }") == [("A.B", "C", "class", [], None, None, None)] and csharp.declarations(None) == csharp.declarations("") == []


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["class", "enum", "A", "b", "{", "}", "(", ")", "[", "]", "<", ">", ",", ";", "=", "=>", ":", '"', "'", "@", "//", "/*", "\n", "#", "namespace"]), max_size=60))
def test_any_text_ends(parts):
    csharp.declarations(" ".join(parts))
    csharp.declarations("".join(parts))


def test_ancestors_by_doubling_and_cycles(spark):
    chain = [(f"t{i}", f"t{i + 1}") for i in range(40)] + [("t3", "side"), ("side", "t9"), ("x", "y"), ("y", "x"), (None, "z"), ("z", None)]
    got = {(r["type"], r["ancestor"]): r["depth"] for r in catalogue.ancestors(spark.createDataFrame(chain, "type string, base string")).collect()}
    assert got["t0", "t40"] == 36 and got["t3", "t9"] == 2 and got["x", "x"] == 2 and ("z", None) not in got
    assert catalogue.ancestors(spark.createDataFrame([], "type string, base string")).count() == 0


def _repaired(code, errors, types, values, members, params):
    """The repairs one after the other, in plain Python."""
    fixes, seen = [], {}
    for n, (number, pattern) in enumerate(repairs.READS):
        for e in errors or []:
            m = re.search(pattern, e or "")
            if m and number in e:
                key = (number, *(g.rsplit(".", 1)[-1] if number in ("CS1503", "CS1061") else g for g in m.groups()))
                seen.setdefault(key, None)
    asked = lambda number: [k[1:] for k in seen if k[0] == number]

    def add(code, line):
        if line in code:
            return code
        rows = code.split("\n")
        last = max([i + 1 for i, z in enumerate(rows) if z.strip().startswith("using ") and z.strip().endswith(";")], default=0)
        return "\n".join([*rows[:last], line, *rows[last:]])

    for t, _ in asked("CS0246"):
        if t in types and f"using {types[t]};" not in code and t in code:
            code = add(code, f"using {types[t]};")
            fixes.append(f"CS0246: Added 'using {types[t]};' for type '{t}'")
    for number, said in (("CS0234", "CS0234: Replaced 'using {1}' with 'using {2}' for type '{0}'"), ("CS1069", "CS1069: Type '{0}' forwarded; replaced 'using {1}' with 'using {2}'")):
        for t, wrong in asked(number):
            if types.get(t, wrong) != wrong and f"using {types[t]};" not in code and f"using {wrong};" in code:
                code = code.replace(f"using {wrong};", f"using {types[t]};", 1)
                fixes.append(said.format(t, wrong, types[t]))
    for name, _ in asked("CS0103"):
        rows = code.split("\n")
        use = next((i for i, z in enumerate(rows) if re.search(rf"\b{name}\b", z)), None)
        if use is not None and not re.search(rf"(?:string|var|int|bool|object)\s+{name}\s*[=;]", code):
            at = next((i + 1 for i in range(use - 1, -1, -1) if rows[i].strip().endswith("{")), use)
            rows.insert(at, re.match(r"\s*", rows[use])[0] + f"string {name} = " + ('""' if name in repairs.FOLDERS else repairs.DEFAULT) + ";")
            code = "\n".join(rows)
            fixes.append(f"CS0103: Defined variable '{name}' with safe default")
    for p, _ in asked("CS7036"):
        rows = code.split("\n")
        i = next(i for i, z in enumerate(rows) if "Save()" in z)
        rows[i] = rows[i].replace("Save()", f"Save({repairs.DEFAULT})")
        code = "\n".join(rows)
        fixes.append(f"CS7036: Supplied default argument for parameter '{p}'")
    for t, m in asked("CS0117"):
        best = difflib.get_close_matches(m, values.get(t, []), 1, 0.4)
        if best and f"{t}.{m}" in code:
            code = code.replace(f"{t}.{m}", f"{t}.{best[0]}")
            fixes.append(f"CS0117: Replaced '{t}.{m}' with catalog-matched valid member")
    for _, to in asked("CS1503"):
        option = next((x.split()[0].rstrip("?") for x in params.get(to, "").split(",") if "Options" in x), None)
        new, n = re.subn(rf'new\s+{to}\s*\(\s*("[^"]*")\s*,\s*("[^"]*")\s*\)', rf"new {to}(\1, new {option}() {{ DecryptionPassword = \2 }})", code, count=1)
        if option and n:
            code = new
            fixes.append(f"CS1503: Applied catalog-driven constructor fix for '{to}'")
    for t, m in asked("CS1061"):
        best = difflib.get_close_matches(m, members.get(t, []), 1, 0.4)
        if m not in members.get(t, []) and best and f".{m}" in code:
            code = code.replace(f".{m}", f".{best[0]}")
            fixes.append(f"CS1061: Fuzzy-matched '{t}.{m}' to catalog member")
    for t, _ in asked("CS0246"):
        if t not in types:
            cased = [x for x in types if x.lower() == t.lower()] or difflib.get_close_matches(t, types, 1, 0.7)
            if cased:
                code = add(re.sub(rf"\b{t}\b", cased[0], code), f"using {types[cased[0]]};")
                fixes.append(f"CS0246: Fuzzy-matched type '{t}' -> '{cased[0]}' (catalog lookup)")
    for a, to in asked("CS1503"):
        found = list(re.finditer(r'(new\s+\w+\s*\(\s*)("[^"]*")(\s*[,)])', code))
        if a in params.get(to, "") and found:
            m = found[-1]
            code = add(code[: m.start()] + f"{m[1]}new {to}({m[2]}){m[3]}" + code[m.end() :], f"using {types[to]};")
            fixes.append(f"CS1503: Wrapped {a} arg with new {to}(...) (catalog constructor match)")
    return code, fixes


def test_repairs_equal_the_plain_version(spark):
    d = "/root/testdata/sf0.001"
    parts = {r["type"]: r for r in sources._parts(spark, d).collect()}
    types = {t: f"Acme.{r['brand']}" for t, r in parts.items()} | {f"{t}Kind": f"Acme.{r['brand']}" for t, r in parts.items()}
    values = {f"{t}Kind": [r["kind"], f"Size{r['size']}", r["brand"]] for t, r in parts.items()}
    members = {t: ["Text", "Plain", "mark", f"Width{r['size']}", f"Save{r['kind']}", "Make"] for t, r in parts.items()}
    params = {t: f"string name, {t}Options options=null" for t in parts}
    got = {r["id"]: (r["fixed"], r["fixes"]) for r in sources.catalogue_repairs(spark, d).collect()}
    for r in sources._cases(spark, d).collect():
        assert got[r["id"]] == _repaired(r["code"], r["errors"], types, values, members, params), r["id"]
    assert {f.split(":")[0] for _, fixes in got.values() for f in fixes} == {"CS0246", "CS0234", "CS1069", "CS0103", "CS7036", "CS0117", "CS1503", "CS1061"}


def test_repairs_of_odd_cases(spark):
    rows = [(1, None, ["error CS0103: The name 'x' does not exist in the current context"]), (2, "x", None), (3, "", []), (4, "Go(x, );\nRun();", ["CS7036: parameter 'p'", None, "nonsense"]), (5, "T.Vlaue", ["error CS0117: 'T' does not contain a definition for 'Vlaue'"] * 2)]
    cases = spark.createDataFrame(rows, "id long, code string, errors array<string>")
    members = spark.createDataFrame([("T", "Value", "value")], "type string, member string, member_kind string")
    none = spark.createDataFrame([], "type string, namespace string")
    got = {r["id"]: (r["fixed"], len(r["fixes"])) for r in repairs.repaired(cases, none, members, none.select("type", F.col("namespace").alias("params"))).collect()}
    assert got == {1: (None, 0), 2: ("x", 0), 3: ("", 0), 4: (f"Go(x, {repairs.DEFAULT});\nRun();", 1), 5: ("T.Value", 1)}
