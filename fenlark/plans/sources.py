"""A catalogue of types read from sources, and code repaired by it. The sources are written from the parts and the
documents: declarations from a part's row, comments and strings from a document's text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import catalogue, repairs
from ..operators.scratch import dealt, spread, written
from .base import query, read


def _initcap(x):
    return F.replace(F.initcap(x), F.lit(" "), F.lit(""))


def _parts(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part")
    brand = F.replace("p_brand", F.lit("#"), F.lit(""))
    return p.select("p_partkey", F.concat(_initcap("p_name"), F.col("p_partkey").cast("string")).alias("type"), brand.alias("brand"), _initcap("p_type").alias("kind"), F.col("p_size").cast("string").alias("size"))


def _sources(spark, sf_dir) -> DataFrame:
    """(path, text): one source a part, which hides what isn't declared in comments, strings and bodies."""
    p = _parts(spark, sf_dir)
    base = p.select((F.col("p_partkey") + 7).alias("p_partkey"), F.col("type").alias("base"))
    d = read(spark, sf_dir, "documents").groupBy(F.col("doc_id").alias("p_partkey")).agg(F.min("text").alias("doc"))
    p = spread(p.join(dealt(base), "p_partkey", "left").join(dealt(d), "p_partkey", "left"), "p_partkey")
    bases = F.when((F.col("p_partkey") % 49 >= 7) & F.col("base").isNotNull(), F.concat("base", F.lit(", ITagged"))).otherwise("ITagged")
    doc = F.coalesce("doc", F.lit(""))
    text = F.concat(
        F.lit("using System; // "), F.regexp_replace(doc, r"[\r\n]", " "), F.lit("\n#region class Hidden\nnamespace Acme."), "brand", F.lit("\n{\n    /* enum Decoy { A, B } // \" */\n    [Serializable(\"class No {\")]\n    public class "), "type",
        F.lit(" : "), bases, F.lit("\n    {\n        const string Text = @\""), F.replace(doc, F.lit('"'), F.lit('""')), F.lit("\", Plain = \"class Decoy { } // \\\" }\";\n        char mark = '{';\n        public "), "type",
        F.lit("(string name, "), "type", F.lit("Options options = null) : base(name) { }\n        public int Width"), "size", F.lit(" { get; set; } = "), "size", F.lit(";\n        public void Save"), "kind",
        F.lit("(int a, List<int> b) { if (a > 0) { var x = new int[] { 1, 2 }; class Q; } }\n        public static "), "type", F.lit(" Make() => new "), "type", F.lit("(\"}\");\n    }\n    public enum "), "type", F.lit("Kind { "), "kind", F.lit(", Size"), "size", F.lit(" = "), "size", F.lit(", "), "brand", F.lit(" }\n}\n"),
    )
    return p.select(F.concat(F.lit("src/"), "type", F.lit(".cs")).alias("path"), text.alias("text"))


_PARTS = """(SELECT p_partkey, concat(array_to_string(list_transform(string_split(p_name, ' '), lambda w: concat(upper(w[1]), lower(w[2:]))), ''), p_partkey) AS type, replace(p_brand, '#', '') AS brand,
 array_to_string(list_transform(string_split(p_type, ' '), lambda w: concat(upper(w[1]), lower(w[2:]))), '') AS kind, p_size AS size FROM part)"""


@query(f"""WITH p AS {_PARTS}, b AS (SELECT a.type, a.brand, CASE WHEN a.p_partkey % 49 >= 7 AND b.type IS NOT NULL THEN concat(b.type, ',ITagged') ELSE 'ITagged' END AS bases FROM p a LEFT JOIN p b ON b.p_partkey + 7 = a.p_partkey)
SELECT concat('src/', type, '.cs') AS path, concat('Acme.', brand) AS namespace, type, 'class' AS kind, bases FROM b UNION ALL SELECT concat('src/', type, '.cs'), concat('Acme.', brand), concat(type, 'Kind'), 'enum', '' FROM b""")
def source_types(spark, sf_dir):
    """The types that sources declare, with their namespaces and bases."""
    d = catalogue.declarations(_sources(spark, sf_dir)).where("member is null")
    return d.select("path", "namespace", "type", "kind", F.array_join("bases", ",").alias("bases"))


@query(f"""WITH p AS {_PARTS}, m AS (SELECT type, unnest([['Text', 'field', ''], ['Plain', 'field', ''], ['mark', 'field', ''], [type, 'constructor', concat('string name, ', type, 'Options options=null')], [concat('Width', size), 'property', ''], [concat('Save', kind), 'method', 'int a, List<int> b'], ['Make', 'method', '']]) AS m FROM p
 UNION ALL SELECT concat(type, 'Kind'), unnest([[kind, 'value', ''], [concat('Size', size), 'value', ''], [brand, 'value', '']]) FROM p)
SELECT type, m[1] AS member, m[2] AS member_kind, m[3] AS params FROM m""")
def source_members(spark, sf_dir):
    """The members that sources declare: fields, constructors and methods with their parameters, properties, values."""
    return catalogue.declarations(_sources(spark, sf_dir)).where("member is not null").select("type", "member", "member_kind", "params")


_CLOSED = f"""p AS {_PARTS}, e AS (SELECT a.type, b.type AS base FROM p a JOIN p b ON b.p_partkey + 7 = a.p_partkey AND a.p_partkey % 49 >= 7 UNION ALL SELECT type, 'ITagged' FROM p),
r(type, ancestor, depth) AS (SELECT type, base, 1 FROM e UNION ALL SELECT r.type, e.base, r.depth + 1 FROM r JOIN e ON e.type = r.ancestor), c AS (SELECT type, ancestor, min(depth)::INT AS depth FROM r GROUP BY 1, 2)"""


@query(f"WITH RECURSIVE {_CLOSED} SELECT type, ancestor, depth FROM c")
def type_ancestors(spark, sf_dir):
    """All types that a type derives from, and how far they are: inheritance closed by doubling."""
    return catalogue.ancestors(catalogue.edges(catalogue.declarations(_sources(spark, sf_dir))))


@query(f"""WITH RECURSIVE {_CLOSED}, m AS (SELECT type AS owner, unnest([['Text', 'field'], ['Plain', 'field'], ['mark', 'field'], [concat('Width', size), 'property'], [concat('Save', kind), 'method'], ['Make', 'method']]) AS m FROM p),
a AS (SELECT c.type, m.m[1] AS member, m.m[2] AS member_kind, m.owner, c.depth FROM c JOIN m ON m.owner = c.ancestor UNION ALL SELECT owner, m[1], m[2], owner, 0 FROM m)
SELECT type, member, member_kind, owner, depth FROM (SELECT *, row_number() OVER (PARTITION BY type, member ORDER BY depth, owner, member_kind) AS k FROM a) WHERE k = 1""")
def inherited_members(spark, sf_dir):
    """Members of each class, its own and inherited ones, each with the type that declares it; constructors and values aside."""
    d = written(catalogue.declarations(_sources(spark, sf_dir)))
    m = catalogue.members(d, catalogue.ancestors(catalogue.edges(d)))
    return m.where("member_kind not in ('constructor', 'value')")


def _cases(spark, sf_dir) -> DataFrame:
    """(id, code, errors): what a customer wrote against the types of parts, misspelt by rule of their numbers."""
    p = _parts(spark, sf_dir).withColumn("id", F.col("p_partkey"))
    k = F.col("p_partkey")
    wrong = F.when(k % 4 == 0, F.lower("type")).when(k % 4 == 1, F.concat(F.substring("type", 1, 3), F.substring("type", 5, 99))).when(k % 4 == 2, F.concat("type", F.lit("s"))).otherwise(F.col("type"))
    member = F.concat(F.lit("Save"), F.regexp_replace("kind", "[aeiou]", ""))
    value = F.concat(F.lit("Siz"), "size")
    other = F.when(k % 3 == 0, "dataDir").otherwise("target")
    code = F.concat(F.lit("using System;\nusing Acme.Wrong;\nstatic void Main() {\n    var a = new "), wrong, F.lit("(\"in.zip\", \"secret\");\n    a."), member, F.lit("(1, null);\n    var k = "), "type", F.lit("Kind."), value, F.lit(";\n    Read("), other, F.lit(");\n    a.Save();\n    var r = new Reader(\"x\");\n}"))
    said = lambda *x: F.concat(*(F.lit(y) if i % 2 == 0 else y for i, y in enumerate(x)))
    t = F.col("type")
    errors = F.array(
        said("a.cs(4,9): error CS0246: The type or namespace name '", wrong, "' could not be found"), said("error CS1061: 'Acme.", t, "' does not contain a definition for '", member, "'"),
        said("error CS0117: '", F.concat(t, F.lit("Kind")), "' does not contain a definition for '", value, "'"), said("error CS0103: The name '", other, "' does not exist in the current context"),
        F.when(k % 5 == 0, said("error CS0234: The type or namespace name '", t, "' does not exist in the namespace 'Acme.Wrong'")).when(k % 5 == 1, said("error CS1069: The type name '", t, "' could not be found in the namespace 'Acme.Wrong'")),
        F.when(k % 2 == 0, F.lit("error CS7036: There is no argument given that corresponds to the required parameter 'path'")), F.when(k % 7 == 0, said("error CS1503: Argument 1: cannot convert from 'string' to 'Acme.", t, "'")),
    )
    return p.select("id", code.alias("code"), errors.alias("errors"))


@query()
def catalogue_repairs(spark, sf_dir):
    """Code after the repairs that its errors call for, and what was done: namespaces, redirects, forwards, variables,
    arguments, values, members, spellings and wrapped arguments, all from the catalogue that the sources declare."""
    d = written(catalogue.declarations(_sources(spark, sf_dir)))
    types = d.where("member is null").select("type", "namespace")
    members = d.where("member is not null and member_kind <> 'constructor'").select("type", "member", "member_kind")
    constructors = d.where("member_kind = 'constructor'").select("type", "params")
    return repairs.repaired(written(_cases(spark, sf_dir)), types, members, constructors)
