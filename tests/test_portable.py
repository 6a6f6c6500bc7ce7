"""Repairs without a catalogue, against what each must make of a text."""

import pytest
from pyspark.sql import functions as F

from fenlark.operators import portable as p

ONE = {
    "passwords": [("Open(\"password\", 'my_secret', \"passwords\")", "Open(\"p@s$\", 'p@s$', \"passwords\")")],
    "folders": [
        ('Directory.GetFiles("folder", "*"); var d = "folder";', 'Directory.GetFiles(".", "*"); var d = "folder";'),
        ('var d = "folder"; new DirectoryInfo( "sourceDir" );', 'var d = "."; new DirectoryInfo(".");'),
        ('Print("folder");', 'Print("folder");'),
        ('a.CreateEntries("inputFolder"); Path.Combine("sourceDir", x)', 'a.CreateEntries("."); Path.Combine(".", x)'),
    ],
    "absolute_paths": [
        (r'Open(@"C:\a\b\c.zip", "D:\\x\\y.png", "/srv/in/z.json")', 'Open("c.zip", "y.png", "z.json")'),
        (r'Open(@"C:\data\out", "C:\\data", @"C:\v1.2\out")', 'Open(".", ".", ".")'),
        (r'Open("rel/a.zip", "http://x/y.zip", @"C:\only.zip")', r'Open("rel/a.zip", "http://x/y.zip", @"C:\only.zip")'),
    ],
    "archives": [('Open("source.zip", "other.zip")', 'Open("sample.zip", "other.zip")')],
    "level_parameter": [("void P(string a, CompressionLevel l = CompressionLevel.Low)", "void P(string a)")],
    "levels": [("CompressionLevel.Normal, CompressionLevel.High", "CompressionLevel.Optimal, CompressionLevel.SmallestSize")],
    "settings": [("new DeflateCompressionSettings( level ), new DeflateCompressionSettings(1)", "new DeflateCompressionSettings(), new DeflateCompressionSettings(1)")],
    "entries": [('a.Entries["x\\"y"]; a.Entries["z"]', 'a.Entries[0]; a.Entries["z"]')],
    "save_async": [("await a.SaveAsync(s); b.SaveAsync(s);", "a.Save(s); b.SaveAsync(s);"), ("b.SaveAsync (s);", "b.Save(s);")],
}


@pytest.mark.parametrize("name", sorted(p.RUNTIME))
def test_each_repair(spark, name):
    rows = spark.createDataFrame([*ONE[name], ("", ""), (None, None)], "code string, expected string")
    assert [r[0] for r in rows.select(p.RUNTIME[name](F.col("code"))).collect()] == [r["expected"] for r in rows.collect()]


def test_all_repairs_in_order_and_again(spark):
    code = 'Open(@"C:\\x\\input.zip", "password"); a.SaveAsync(s);'
    d = spark.createDataFrame([(1, code), (2, None), (3, "")], "id int, code string")
    once = p.runtime_repairs(d)
    assert [tuple(r) for r in once.orderBy("id").collect()] == [(1, code, 'Open("sample.zip", "p@s$"); a.Save(s);', ["passwords", "absolute_paths", "archives", "save_async"]), (2, None, None, []), (3, "", "", [])]
    again = p.runtime_repairs(once.select("id", F.col("fixed").alias("code")))
    assert all(r["fixes"] == [] for r in again.collect())


def test_transformers_are_named_by_rows_and_may_be_added(spark, monkeypatch):
    monkeypatch.setattr(p, "TRANSFORMERS", dict(p.TRANSFORMERS))
    p.register("shout", F.upper)
    d = spark.createDataFrame([(1, "shout", "a"), (2, "shout", "A"), (3, "nope", "a"), (4, None, "a"), (5, "shout", None)], "id int, name string, code string")
    assert [tuple(r)[3:] for r in p.transformed(d, "name").orderBy("id").collect()] == [
        ("A", True, "Applied transformer 'shout'"), ("A", False, "Transformer made no changes"), ("a", False, "Unknown transformer: nope"), ("a", False, "Missing transformer name"), (None, False, "Transformer made no changes"),
    ]


def test_repairs_of_families(spark):
    rar = 'x\nusing A;\nnew RarArchive("a.rar", "p\\"w"); new RarArchive("b", "c");'
    fixed = 'x\nusing A;\nusing Acme.Zip.Rar;\nnew RarArchive("a.rar", new RarArchiveLoadOptions() { DecryptionPassword = "p\\"w" }); new RarArchive("b", "c");'
    plain = 'new RarArchive("a", "b"); CompressionLevel.Low'
    rows = [
        ("ZIP", rar, fixed, ["archive_password"]),
        ("zip", plain, 'new RarArchive("a", new RarArchiveLoadOptions() { DecryptionPassword = "b" }); CompressionLevel.Fastest', ["archive_password", "levels"]),
        ("Words", "Acme.Words.Plugins.X Acme.Plugins", "Acme.Words.LowCode.X Acme.Plugins", ["low_code"]),
        ("pdf", "Acme.Pdf.Plugins", "Acme.Pdf.Plugins", []),
        (None, rar, rar, []),
        ("zip", None, None, []),
    ]
    d = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "id int, family string, code string")
    assert [(r["fixed"], r["fixes"]) for r in p.family_repairs(d).orderBy("id").collect()] == [r[2:] for r in rows]


SPACES = {"Acme.Saving": ["Settings"]}
QUICK = [
    ('class P { static void Main() { Save("my_folder"); Read("a/output/b", "old_dir.zip"); } }', ["DirectoryNotFoundException"], 'class P { static void Main() {\n        Directory.CreateDirectory(@"a/output/b");\n        Directory.CreateDirectory(@"my_folder");\n Save("my_folder"); Read("a/output/b", "old_dir.zip"); } }', ["directory_create_injection"]),
    ('Save("my_folder");', ["DirectoryNotFoundException"], 'Save("my_folder");', []),
    ("using A;\nusing B ;\nx", ["no Settings"], "using A;\nusing B ;\nusing Acme.Saving;\n\nx", ["using_acme_saving"]),
    ("x", ["Settings", None], "using Acme.Saving;\nx", ["using_acme_saving"]),
    ("using System.IO.Compression;\nusing A;\nx", [], "using A;\nusing Acme;\n\nx", ["platform_archives"]),
    ("using Acme;\n  ZipArchiveMode.Read \n// ZipArchiveMode.Read", None, "using Acme;\n  // REMOVED: ZipArchiveMode is not available in Acme API\n  // ZipArchiveMode.Read\n// ZipArchiveMode.Read", ["foreign_call_ziparchivemode"]),
    ('static async Task Main() { P("await x"); } // await y', [], 'static void Main() { P("await x"); } // await y', ["async_main"]),
    ("static async Task<int> Main() { await x; }", [], "static async Task<int> Main() { await x; }", []),
    ('Open("C:\\a\\\\b.zip")', [], 'using System.IO;\nOpen(Path.Combine("C:", "a", "b.zip"))', ["drive_paths"]),
    ('using A;\nOpen(MyDir + "x"); master.Go(); // httpFile.x', [], 'using A;\nstring MyDir = @"./";\nvar master = new Document();\n\nOpen(MyDir + "x"); master.Go(); // httpFile.x', ["harness_names"]),
    ('string MyDir = "y"; Open(MyDir);', [], 'string MyDir = "y"; Open(MyDir);', []),
    ("Open(ArtifactsDir);", [], 'string ArtifactsDir = @"./artifacts/";\nOpen(ArtifactsDir);', ["harness_names"]),
    ("", [], "", []),
    (None, ["Settings"], None, []),
]


def test_quick_fixes(spark):
    d = spark.createDataFrame([(i, *q[:2]) for i, q in enumerate(QUICK)], "id int, code string, errors array<string>")
    found = p.quick_fixes(d, SPACES, "Acme").orderBy("id")
    assert found.columns == ["id", "code", "errors", "fixed", "fixes"]
    assert [(r["fixed"], r["fixes"]) for r in found.collect()] == [q[2:] for q in QUICK]
    assert p.quick_fixes(d.limit(0), SPACES, "Acme").count() == 0


def test_repairs_read_each_row_in_place(spark):
    d = spark.createDataFrame([("x", ["y"])], "code string, errors array<string>")
    plan = p.quick_fixes(p.runtime_repairs(d).drop("fixed", "fixes"), SPACES, "Acme")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
