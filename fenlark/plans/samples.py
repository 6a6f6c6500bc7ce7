"""Texts for what the tables lack: messages, code and articles, one for each row.

A frame is picked by the row's id; what it holds of the row's own is taken from the table: an article goes on
with the document's whole text, code has comments and strings of its words, a message names its file, place and
value. So every query runs over its whole table and reads its text, and SQL can do the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import read

MESSAGES = [
    "Program.cs(3,7): error CS0246: The type or namespace name 'Archive' could not be found",
    "Program.cs(9,1): error CS0103: The name 'report' does not exist in the current context",
    "Program.cs(12,30): error CS1002: ; expected",
    "Program.cs(40,2): error CS1513: } expected",
    "Program.cs(7,9): error CS0029: Cannot implicitly convert type 'int' to 'string'",
    "Program.cs(8,4): error CS0117: 'Chart' does not contain a definition for 'Export'",
    "Program.cs(8,4): error CS1061: 'Chart' does not contain a definition for 'Draw' and no accessible method",
    "Program.cs(2,7): error CS8803: Top-level statements must precede namespace declarations",
    "Program.cs(1,1): warning CS0168: The variable 'x' is declared but never used",
    "Program.cs(5,5): error CS0104: 'Color' is an ambiguous reference between 'A.Color' and 'B.Color'",
    "Program.cs(5,5): error CS7036: There is no argument given that corresponds to 'path'",
    "Unhandled exception. System.IO.FileNotFoundException: Could not find file 'C:\\data\\in\\Report.docx'.\n   at System.IO.File.Open(String path)\n   at Program.Main()",
    "Unhandled exception. System.IO.DirectoryNotFoundException: Could not find a part of the path 'C:\\data\\output\\'.\n   at Program.Main()",
    "System.NullReferenceException: Object reference not set to an instance of an object.\n   at Shapes.Draw()\n   at Program.Main()",
    "System.ObjectDisposedException: Cannot access a closed Stream.",
    "Invalid password for the archive, cannot decrypt",
    "Build failed: error MSB4018: the task failed unexpectedly",
    "Restore failed: package not found",
    "security warning: certificate invalid for host",
    "license violation detected in module",
    "DROP TABLE examples; --",
    "System.InvalidOperationException: CompressionLevel is not supported ... see --- inner ---",
    "wrong compression method in encoded header of archive.7z",
    "System.IO.FileNotFoundException: Could not find file \"backup.rar\".",
    "directory not found",
    "file is missing",
    "",
]

CODE = [
    'using System;\nusing Acme.Docs;\n\nnamespace Demo\n{\n    public class Program\n    {\n        public static void Main()\n        {\n            var doc = new Document("input.docx");\n            doc.Title = "Annual";\n            doc.Save("output.pdf", SaveFormat.Pdf);\n        }\n    }\n}',
    'var doc = new Document("template.docx");\ndoc.Title = "Draft";\ndoc.Append(Source.Text);\ndoc.Save("result.docx", SaveFormat.Docx);',
    "foreach (var page in pages)\n{\n    page.Render();\n    Console.WriteLine(page.Number);\n}",
    "var pages = doc.Pages;\nvar doc = Load();\nforeach (var page in pages)\n{\n    page.Render();\n}",
    "builder.Append(1);\nbuilder.Flush();\nConsole.WriteLine(2);",
    "public interface IShape\n{\n    void Draw();\n    string Name();\n}",
    "public class Shape\n{\n    public void Draw()\n    {\n        Console.WriteLine(1);\n    }\n}",
    "// only a comment\n/* and\n * another */\n# region",
    "using System;\nusing System.IO;\nnamespace Empty;",
    "",
    "   \n\t",
    'var license = new License();\nlicense.SetLicense("acme.lic");\nvar done = true;',
    'var app = WebApplication.CreateBuilder(args).Build();\napp.MapGet("/", () => "ok");\napp.Run();',
    '[ApiController]\npublic class ItemsController : ControllerBase\n{\n    [HttpGet]\n    public int Get() { return 1; }\n}',
    'public class HomeController : Controller\n{\n    public IActionResult Index() { return View(); }\n}',
    'var a = File.ReadAllText("path/to/file.txt");\nvar key = "YOUR_KEY";\nvar id = "<your-id>";\nvar b = "your-name";\nConsole.WriteLine(a + key + id);',
    'if (x > 1\n{\n    Run();\n}\nvar y = 2;\nvar z = 3;',
    'var open = "{";\nif (open == "}")\n{\n    Run(); // }\n}\nvar done = 1;',
    "{\n  \"name\": \"value\",\n  \"list\": [1, 2],\n  \"n\": 3\n}",
    'public class Reader\n{\n    async Task Run()\n    {\n        using var s = File.OpenRead(@"C:\\data\\source.zip");\n        var r = new BarReader(s, Decode.Code128);\n        await r.ReadAsync();\n        File.WriteAllText("export.txt", r.Text);\n    }\n}',
    'var g = new Generator(Encode.QR, "text");\ng.Parameters.Size = 4;\ng.Parameters.Color = Colors.Red;\ng.Generate("qr.png");',
    'var g = new Generator(Encode.Aztec, "text");\ng.Parameters.Size = 5;\ng.Generate("qr.png");\n// your code here',
    "static class Util\n{\n    internal static int Twice(int n) => 2 * n;\n}\nclass Other { }\nnamespace A { }\nnamespace B { }",
    "This is an explanation of the change.\nIt has no code at all.\nNothing to see here.",
]

TAILS = ["", "\n// Output:\nConsole.WriteLine(0);", "\nSystem.Console.WriteLine(\"sample.zip\");\nint last = 1;", "\n\n/* block\n comment */\nvar tail = new Document(\"blank.docx\");\ntail.Save(\"copy.docx\");"]

#: what every fourth fix does to file names
RENAMED = [("output.pdf", "input.pdf"), ("copy.docx", "template.docx"), ("source.zip", "result.zip")]

ARTICLES = [
    "# Title\nIntro with \"report.docx\" named.\n\n```csharp\nvar d = new Document(\"report.docx\");\nd.Save(\"step1.docx\");\nd.Close();\n```\n\n## Next\nNow load \"step2.docx\" again.\n\n```cs\nvar e = new Document(\"step2.docx\");\ne.Save(\"final.pdf\");\n```\nend",
    "Text only\n# H\nusing System;\nnamespace Demo\nmore text\n    static void Main()",
    "# A\nProse line one.\nProse line two.\n```csharp\nThis block holds\nonly prose lines\nand nothing else\n```\n\n{{% note %}}\nBelow the note.\n\n```python\nprint(1)\n```\nRead \"a.txt\" first.\n```csharp\nOpen(\"b.txt\");\n```",
    "```\nx = 1\n```\n```csharp\nvar x = 1;\n```\n# Late\n```csharp\nvar x = 1;\n```",
    "# Open\n```csharp\nvar never = closed;\n# Heading inside\nmore\n  ```\ninner\n",
    "See \"data.xlsx\" here.\n\n```csharp\nOpen(\"data.xlsx\");\n```\n\n# B\nBut \"other.txt\" there.\n```csharp\nOpen(\"data.xlsx\");\n```\npublic class Loose\n{\n}",
    "",
    "No fences, no headings.\nJust [a link](http://x.y/z) and [mail](mailto:a@b.co).\n",
]


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pick(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def pick_sql(values: list[str], key: str) -> str:
    return f"([{', '.join(map(quoted, values))}])[CAST(({key}) % {len(values)} AS INTEGER) + 1]"


def _placed(message: Column) -> Column:
    """A message with the row's own file, line and value."""
    name = F.concat(F.lit("User"), F.col("user_id").cast("string"), F.lit(".cs("), F.floor("value").cast("string"))
    return F.replace(message, F.lit("Program.cs(3"), name)


def _placed_sql(message: str) -> str:
    return f"replace({message}, 'Program.cs(3', concat('User', user_id, '.cs(', CAST(floor(value) AS BIGINT)))"


def failures(spark, sf_dir) -> DataFrame:
    """events with message, errors (one or two messages), attempt and retries."""
    k = F.col("event_id")
    one, two = _placed(pick(MESSAGES, k)), _placed(pick(MESSAGES, F.floor(k / len(MESSAGES))))
    errors = F.when(k % 3 == 0, F.array(one)).when(k % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(one, two))
    return read(spark, sf_dir, "events").withColumns({"message": one, "errors": errors, "attempt": (k % 6).cast("long"), "retries": (F.col("user_id") % 4).cast("long")})


_ONE, _TWO = _placed_sql(pick_sql(MESSAGES, "event_id")), _placed_sql(pick_sql(MESSAGES, f"event_id // {len(MESSAGES)}"))
FAILURES = f"""(SELECT *, {_ONE} AS message,
 CASE WHEN event_id % 3 = 0 THEN [{_ONE}] WHEN event_id % 7 = 0 THEN CAST([] AS VARCHAR[]) ELSE [{_ONE}, {_TWO}] END AS errors,
 CAST(event_id % 6 AS BIGINT) AS attempt, CAST(user_id % 4 AS BIGINT) AS retries FROM events)"""


def _own() -> Column:
    """What a document says, as a comment and a string of code: its first words."""
    words = F.regexp_replace(F.substring(F.coalesce("text", F.lit("")), 1, 120), "[^A-Za-z0-9 .,]", "")
    return F.concat(F.lit("\n// "), words, F.lit("\nvar note"), F.col("doc_id").cast("string"), F.lit(" = \""), words, F.lit("\";"))


_WORDS = "regexp_replace(substr(coalesce(text, ''), 1, 120), '[^A-Za-z0-9 .,]', '', 'g')"
_OWN = f"concat(chr(10), '// ', {_WORDS}, chr(10), 'var note', doc_id, ' = \"', {_WORDS}, '\";')"


def snippets(spark, sf_dir) -> DataFrame:
    """documents with code and with fixed, another version of it."""
    k = F.col("doc_id")
    code = F.concat(pick(CODE, k), pick(TAILS, F.floor(k / len(CODE))))
    fixed = F.concat(pick(CODE, k + F.floor(k / 7) % 2), pick(TAILS, F.floor(k / len(CODE)) + k % 3))
    for old, new in RENAMED:
        fixed = F.when(k % 4 == 1, F.replace(fixed, F.lit(old), F.lit(new))).otherwise(fixed)
    more = F.when(k % 2 == 0, _own()).otherwise("")
    return read(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.concat(code, more).alias("code"), F.concat(fixed, F.when(k % 6 == 0, F.upper(more)).otherwise(more)).alias("fixed"))


_FIXED = f"concat({pick_sql(CODE, 'doc_id + (doc_id // 7) % 2')}, {pick_sql(TAILS, f'doc_id // {len(CODE)} + doc_id % 3')})"


def _renamed(x: str) -> str:
    for old, new in RENAMED:
        x = f"replace({x}, {quoted(old)}, {quoted(new)})"
    return x


_MORE = f"CASE WHEN doc_id % 2 = 0 THEN {_OWN} ELSE '' END"
SNIPPETS = f"""(SELECT doc_id, source, lang, concat(code, more) AS code, concat(fixed, CASE WHEN doc_id % 6 = 0 THEN upper(more) ELSE more END) AS fixed FROM (SELECT doc_id, source, lang, concat({pick_sql(CODE, 'doc_id')}, {pick_sql(TAILS, f'doc_id // {len(CODE)}')}) AS code,
 CASE WHEN doc_id % 4 = 1 THEN {_renamed(_FIXED)} ELSE {_FIXED} END AS fixed, {_MORE} AS more FROM documents))"""


def articles(spark, sf_dir) -> DataFrame:
    """documents with md: an article that goes on with the document's text; every fifth time its first line is the opening."""
    k, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    md = F.when(k % 5 == 0, F.concat(F.substring_index(text, "\n", 1), F.lit("\n"), pick(ARTICLES, k))).when(k % 5 == 1, pick(ARTICLES, k)).otherwise(F.concat(pick(ARTICLES, k), F.lit("\n"), text))
    return read(spark, sf_dir, "documents").select("doc_id", "source", md.alias("md"))


_ARTICLE = pick_sql(ARTICLES, "doc_id")
MARKDOWN = f"""(SELECT doc_id, source, CASE doc_id % 5 WHEN 0 THEN concat(string_split(coalesce(text, ''), chr(10))[1], chr(10), {_ARTICLE}) WHEN 1 THEN {_ARTICLE} ELSE concat({_ARTICLE}, chr(10), coalesce(text, '')) END AS md FROM documents)"""
