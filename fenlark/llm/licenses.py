"""License scan: fixed phrases, and diagonal voting of word 3-grams against template notices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import table

K = 3
NEAR = 2  # diagonals so close belong to one place: a word more or less in between
COVER = 0.9  # share of a template's words that a verified span holds
LONG = 24  # or so many of its words, for long templates
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrase and label.
PHRASES = [(("cc", "by"), "cc-by"), (("general", "public", "license"), "gpl"), (("all", "rights", "reserved"), "reserved")]
# Label and the public text of a licence, or of the notice by which works name it.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("agpl-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"),
]


def lowered(text: Column) -> Column:
    """A-Z in lower case. lower() does other letters too, which changes no word and no phrase, once the
    two letters whose small forms hold ASCII are out of its way."""
    text = F.coalesce(text, F.lit(""))
    return F.lower(F.replace(F.replace(text, F.lit("K"), F.lit("é")), F.lit("İ"), F.lit("é")))


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def grams(w: Column) -> Column:
    """Rolling 64-bit hashes of K words; none for fewer words."""
    none = F.array().cast("array<bigint>")
    return _of(w, lambda w: F.when(F.size(w) >= K, F.transform(F.sequence(F.lit(0), F.size(w) - K), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(K))))).otherwise(none))


def _of(x: Column, f) -> Column:
    """f(x) with x computed once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _places(w: Column) -> Column:
    """array<struct<at, label>>: every place where a phrase's words stand consecutively."""
    out = []
    for phrase, label in PHRASES:
        hit = lambda i, p=phrase: reduce(lambda a, b: a & b, [F.get(w, i + j) == x for j, x in enumerate(p)])
        found = F.filter(F.sequence(F.lit(0), F.size(w) - 1), _one(hit))
        out.append(F.transform(found, _one(lambda i, label=label: F.struct(i.alias("at"), F.lit(label).alias("label")))))
    return F.concat(*out)


def _one(f):
    return lambda i: f(i)


def _templates(spark: SparkSession) -> DataFrame:
    """(h, template, label, at, size, first, last): every gram of every template with its first and last word; bounded by the list above."""
    rows = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(k).alias("label"), F.lit(t).alias("text")) for i, (k, t) in enumerate(TEMPLATES)))
    t = spark.range(1).select(F.explode(rows).alias("t")).select("t.*").withColumn("w", words(F.col("text")))
    return t.select("template", "label", F.size("w").alias("size"), "w", F.posexplode(grams(F.col("w"))).alias("at", "h")).select("template", "label", "size", "at", "h", F.get("w", "at").alias("first"), F.get("w", F.col("at") + K - 1).alias("last"))


def template_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, template, label, start, end, cover): verified places of the templates, in words, end exclusive.

    All rolling K-word hashes are joined to the templates' positions; matches vote for their offset's
    diagonal, neighbouring diagonals are merged, and a span is verified by its words, by the distinct
    template words that its votes cover and by its length. A null or short text has no spans; rows that
    repeat doc_id and text give their spans once.
    """
    spark = docs.sparkSession
    none = F.array().cast("array<struct<pos:int,h:bigint,a:string,b:string>>")
    numbered = _of(words(F.col("text")), lambda w: F.when(F.size(w) >= K, F.transform(F.sequence(F.lit(0), F.size(w) - K), _one(lambda i: F.struct(i.alias("pos"), F.xxhash64(*(F.get(w, i + j) for j in range(K))).alias("h"), F.get(w, i).alias("a"), F.get(w, i + K - 1).alias("b"))))).otherwise(none))
    d = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.inline(numbered))
    # of neighbouring grams every word is a first or a last one, so that words are compared and not hashes alone
    hits = d.join(F.broadcast(_templates(spark)), "h").where("a = first and b = last")
    key = ["doc_id", "text_hash", "template", "label", "size"]
    diagonal = hits.groupBy(*key, (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.min("pos").alias("low"), F.max("pos").alias("high"), F.collect_set("at").alias("ats"))
    side = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    new = (F.col("diagonal") - F.lag("diagonal").over(side) > NEAR) | F.lag("diagonal").over(side).isNull()
    place = diagonal.withColumn("new", new.cast("int")).withColumn("place", F.sum("new").over(side.rowsBetween(Window.unboundedPreceding, 0)))
    merged = place.groupBy(*key, "place").agg(F.min("low").alias("start"), (F.max("high") + K).alias("end"), F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"))
    # the template words that the matched grams cover
    covered = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.transform(F.sequence(F.lit(0), F.lit(K - 1)), lambda j: a + j)))))
    merged = merged.withColumn("covered", covered).withColumn("cover", F.col("covered") / F.col("size"))
    whole = (F.col("cover") >= COVER) | (F.col("covered") >= LONG)
    return merged.where(whole & (F.col("end") - F.col("start") <= F.col("covered") * 3 / 2)).drop("ats", "place", "covered", "size")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row a document.

    Base labels are those of fixed phrases; the templates add theirs. score is 1 where a phrase stands,
    else the largest share of a template in the text, else 0. A null text is an empty one. Rows that
    repeat doc_id and text get equal results; a null doc_id is kept. Other columns are ignored.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    low = lowered(F.col("text"))
    some = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.contains(low, F.lit(x)) for x in p]) for p, _ in PHRASES])
    none = F.array().cast("array<struct<at:int,label:string>>")
    told = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _of(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.when(some & (F.size(w) > 0), _places(w)).otherwise(none).alias("places"))).alias("r"))
    told = told.select("doc_id", "text_hash", "r.n_words", "r.places")
    named = template_spans(docs).groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("own"), F.max("cover").alias("cover"))
    named = named.withColumnRenamed("doc_id", "id").withColumnRenamed("text_hash", "hash")
    out = told.join(named, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    at, labels = F.transform("places", lambda p: p["at"]), F.transform("places", lambda p: p["label"])
    base = F.array_sort(F.array_distinct(labels))
    return out.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("own", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )


def op9_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
