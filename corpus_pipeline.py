"""The corpus pipeline: each stage works on all that its predecessor kept.

Documents go in and come out as (doc_id, text, lang, source, n_chars); the last stage adds the tokens.
run() applies the stages one after the other; what a stage returns is written to the shared folder
and read again, so that a lost executor costs a task and not the pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fenlark.llm import decontaminate, minhash, pieces, pii, quality
from fenlark.llm.common import dropped, table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it is fitted on these documents. Null and wordless texts
    stay, repeated rows share a fate, an empty table stays empty, further columns are carried along."""
    return quality.good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (Jaccard of five-word shingles 0.8 or more), that of the
    smallest doc_id. Of rows that repeat a doc_id the least one stays. Rows without doc_id or words all stay."""
    found = written(minhash.near_duplicates(docs, percent=80).select("doc_id", "kept"))
    gone = found.where("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    again = written(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        return left
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = left.join(again, "doc_id", "left_semi").select("doc_id", row.alias("row")).groupBy("doc_id").agg(F.min("row").alias("row")).select("row.*")
    return left.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one.select(docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item. Null and empty texts hold none; repeated rows share a fate; all
    columns are carried along; an empty table or benchmark takes nothing away."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars counts a new text. Null and empty
    texts and all other columns stay as they are."""
    weights, text = pii.train(docs), F.col("text")
    name = "_" + "_".join(docs.columns)  # no column of docs is called that
    held = F.col(f"`{name}`")
    new = F.element_at(F.transform(F.array(pii.personal(held, weights)), lambda s: F.struct(pii.redacted(text, s).alias("text"), (F.size(s) > 0).alias("hit"))), 1)
    same = F.struct(text.alias("text"), F.lit(False).alias("hit"))
    found = docs.withColumn(name, pii.candidates(text)).withColumn(name, F.when(F.size(held) > 0, new).otherwise(same))
    changed = {"text": F.col(f"`{name}`.text"), "n_chars": F.when(F.col(f"`{name}`.hit"), F.length(F.col(f"`{name}`.text")).cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return found.select(*(changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with token_ids, n_tokens and whether decoding gives back the text. A null text has null
    token_ids; columns that have these names are replaced."""
    return pieces.encoded(docs)


STAGES = [("quality", classify), ("near_dedup", deduplicate), ("decontaminate", decontaminated), ("pii", redact), ("sentencepiece", encode)]

#: SQL can't express the sketches, the fitted models or the segmentation; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            dropped(spark, before)  # the stage that read it is done
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
