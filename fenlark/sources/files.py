"""Readers: tables, Markdown and code files, strict JSON, inventories."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.scratch import folder as shared

FOLDERS = 64  # folders whose files are listed at once


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_files(spark: SparkSession, folder: str | list[str], glob: str = "*.md", exclude: str | None = None) -> DataFrame:
    """(path, text) of all files below a folder or several that match glob and not the regular expression exclude. Small files are read
    by as many tasks as a shuffle has: Spark would make a task of some four to thirty of them, whatever their bytes."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    files = files.select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    files = files.where(~F.col("path").rlike(exclude)) if exclude else files
    return files.coalesce(int(spark.conf.get("spark.sql.shuffle.partitions")))


def scanned(spark: SparkSession, folders: list[str], take: Callable[[DataFrame], DataFrame], glob: str = "*.md", exclude: str | None = None) -> DataFrame:
    """take of text_files() below folders, FOLDERS at a time, as a table in the shared folder. Spark's driver holds what it
    lists, some kilobytes a file: so it holds that of a round."""
    out, schema = shared(spark), take(spark.createDataFrame([], "path string, text string")).schema
    for low in range(0, len(folders), FOLDERS):
        some = folders[low : low + FOLDERS]
        take(text_files(spark, some, glob, exclude).coalesce(len(some))).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out) if folders else spark.createDataFrame([], schema)


def json_records(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """Strict: a record that breaks the schema fails the job."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(extension, files, bytes) below folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return files.groupBy(ext.alias("extension")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
