"""Writers: deterministic JSON, appends, replaced partitions, a file a row."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


FILES = 256  # files of a folder


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object a row, keys in alphabetical order, in the files' own distribution."""
    df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value")).write.mode("overwrite").text(path)


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Overwrites only the partitions that df holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def _local(spark: SparkSession, path: str) -> str | None:
    """The path where a task's own open() reaches it: a shared folder of the local file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def text_files(df: DataFrame, path: str) -> list[str]:
    """A file for each row (name, text) below path, a line's end after the text, and the folders that hold them: some FILES to a
    folder, a name once. Null texts are empty; names are plain and not null.

    A task writes folders of its own, so that those of attempts that failed aren't among those returned. Where only Spark reaches
    path, a file is folder/name=NAME/part-*.txt and rows of a name are its lines: Spark's writer takes a folder a file, and on a
    local file system Hadoop starts a process for each of a file's four modes.
    """
    df = df.select("name", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    local, most = _local(df.sparkSession, path), FILES
    if local is None:
        at = F.pmod(F.xxhash64("name"), F.lit(df.count() // most + 1)).alias("at")
        dealt = df.select(F.col("text").cast("string").alias("value"), at, "name")
        dealt.repartition("at", "name").write.partitionBy("at", "name").text(path)
        return sorted(f"{path}/at={r['at']}" for r in dealt.select("at").distinct().collect())

    def put(batches):
        task, names, n = TaskContext.get().taskAttemptId(), set(), 0
        for batch in batches:
            for name, text in zip(*batch.columns, strict=True):
                name = name.as_py()
                if not names or len(names) == most or name in names:
                    names, n, to = set(), n + 1, f"{task}-{n}"
                    os.makedirs(f"{local}/{to}")
                    yield pa.RecordBatch.from_pydict({"folder": [to]})
                names.add(name)
                with open(f"{local}/{to}/{name}", "wb") as f:
                    f.write(text.as_py() + b"\n")

    return sorted(f"{path}/{r['folder']}" for r in df.mapInArrow(put, "folder string").collect())
