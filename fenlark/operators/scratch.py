"""Tables that are read again, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir. A local one serves where the setting is unset and Spark runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="fenlark-"))
    return f"{root.rstrip('/')}/fenlark-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: what is read several times is computed once, and lost executors cost tasks only."""
    spark, path = df.sparkSession, folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """df for a join that deals both sides out: none is gathered by the driver. Spark tells a side's size by its files, which
    may be compressed a hundredfold, and leaves out what explode() adds."""
    return df.hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df by keys in as many partitions as a shuffle has: for rows of few bytes and much work, which would be put in a few
    tasks by their size. By a hash of the keys, as a table that a join has dealt by the keys themselves would stay as it is."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*keys))
