"""Deterministic rewriters: built-in where a regular language suffices, Arrow-batched functions elsewhere."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

REGISTRY: dict[str, Callable[[str], str]] = {}


def transformer(name: str):
    """Registers a str -> str function; register_all() offers it to SQL."""

    def add(f):
        REGISTRY[name] = f
        return f

    return add


def register_all(spark: SparkSession) -> None:
    for name, f in REGISTRY.items():
        spark.udf.register(name, _vectorised(f))


def _vectorised(f):
    @pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else f(x))

    return run


def regex_replace(x: Column, pattern: str, replacement: str) -> Column:
    """re.sub's replacement syntax (\\1) on the built-in function."""
    return F.regexp_replace(x, pattern, re.sub(r"\\(\d)", r"$\1", replacement.replace("$", r"\$")))


@transformer("strip_trailing_space")
def _strip_trailing(text: str) -> str:
    return "\n".join(line.rstrip() for line in text.split("\n"))


def collapse_blank_lines(x: Column) -> Column:
    return F.regexp_replace(x, "\n{3,}", "\n\n")
