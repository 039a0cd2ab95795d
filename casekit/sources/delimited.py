"""Delimited text files (tab-separated with a header by default)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from casekit.functions.casting import conform


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   sep: str = "\t", header: bool = True, options: dict | None = None) -> DataFrame:
    """Read every column as text (no inference pass), then conform if ``schema``.

    Columns are matched to ``schema`` by header name, so the file's column
    order does not matter; values that do not convert become NULL.
    """
    r = spark.read.option("sep", sep).option("header", str(header).lower()) \
        .option("inferSchema", "false").options(**(options or {}))
    df = r.csv(path)
    return conform(df, schema) if schema is not None else df


def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = True,
                    mode: str = "errorifexists") -> None:
    """Write ``df`` as delimited text (one file per partition)."""
    df.write.mode(mode).option("sep", sep).option("header", str(header).lower()).csv(path)
