"""Helpers shared by the training-data operators: shared scratch tables, making
the package importable in Python workers, and small column expressions."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casekit.session import scratch_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_SHIPPED = "spark.casekit.llm.shipped"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers.

    Where the workers already see it (``PYTHONPATH``, or a local session started
    in the repository) nothing happens; otherwise Spark distributes a zip of the
    package once per session.
    """
    sc = spark.sparkContext
    seen = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT in [os.path.abspath(p) for p in seen if p]:
        return
    if sc.master.startswith("local[") and os.path.abspath(os.getcwd()) == _ROOT:
        return
    if spark.conf.get(_SHIPPED, "") == sc.applicationId:
        return
    base = os.path.join(tempfile.mkdtemp(prefix="casekit-zip-"), "casekit_pkg")
    sc.addPyFile(shutil.make_archive(base, "zip", _ROOT, "casekit"))
    spark.conf.set(_SHIPPED, sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh Parquet folder under the shared checkpoint
    directory and read again: later steps never recompute it, and losing an
    executor loses nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return what this worker process has freed to the system.  Workers are reused, so
    memory that an earlier stage freed would otherwise stay with the executor."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc only
    if trim is not None:
        trim(0)


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (the fold of a row)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def hash_fraction(id_col: str) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.xxhash64(id_col).cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def one_of_each(df: DataFrame, keys: list[Column]) -> DataFrame:
    """One row of each key (the least hash of the whole row).  A map task forwards at most
    one row a key, so a key with very many rows costs no more than another."""
    n = unused(df, "n")
    w = Window.partitionBy(*keys).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t]))
    return df.withColumn(n, F.row_number().over(w)).where(F.col(n) == 1).drop(n)
