"""Warehouse tables: partitioned writes, dynamic partition overwrite, landing.

A target is a path (contains ``/`` or ``:``) or a catalog table name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casekit.functions.casting import conform


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def spread_for_write(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition value brought together, in tasks of bounded size.

    ``REBALANCE`` shuffles by the partition columns once; AQE then splits a
    value that holds a large share of the rows into several tasks and merges
    small ones (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).  Unlike
    a range partitioning it needs no sampling pass over the input.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def write_table(df: DataFrame, target: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite", fmt: str = "parquet",
                bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Write a (partitioned) table; schema from the frame.

    ``overwrite`` replaces the whole table, whatever
    ``spark.sql.sources.partitionOverwriteMode`` says in the session.
    ``bucket_by=(n, cols)`` (catalog tables only) stores rows hashed into
    ``n`` buckets by ``cols``: two tables bucketed alike on a join key are
    joined without shuffling either side, the remedy for a dimension too
    large to broadcast.
    """
    if bucket_by and _is_path(target):
        raise ValueError("bucketing needs a catalog table name, not a path")
    out = df if bucket_by else spread_for_write(df, partition_by)
    w = out.write.mode(mode).format(fmt).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    if _is_path(target):
        w.save(target)
    else:
        w.saveAsTable(target)


def refresh_staging(df: DataFrame, target: str, partition_by: Sequence[str] = (),
                    fmt: str = "parquet") -> None:
    """Full refresh of a staging table (old content replaced)."""
    write_table(df, target, partition_by, mode="overwrite", fmt=fmt)


def declared(df: DataFrame, schema: T.StructType, partition_by: Sequence[str]) -> DataFrame:
    """Columns matched to ``schema`` by name, cast, partition columns last."""
    return conform(df, T.StructType([f for f in schema.fields if f.name not in partition_by]
                                    + [schema[p] for p in partition_by]))


def rebuild_table(df: DataFrame, target: str, schema: T.StructType,
                  partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """A table that is computed afresh: all old partitions go, also those that the new
    rows do not touch (a case that moved to another date leaves no row behind)."""
    write_table(declared(df, schema, partition_by), target, partition_by, fmt=fmt)


def overwrite_partitions(df: DataFrame, target: str, schema: T.StructType,
                         partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``; others stay.

    Columns are matched to ``schema`` by name and cast (never by position),
    with the partition columns last.
    """
    w = (spread_for_write(declared(df, schema, partition_by), partition_by).write
         .mode("overwrite").option("partitionOverwriteMode", "dynamic"))
    if _is_path(target):
        w.partitionBy(*partition_by).format(fmt).save(target)
    else:
        w.insertInto(target, overwrite=True)


def append_table(df: DataFrame, target: str, schema: T.StructType, partition_by: Sequence[str] = (),
                 fmt: str = "parquet") -> None:
    """Add rows to a table; columns matched by name, partition columns last.  A catalog table
    that is not there yet is made with its declared columns first."""
    out = spread_for_write(declared(df, schema, partition_by), partition_by)
    if not _is_path(target):
        ensure_table(df.sparkSession, target, schema, partition_by, fmt)
        out.write.mode("append").insertInto(target)
        return
    w = out.write.mode("append").format(fmt)
    (w.partitionBy(*partition_by) if partition_by else w).save(target)


def replace_catalog_table(df: DataFrame, name: str, schema: T.StructType | None = None,
                          partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace a catalog table: the rows are written to ``<name>__next`` first, so a write that
    fails leaves the old table; then the old one is dropped and the new one takes its name.
    With a schema the columns are the declared ones."""
    spark, following = df.sparkSession, f"{name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    if schema is not None:
        ensure_table(spark, following, schema, partition_by, fmt)
        append_table(df, following, schema, partition_by, fmt)
    else:
        write_table(df, following, partition_by, mode="errorifexists", fmt=fmt)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {name}")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """CREATE TABLE IF NOT EXISTS with declared columns (partition columns last)."""
    ordered = [f for f in schema.fields if f.name not in partition_by] + \
        [schema[p] for p in partition_by]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered)
    part = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}{part}")


def read_table(spark: SparkSession, target: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Read a table by path or name (optionally with a declared schema)."""
    if not _is_path(target):
        return spark.table(target)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(target)


def read_landing(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "parquet", after_batch: int | None = None) -> DataFrame:
    """The append-only landing table as typed records; with ``after_batch`` only the
    batches that arrived after that one are listed and read."""
    if after_batch is None:
        return conform(read_table(spark, path, schema, fmt), schema, strict=False)
    rows = spark.read.format(fmt).load(path).where(F.col("batch_id") > after_batch)
    return conform(rows, schema, strict=False)
