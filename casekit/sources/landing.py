"""The landing folders of the live job: compaction, and reading around it.

The live job leaves one folder a micro-batch (``batch_id=N``).  ``compact_landing`` gathers
the batches that are finished into files of bounded size in a new folder and then adds a row
to the manifest: (version, through_batch, folder).  Readers take the newest manifest row:
its folder, and the batch folders after ``through_batch``.  So they see the old set or the
new one, never both; a compaction that dies leaves a folder that no manifest row names.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casekit.functions.casting import conform
from casekit.sources.versions import append_small, read_small, remove_folder

_MANIFEST = "version long, through_batch long, folder string"


def _manifest_path(path: str) -> str:
    return path.rstrip("/") + "_manifest"


def manifest(spark: SparkSession, path: str) -> tuple[int, int, str] | None:
    """The newest manifest row of a landing folder."""
    rows = read_small(spark, _manifest_path(path), _MANIFEST)
    top = rows.orderBy(F.desc("version")).first() if rows is not None else None
    return tuple(top) if top else None


def _batches(spark: SparkSession, path: str) -> DataFrame | None:
    """The batch folders, None where there are none (yet or any more)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def landed_rows(spark: SparkSession, path: str, after_batch: int | None = None) -> DataFrame | None:
    """Every landed row with its ``batch_id`` (long); with ``after_batch`` only later batches.
    Partition pruning and the manifest keep older files unread."""
    now, loose = manifest(spark, path), _batches(spark, path)
    floor = max((x for x in (after_batch, now and now[1]) if x is not None), default=None)
    if loose is not None:
        loose = loose if floor is None else loose.where(F.col("batch_id") > floor)
        loose = loose.withColumn("batch_id", F.col("batch_id").cast("long"))
    if now is None or (after_batch is not None and after_batch >= now[1]):
        return loose
    packed = spark.read.parquet(now[2])
    if after_batch is not None:
        packed = packed.where(F.col("batch_id") > after_batch)
    return packed if loose is None else packed.unionByName(loose)


def read_landed(spark: SparkSession, path: str, schema: T.StructType,
                after_batch: int | None = None, through_batch: int | None = None) -> DataFrame:
    """Landed rows as typed records (nothing landed: no rows)."""
    rows = landed_rows(spark, path, after_batch)
    if rows is None:
        return spark.createDataFrame([], schema)
    if through_batch is not None:
        rows = rows.where(F.col("batch_id") <= through_batch)
    return conform(rows, schema, strict=False)


def newest_batch(spark: SparkSession, path: str) -> int | None:
    """The highest batch that has landed."""
    rows = landed_rows(spark, path)
    return None if rows is None else rows.agg(F.max("batch_id")).first()[0]


def compact_landing(spark: SparkSession, path: str, leave: int = 1, max_rows_a_file: int = 2_000_000,
                    remove: bool = False) -> int | None:
    """Gather all but the newest ``leave`` batches into sized files; the manifest's new
    ``through_batch``, None if there was nothing to do.

    The newest batch may still be written again by a restarted job, so at least one is left.
    Rows are spread by batch (``REBALANCE``: AQE splits a large one, merges small ones), so a
    file holds few batches and ``after_batch`` skips files by their statistics.  ``remove``
    deletes the gathered batch folders and the former compacted folder at once; leave it
    until no reader of the former manifest is left, and call ``remove_compacted``.
    """
    if leave < 1:
        raise ValueError("the newest batch may still be replaced: leave at least one")
    newest, now = newest_batch(spark, path), manifest(spark, path)
    if newest is None or newest - leave <= (now[1] if now else -1):
        return None
    through = newest - leave
    folder = f"{path.rstrip('/')}_compacted/{through}-{uuid.uuid4().hex[:12]}"
    (landed_rows(spark, path).where(F.col("batch_id") <= through).hint("rebalance", F.col("batch_id"))
     .sortWithinPartitions("batch_id").write.option("maxRecordsPerFile", max_rows_a_file).parquet(folder))
    append_small(spark, _manifest_path(path), _MANIFEST, (now[0] + 1 if now else 1, through, folder))
    if remove:
        remove_compacted(spark, path)
    return through


def remove_compacted(spark: SparkSession, path: str) -> None:
    """Delete what the newest manifest row has replaced."""
    rows = read_small(spark, _manifest_path(path), _MANIFEST)
    if rows is None:
        return
    *old, now = sorted(tuple(r) for r in rows.collect())
    for _, _, folder in old:
        remove_folder(spark, folder)
    loose = _batches(spark, path)
    if loose is None:
        return
    for r in loose.where(F.col("batch_id") <= now[1]).select("batch_id").distinct().collect():
        remove_folder(spark, f"{path.rstrip('/')}/batch_id={r.batch_id}")
