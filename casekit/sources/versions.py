"""Tables that are replaced as a whole, without a moment in which they are not there.

A versioned table is a folder:

    <root>/data/<version>-<id>/...    the rows of one version, never changed in place
    <root>/pointer/                   one small file a version: (version, folder, buckets)

A new version is written beside the old one and becomes current by the pointer file, which
the commit of its writer makes visible at once.  Until then, and if the write fails at any
point, readers get the old version.  Readers that hold the old one keep it until ``vacuum``.
One writer at a time, as the jobs have it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from casekit.sources.tables import spread_for_write

_POINTER = "version long, folder string, buckets int"


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    buckets: int | None = None


def read_small(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A small table of control rows, None where it was never written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_small(spark: SparkSession, path: str, schema: str, row: tuple) -> None:
    """One control row more, in a file of its own (all or nothing)."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class VersionedTable:
    """The versions of one table under ``root``."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def _versions(self) -> list[Version]:
        """All versions, oldest first (a pointer file each; ``vacuum`` keeps them few)."""
        rows = read_small(self.spark, f"{self.root}/pointer", _POINTER)
        return [] if rows is None else [Version(*r) for r in rows.orderBy("version", "folder").collect()]

    def current(self) -> Version | None:
        found = self._versions()
        return found[-1] if found else None

    def new_folder(self) -> tuple[int, str]:
        """Number and folder of the version to write next."""
        now = self.current()
        number = now.number + 1 if now else 1
        return number, f"{self.root}/data/{number}-{uuid.uuid4().hex[:12]}"

    def switch(self, number: int, folder: str, buckets: int | None = None) -> Version:
        """Make a written folder the current version."""
        append_small(self.spark, f"{self.root}/pointer", _POINTER, (number, folder, buckets))
        return Version(number, folder, buckets)

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> Version:
        """Write ``df`` as the next version, then make it the current one."""
        number, folder = self.new_folder()
        w = spread_for_write(df, partition_by).write.format(self.fmt)
        (w.partitionBy(*partition_by) if partition_by else w).save(folder)
        return self.switch(number, folder)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        now = self.current()
        if now is None:
            raise ValueError(f"{self.root} has no version yet")
        r = self.spark.read.format(self.fmt)
        return (r.schema(schema) if schema is not None else r).load(now.folder)

    def vacuum(self, keep: int = 2) -> int:
        """Delete the rows of all but the newest ``keep`` versions; how many went."""
        old = self._versions()[:-max(1, keep)]
        for v in old:
            remove_folder(self.spark, v.folder)
        return len(old)


class BucketedTable(VersionedTable):
    """A versioned table bucketed and sorted by a key.

    The bucket count stays that of the first version, whatever the session's shuffle width
    is later.  A version is registered in the session catalog when it is opened, so a fresh
    catalog sees the same files the same way.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, schema: T.StructType,
                 buckets: int | None = None):
        super().__init__(spark, root)
        self.key, self.schema, self._wanted = key, schema, buckets

    @property
    def buckets(self) -> int:
        now = self.current()
        if now and now.buckets:
            return now.buckets
        return self._wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _name(self, folder: str) -> str:
        return "casekit_" + folder.rsplit("-", 1)[1]

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> Version:
        """Write ``df``; where it comes hash-partitioned by the key into as many partitions
        as there are buckets, no row moves and every task writes one file."""
        if partition_by:
            raise ValueError("a bucketed table has no partitions")
        number, folder = self.new_folder()
        n = self.buckets
        (df.select(*self.schema.fieldNames()).write.format("parquet").bucketBy(n, self.key)
         .sortBy(self.key).option("path", folder).saveAsTable(self._name(folder)))
        return self.switch(number, folder, n)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        now = self.current()
        if now is None:
            raise ValueError(f"{self.root} has no version yet")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._name(now.folder)} ({cols}) USING parquet "
                       f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {now.buckets} "
                       f"BUCKETS LOCATION '{now.folder}'")
        return self.spark.table(self._name(now.folder))

