"""Exact de-duplication against a persistent digest index.

The index is a table bucketed and sorted by SHA-256 digest.  New data is first
reduced to one row per digest (a map-side combined aggregate, so a text copied a
million times costs one row per map task), then de-duplicated against the index by
a sort-merge anti-join that reads the index without shuffling it, and what is new
is appended.  Only DataFrame operations; no Python on the executors.

Defined results
    * a null text counts as the empty text; all empty texts are equal;
    * of equal texts in one ingested batch the row with the largest id stays;
    * a text that an earlier batch put into the index has its keeper there, so every
      new row with it goes;
    * rows that repeat the same id and text are one document: they get the same verdict, and
      ``keep_first_copies`` keeps one of them;
    * a null id is smaller than any other id; a group of null ids has the null id as keeper;
    * an index opened again has the bucket count it was built with, whatever the session's
      shuffle width is now; asking for another count is an error;
    * an empty batch appends nothing and gives an empty result;
    * other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import one_of_each, stored, text_or_empty, unused


def text_digest(text_col: str) -> Column:
    """Lower-case hex SHA-256 of the text's UTF-8 bytes (null: empty)."""
    return F.sha2(text_or_empty(text_col).cast("binary"), 256)


class DigestIndex:
    """A persistent table ``(digest, keep_id, group_size)``, bucketed and sorted by digest.

    The bucket count is stored beside the files (``<path>.buckets``): files bucketed one way
    must never be read as if they were bucketed another.  It is fixed when the index is first
    made, from ``buckets`` or the session's shuffle width.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int | None = None):
        self.spark, self.name, self.path = spark, name, path
        self.buckets = self._stored_buckets()
        if self.buckets is None:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).write.parquet(f"{path}.buckets")
        elif buckets and buckets != self.buckets:
            raise ValueError(f"the index at {path} has {self.buckets} buckets, not {buckets}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} "
                  f"(digest STRING, keep_id BIGINT, group_size BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def _stored_buckets(self) -> int | None:
        try:
            return self.spark.read.schema("buckets int").parquet(f"{self.path}.buckets").first().buckets
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def frame(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Append one row per digest that the index does not hold yet."""
        fresh = (docs.select(text_digest(text_col).alias("digest"),
                             F.col(id_col).cast("long").alias("id"))
                 .groupBy("digest")
                 .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
        # written: otherwise the optimizer moves the anti-join below the aggregate, and every
        # copy of a text would be shuffled
        fresh = stored(fresh, "digests")
        new = fresh.join(self.frame().select("digest").hint("merge"), "digest", "left_anti")
        (new.repartition(self.buckets, "digest").sortWithinPartitions("digest")
            .write.mode("append").format("parquet")
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))

    def verdicts(self, docs: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
        """One row per input row: id, keeper, group size, whether it stays, digest.

        The index files are read without their bucketing here, so both sides are shuffled
        for the join and AQE can split a digest that holds a large share of the rows.
        """
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                           text_digest(text_col).alias("digest"))
        index = (self.spark.read.schema(self.frame().schema).parquet(self.path)
                 .withColumnRenamed("digest", "i_digest"))
        spread = rows.join(index.hint("merge"), rows.digest == index.i_digest)
        return spread.select("doc_id", "keep_id", "group_size",
                             F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                             F.col("digest").alias("text_sha256"))


def exact_dedup(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Ingest ``docs`` into ``index`` and return the verdict on each of its rows."""
    index.ingest(docs, id_col, text_col)
    return index.verdicts(docs, id_col, text_col)


def keep_first_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each text, with all their columns."""
    index.ingest(docs, id_col, text_col)
    d, k = unused(docs, "digest"), unused(docs, "keep_id")
    digest, own_id = text_digest(text_col), F.col(id_col).cast("long")
    keepers = index.frame().select(F.col("digest").alias(d), F.col("keep_id").alias(k))
    out = docs.join(keepers.hint("merge"), (digest == F.col(d)) & own_id.eqNullSafe(F.col(k)), "left_semi")
    # rows that repeat id and text: one of them stays
    again = stored(docs.groupBy(digest.alias(d), own_id.alias(k)).agg(F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select(d, k), "repeats")
    if again.isEmpty():
        return out
    same = (digest == F.col(d)) & own_id.eqNullSafe(F.col(k))
    return out.join(again, same, "left_anti").unionByName(
        one_of_each(out.join(again, same, "left_semi"), [digest, own_id]))
