"""Streaming sources: message brokers and watched directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Input of one micro-batch at most, unless the caller says otherwise.
MAX_FILES, MAX_OFFSETS = 1000, 1_000_000


def stream_messages(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                    options: dict | None = None, max_files: int = MAX_FILES,
                    max_offsets: int = MAX_OFFSETS) -> DataFrame:
    """A stream of text messages in column ``value``, with their arrival time
    ``ingest_ts``.

    ``fmt='kafka'`` takes the usual options (``kafka.bootstrap.servers``,
    ``subscribe`` with a comma-separated topic list, ...); the key is dropped
    and the broker timestamp is the arrival time.  ``fmt='text'`` reads new
    files of a directory line by line (needs no broker; used in tests); the
    batch time is the arrival time.  A backlog is worked off in micro-batches
    of at most ``max_files`` files or ``max_offsets`` messages.
    The Kafka connector jar must be on the classpath for ``fmt='kafka'``.
    """
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        df = r.options(**{"maxOffsetsPerTrigger": str(max_offsets), **(options or {})}).load()
        return df.select(F.col("value").cast("string").alias("value"),
                         F.col("topic"), F.col("timestamp").alias("ingest_ts"))
    r = r.options(**{"maxFilesPerTrigger": str(max_files), **(options or {})})
    df = r.load(path) if path is not None else r.load()
    return df.select(F.col("value").cast("string").alias("value"),
                     F.current_timestamp().alias("ingest_ts"))


def stream_files(spark: SparkSession, directory: str, archive_dir: str | None = None,
                 max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """Watch ``directory``: each line of each new file is one message.

    With ``archive_dir`` a finished file is moved there (the file is never
    read twice, even after a restart, since progress is in the checkpoint).
    """
    r = (spark.readStream.format("text")
         .option("maxFilesPerTrigger", str(max_files_per_trigger)))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.load(directory).select(F.col("value"))
