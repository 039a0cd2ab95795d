"""Join of cases and surveys that arrive together, publishing, de-duplication.

Two records meet when they arrive in the same micro-batch, whatever their event
times.  Both inputs are read by ONE query (tagged and unioned), so the offsets
in its checkpoint fix which records a batch holds and a replayed batch joins the
same ones.  The join runs inside the batch: no state, no watermark, nothing late,
and AQE splits a case with very many records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casekit import schemas
from casekit.functions.jsonio import encode_arrays, encode_rows

CASE, SURVEY = "case", "survey"


def tag_messages(cases: DataFrame, surveys: DataFrame) -> DataFrame:
    """Both message streams as one: ``kind`` and ``value``."""
    return (cases.select(F.lit(CASE).alias("kind"), "value")
            .unionByName(surveys.select(F.lit(SURVEY).alias("kind"), "value")))


def join_case_survey(cases: DataFrame, surveys: DataFrame) -> DataFrame:
    """Inner join of one batch on ``case_no``; 18 flat columns."""
    c, s = cases.alias("c"), surveys.alias("s")
    cols = [F.col(f"c.{n}").alias(n) for n in schemas.CASE_COLUMNS]
    cols += [F.col(f"s.{n}").alias(n) for n in schemas.SURVEY_COLUMNS if n != "case_no"]
    return c.join(s, F.col("c.case_no") == F.col("s.case_no")).select(*cols)


#: Published files are compressed (``options`` may say otherwise).
FILE_OPTIONS = {"compression": "lz4"}
#: Records in a published file at most: readers cannot split it.
FILE_RECORDS = 100_000


def publish_batch(df: DataFrame, batch_id: int, fmt: str = "text", path: str | None = None,
                  options: dict | None = None, envelope: str = "row",
                  max_rows: int = 500) -> None:
    """Publish one batch as JSON messages.

    ``envelope='row'`` sends one object per record, ``'array'`` arrays of at most
    ``max_rows`` records.  Files replace the batch's own folder, so a replay
    leaves one copy, and are compressed; a broker gets the batch id as message key, by which a
    consumer tells a replayed batch.
    """
    if envelope not in ("row", "array"):
        raise ValueError("envelope must be 'row' or 'array'")
    out = encode_rows(df) if envelope == "row" else encode_arrays(df, max_rows)
    if fmt == "kafka":
        (out.withColumn("key", F.lit(str(batch_id))).write.format("kafka")
         .options(**(options or {})).save())
    else:
        messages = max(1, FILE_RECORDS // (max_rows if envelope == "array" else 1))
        (out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").format(fmt)
         .options(**{**FILE_OPTIONS, "maxRecordsPerFile": messages, **(options or {})}).save(path))


def publish_json(df: DataFrame, checkpoint: str, fmt: str = "text", path: str | None = None,
                 options: dict | None = None, envelope: str = "row", max_rows: int = 500,
                 trigger: dict | None = None) -> StreamingQuery:
    """Publish a stream, batch by batch (``publish_batch``); empty batches send nothing.

    The number of records sent per batch is reported as the observed metric
    ``published``.  Every batch is computed once, by its write, and not kept.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        publish_batch(batch, batch_id, fmt, path, options, envelope, max_rows)
    return (df.observe("published", F.count(F.lit(1)).alias("rows"))
            .writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "15 seconds"})).start())


def published_rows(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch id, records sent) of a ``publish_json`` query's recent micro-batches."""
    return [(p["batchId"], p["observedMetrics"]["published"]["rows"])
            for p in query.recentProgress if "published" in p["observedMetrics"]]


def dedup_stream(df: DataFrame, keys: list[str], delay: str = "1 hour",
                 arrival: str = "ingest_ts") -> DataFrame:
    """Drop redelivered records: same ``keys``, arriving within ``delay`` of the first.

    The watermark is on the arrival time, which never runs backwards, so no
    record is ever late, however old its event time and however the input is
    cut into batches.
    """
    return (df.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(keys)
            .drop(arrival))


def forward_files(messages: DataFrame, checkpoint: str, fmt: str = "text",
                  path: str | None = None, options: dict | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Forward every line of new files unchanged to a sink (file or topic)."""
    w = (messages.select("value").writeStream.format(fmt).options(**(options or {}))
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"processingTime": "15 seconds"})))
    return w.start(path) if path else w.start()
