"""The live job: decode both streams, land everything, enrich cases, compute
per-batch KPIs, and publish cases joined to the surveys of the same batch.

Every output of a batch goes to a folder (or message key) of its own
``batch_id``, written with dynamic partition overwrite: a replayed batch, which
holds the same records because the offsets are in the checkpoint, replaces its
rows and never adds a second copy.  ``land_stream`` is the plain alternative
for one stream: the file sink, whose commit log makes it exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casekit import schemas
from casekit.functions.jsonio import damaged_messages, decode_json, decode_marked, split_marked
from casekit.operators.enrich import DimSpec, prepare
from casekit.operators.kpi import live_priority_counts, live_status_counts, show_kpis
from casekit.streaming.join import CASE, SURVEY, join_case_survey, publish_batch, tag_messages


def decode_cases(messages: DataFrame, bad: str = "drop", keep: tuple[str, ...] = ()):
    """Case messages -> typed case records (timestamps as TIMESTAMP_NTZ)."""
    return decode_json(messages, schemas.CASE, bad=bad, keep=keep)


def decode_surveys(messages: DataFrame, bad: str = "drop", keep: tuple[str, ...] = ()):
    """Survey messages -> typed survey records (answers as int)."""
    return decode_json(messages, schemas.SURVEY, bad=bad, keep=keep)


def priority_join(lookup: DataFrame, columns: tuple[str, ...] = (
        "Priority_key", "priority", "severity")) -> Callable[[DataFrame], DataFrame]:
    """A function that gives cases their category's priority (NULL when unknown).

    ``lookup`` is static (category ⋈ priority); it is guarded and measured here,
    once, and not again in every micro-batch.
    """
    return prepare([DimSpec(lookup, left=["category", "sub_category"],
                            right=["category_key", "sub_category_key"], columns=list(columns),
                            name="case_priority")])


class FollowingLookup:
    """``priority_join`` over a lookup that changes while the stream runs.

    ``version`` tells which version of the dimension is current (a small control read, e.g.
    ``VersionedTable.current``); ``load`` reads the lookup.  Every batch asks for the version;
    only when it has changed is the lookup loaded, guarded and measured again.
    """

    def __init__(self, version: Callable[[], object], load: Callable[[], DataFrame]):
        self.version, self.load = version, load
        self.prepared: tuple[object, Callable[[DataFrame], DataFrame]] | None = None
        self.loads = 0

    def __call__(self, cases: DataFrame) -> DataFrame:
        now = self.version()
        if self.prepared is None or self.prepared[0] != now:
            self.prepared = (now, priority_join(self.load()))
            self.loads += 1
        return self.prepared[1](cases)


def enrich_stream(cases: DataFrame, lookup: DataFrame) -> DataFrame:
    """Every case of a stream with its category's priority."""
    return priority_join(lookup)(cases)


def land_stream(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                trigger: dict | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to a table directory, exactly once."""
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(**(trigger or {"processingTime": "15 seconds"}))
    return w.start(path)


@dataclass
class LiveSinks:
    """Folders of the live job's outputs, each partitioned by ``batch_id``; ``published``
    may be a folder or None with ``publish_options`` for a topic."""
    cases: str
    surveys: str
    rejects: str
    status: str
    priority: str
    published: str | None = None
    publish_options: dict | None = None

    @classmethod
    def under(cls, root: str, **more) -> LiveSinks:
        names = ("cases", "surveys", "rejects", "status", "priority")
        return cls(**{n: f"{root.rstrip('/')}/{n}" for n in names}, **more)


def replace_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch into its own ``batch_id`` folder, in place of what is there."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


#: The fields of cases and surveys.
_BOTH = T.StructType([*schemas.CASE.fields, *[
    f for f in schemas.SURVEY.fields if f.name not in schemas.CASE.fieldNames()]])


def _land_kind(batch: DataFrame, kind: str, schema: T.StructType, path: str, batch_id: int) -> DataFrame:
    """Decode the messages of one kind straight into the batch's landing folder; the records
    as they have landed."""
    messages, spark = batch.where(F.col("kind") == kind), batch.sparkSession
    replace_batch(decode_json(messages, schema), path, batch_id)
    try:
        return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    except AnalysisException as e:              # no record, no folder
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def live_batch_writer(sinks: LiveSinks, with_priority: Callable[[DataFrame], DataFrame],
                      show: int = 0) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler over tagged messages: every output of a batch.

    Messages are decoded once, into the landing folders; the KPIs and the join read what has
    landed, the columns that they need, and nothing is cached.  Records that cannot be decoded
    land with their raw text; of the other messages this takes a look whether they parse.
    ``show`` prints that many KPI rows of every batch.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():                      # reads one message
            return
        cases = _land_kind(batch, CASE, schemas.CASE, sinks.cases, batch_id)
        surveys = _land_kind(batch, SURVEY, schemas.SURVEY, sinks.surveys, batch_id)
        broken = damaged_messages(batch, _BOTH)
        replace_batch(split_marked(decode_marked(broken, _BOTH, keep=("kind",)), _BOTH, keep=("kind",))[1],
                      sinks.rejects, batch_id)
        if not cases.isEmpty():
            enriched = with_priority(cases)
            for frame, path in ((live_status_counts(enriched), sinks.status),
                                (live_priority_counts(enriched), sinks.priority)):
                if show:
                    show_kpis(frame, show)
                replace_batch(frame.coalesce(1), path, batch_id)
        if sinks.published or sinks.publish_options:
            joined = join_case_survey(cases, surveys)
            publish_batch(joined, batch_id, "kafka" if sinks.publish_options else "text",
                          sinks.published, sinks.publish_options)
    return handle


def start_live(cases: DataFrame, surveys: DataFrame, sinks: LiveSinks,
               lookup: DataFrame | FollowingLookup, checkpoint: str, trigger: dict | None = None,
               show: int = 0) -> StreamingQuery:
    """Start the live query over two message streams.  ``lookup`` is read once, or followed
    from batch to batch (``FollowingLookup``)."""
    joined = lookup if isinstance(lookup, FollowingLookup) else priority_join(lookup)
    handler = live_batch_writer(sinks, joined, show)
    return (tag_messages(cases, surveys).writeStream.foreachBatch(handler)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "15 seconds"})).start())
