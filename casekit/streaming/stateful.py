"""Stream operators that remember earlier batches.

* ``join_streams``: cases and surveys meet whatever batch each arrives in, as long as their
  arrivals are not further apart than ``within``.
* cumulative distinct counts over all batches, exactly (``count_first_seen``: keyed state
  holds which cases have been counted) or as sketches (``sketch_batch``: one mergeable row a
  group and batch, merged when read).
* ``newest_versions_stream``: the newest version of every case, kept in keyed state.

All watermarks and expiries are on arrival or processing time, which never run backwards, so
no record is late however old its event time is and however the input is cut into batches.
State lives in RocksDB (``rocksdb_state``), on disk and in the checkpoint, not on the heap.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from casekit import schemas
from casekit.functions.casting import conform, trunc_seconds
from casekit.functions.texts import pack_texts, split_texts, unpacked_text
from casekit.operators.merge import latest_per_key
from casekit.session import state_partitions
from casekit.streaming.live import replace_batch

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: RocksDB looks a key up before each write only to count the rows of the state: not done.
_STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
               "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}

#: What keeps a large state small on disk (``rocksdb_state``).
_LEAN_CONF = {"spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
              "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "16",
              "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
              "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
              "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None,
                  idle_batches: bool = True, lean: bool = False) -> Iterator[int]:
    """Stateful queries first started inside keep their state in RocksDB, in ``partitions``
    state partitions (default: the default parallelism).  Both stay with the checkpoint.

    Without ``idle_batches`` no batch is run for the watermark alone: state that has expired
    goes in the next batch that has records, and the whole state is looked through half as
    often.  That is right where expiry sends out no rows, as in an inner join.

    With ``lean`` a large state takes less disk: its files are zstd in blocks of 16 KB, none is
    allocated ahead (4 MB a store), copies that a stopped query left with the executors go within
    seconds, and shuffle files with the batch that wrote them."""
    conf = {**_STATE_CONF, **({} if idle_batches else {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}),
            **(_LEAN_CONF if lean else {})}
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        with state_partitions(spark, partitions) as n:
            yield n
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# ------------------------------------------------------------- stream-stream join

def join_streams(cases: DataFrame, surveys: DataFrame, within: str = "1 hour",
                 delay: str = "10 minutes", salts: int = 1, arrival: str = "ingest_ts") -> DataFrame:
    """Every case record joined to every survey record of its case that arrives at most
    ``within`` before or after it, in the same batch or another; 18 flat columns.

    Both inputs carry their arrival time.  A record stays in state until the watermark (the
    newest arrival of the stream that lags, less ``delay``) says that no partner can come any
    more.  With ``salts`` the surveys of one case are dealt over so many state partitions and
    its case records are repeated on each, for cases that hold a large share of all records.

    A case's texts travel and lie in state as one (``pack_texts``), which halves its record.
    """
    texts = [f.name for f in schemas.CASE.fields if f.dataType == T.StringType() and f.name != "case_no"]
    packed = [pack_texts(texts).alias("__texts"), *[c for c in cases.columns if c not in texts]]
    cases = cases.select(*packed)
    c = cases.withColumnRenamed(arrival, "__case_at").withWatermark("__case_at", delay).alias("c")
    s = surveys.withColumnRenamed(arrival, "__survey_at").withWatermark("__survey_at", delay)
    cond = ((F.col("c.case_no") == F.col("s.case_no"))
            & (F.col("__survey_at") >= F.col("__case_at") - F.expr(f"INTERVAL {within}"))
            & (F.col("__survey_at") <= F.col("__case_at") + F.expr(f"INTERVAL {within}")))
    if salts > 1:
        c = cases.withColumnRenamed(arrival, "__case_at").withWatermark("__case_at", delay).withColumn(
            "__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))).alias("c")
        s = s.withColumn("__salt", F.pmod(F.xxhash64("survey_id", "__survey_at"), F.lit(salts)))
        cond = cond & (F.col("c.__salt") == F.col("s.__salt"))
    both = c.join(s.alias("s"), cond).select(
        split_texts("c.__texts").alias("__parts"),
        *[F.col(f"c.{n}").alias(n) for n in schemas.CASE_COLUMNS if n not in texts],
        *[F.col(f"s.{n}").alias(n) for n in schemas.SURVEY_COLUMNS if n != "case_no"])
    fields = {n: unpacked_text("__parts", k).alias(n) for k, n in enumerate(texts)}
    return both.select(*[fields.get(n, F.col(n)) for n in schemas.CASE_SURVEY.fieldNames()])


# ------------------------------------------------------------- cumulative counts

def counted_kinds(cases: DataFrame) -> DataFrame:
    """``(Case_Type, case_no)``: the counts that a case record takes part in."""
    kinds = F.filter(F.array(F.lit("Total Cases"), *[
        F.when(F.col("status") == s, F.lit(f"{s} Cases")) for s in ("Open", "Closed")]),
        lambda k: k.isNotNull())
    return cases.where("case_no IS NOT NULL").select(F.explode(kinds).alias("Case_Type"), "case_no")


def priority_kinds(enriched: DataFrame) -> DataFrame:
    """``(priority, severity, case_no)`` of enriched cases."""
    return enriched.where("case_no IS NOT NULL").select("priority", "severity", "case_no")


def count_first_seen(records: DataFrame, groups: list[str], path: str, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """Exact cumulative distinct counts of ``case_no`` per group.

    Keyed state lets a (group, case) pass only when it is seen for the first time, so the
    counts of the batches add up.  Each batch writes its counts of first-seen cases into its
    own ``batch_id`` folder; a replayed batch replaces them.  The state holds one key per
    group and case, for good: that is what an exact count over all time needs.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(*groups).agg(F.count(F.lit(1)).alias("first_seen"))
        replace_batch(counts.coalesce(1), path, batch_id)

    return (records.select(*groups, "case_no").dropDuplicates([*groups, "case_no"])
            .writeStream.outputMode("append").foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "15 seconds"})).start())


def cumulative_counts(spark: SparkSession, path: str, groups: list[str]) -> DataFrame:
    """``(batch_id, groups, Cases_numbers)``: distinct cases up to and with each batch.  A
    group is listed from the batch on in which it first occurs."""
    counts = spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))
    per = counts.groupBy("batch_id", *groups).agg(F.sum("first_seen").alias("n"))
    grid = (per.select("batch_id").distinct().withColumnRenamed("batch_id", "to_batch")
            .join(per, F.col("batch_id") <= F.col("to_batch")))       # one row a batch and group
    return grid.groupBy(F.col("to_batch").alias("batch_id"), *groups).agg(
        F.sum("n").alias("Cases_numbers"))


#: HyperLogLog with 2^12 registers: standard error 1.04 / sqrt(2^12) = 1.6 %.
SKETCH_BITS = 12


def sketch_batch(groups: list[str], path: str, bits: int = SKETCH_BITS):
    """``foreachBatch`` handler: a sketch of the batch's cases per group, one row each."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.groupBy(*groups).agg(F.hll_sketch_agg("case_no", bits).alias("sketch"))
        replace_batch(rows.coalesce(1), path, batch_id)
    return handle


def sketch_counts(records: DataFrame, groups: list[str], path: str, checkpoint: str,
                  trigger: dict | None = None, bits: int = SKETCH_BITS) -> StreamingQuery:
    """Cumulative distinct counts without keyed state: a mergeable sketch per group and batch,
    a few KB each, however many cases there are."""
    return (records.select(*groups, "case_no").writeStream.foreachBatch(sketch_batch(groups, path, bits))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "15 seconds"})).start())


def merged_sketches(spark: SparkSession, path: str, groups: list[str],
                    through_batch: int | None = None) -> DataFrame:
    """``(groups, Cases_numbers)``: the estimate over all batches (or up to one).  Sketches of
    batches that share cases merge without counting them twice."""
    rows = spark.read.parquet(path)
    if through_batch is not None:
        rows = rows.where(F.col("batch_id") <= through_batch)
    return rows.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("Cases_numbers"))


# ----------------------------------------------------- newest version of each case

def rank_key(time: str, ties: list[str]) -> Column:
    """A text that is greater the earlier a row stands in: ``time`` descending, ``ties``
    ascending, NULL last.  Ascending columns go in as hexadecimal digits turned round, closed
    by a character above all digits; NULL is a character below them."""
    # a time as text, closed by a character below the fraction's point
    stamp = F.coalesce(F.concat(F.col(time).cast("string"), F.lit(" ")), F.lit("!"))
    whole = {"create_timestamp": trunc_seconds("create_timestamp")}
    turned = [F.coalesce(F.concat(F.translate(F.hex(whole.get(c, F.col(c)).cast("string")),
                                              "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G")),
                         F.lit("!")) for c in ties]
    return F.concat(stamp, *turned)


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def ranked_record(time: str, ties: list[str]) -> Column:
    """A record of a case as a struct that is smaller the earlier it stands in: ``time``
    descending, ``ties`` ascending, NULL last.  The record is read from it (``unranked``), so
    that it is not held a second time beside its rank."""
    key = [F.col(time).isNull().alias("t_null"), F.expr(f"{_EPOCH} - `{time}`").alias("t")]
    for n, c in enumerate(ties):
        # whole seconds decide; the time itself goes in last
        value = trunc_seconds(c) if c == "create_timestamp" else F.col(c)
        key += [F.col(c).isNull().alias(f"n{n}"), value.alias(f"v{n}")]
    return F.struct(*key, F.col("create_timestamp").alias("created"))


def unranked(ranked: str, time: str, ties: list[str]) -> list[Column]:
    """The fields of a ``ranked_record``, without its case number."""
    fields = {c: F.col(f"{ranked}.v{n}") for n, c in enumerate(ties)}
    fields["create_timestamp"] = F.col(f"{ranked}.created")
    fields[time] = F.expr(f"{_EPOCH} - `{ranked}`.`t`")
    return [f.alias(c) for c, f in fields.items()]


def newest_versions_stream(cases: DataFrame, expire_after: str | None = None, salts: int = 8,
                           time: str = "last_modified_timestamp", arrival: str = "ingest_ts") -> DataFrame:
    """A stream of the newest version of each case that a batch brings news of.

    Without ``expire_after`` the state is that of an aggregate, the record that ranks first,
    held once (``ranked_record``): a batch is reduced to one row per case and task before the shuffle, so a case with
    very many records costs no more than another, and each case that a batch touches comes out
    with its newest version so far.

    With ``expire_after`` (e.g. ``"30 days"``; the records then carry their arrival time) a
    function keeps the rank, and a case's state goes when the watermark says that it has not
    been heard of for so long.  Only newer versions come out.  A case is dealt over ``salts``
    keys, each with the newest of its share, so that several tasks work off a hot case.
    ``newest_landed`` takes the newest of the shares, and ignores an old version that comes
    out again after its state has gone.
    """
    ties = [c for c in schemas.CASE_COLUMNS if c not in ("case_no", time)]
    names = schemas.CASE.fieldNames()
    wait = _milliseconds(expire_after) if expire_after else None
    if not wait:
        newest = cases.groupBy("case_no").agg(F.min(ranked_record(time, ties)).alias("newest"))
        return newest.select("case_no", *unranked("newest", time, ties)).select(*names)
    keyed = cases.withWatermark(arrival, "0 seconds").select(
        *names, rank_key(time, ties).alias("__rank"), F.unix_millis(arrival).alias("__at"),
        F.pmod(F.xxhash64(*names), F.lit(salts)).alias("__salt"), arrival)

    def step(key: tuple, frames: Iterator, state: GroupState) -> Iterator:
        if state.hasTimedOut:
            state.remove()
            return
        before = best = state.get[0] if state.exists else None
        row, heard = None, 0
        for f in frames:
            at = f["__rank"].idxmax()
            rank = f.at[at, "__rank"]
            heard = max(heard, int(f["__at"].max()))
            if best is None or rank > best:
                best, row = rank, f.loc[[at], names]
        if best != before:
            state.update((best,))
        state.setTimeoutTimestamp(heard + wait)
        if row is not None:
            yield row

    return keyed.groupBy("case_no", "__salt").applyInPandasWithState(
        step, outputStructType=T.StructType([schemas.CASE[n] for n in names]),
        stateStructType="rank string", outputMode="update",
        timeoutConf=GroupStateTimeout.EventTimeTimeout)


def _milliseconds(text: str) -> int:
    n, unit = text.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1000


def land_newest(cases: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                expire_after: str | None = None, salts: int = 8) -> StreamingQuery:
    """Land what ``newest_versions_stream`` gives, a folder a batch."""
    return (newest_versions_stream(cases, expire_after, salts).writeStream.outputMode("update")
            .foreachBatch(lambda batch, batch_id: replace_batch(batch, path, batch_id))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "15 seconds"})).start())


def newest_landed(landed: DataFrame) -> DataFrame:
    """The newest version of every case among landed ones (times cut to whole seconds)."""
    ties = [c for c in schemas.CASE_COLUMNS if c not in ("case_no", "last_modified_timestamp")]
    c = conform(landed, schemas.CASE).withColumn("create_timestamp", trunc_seconds("create_timestamp"))
    one = latest_per_key(c, ["case_no"], [("last_modified_timestamp", "desc")], tiebreak=ties)
    return one.withColumn("last_modified_timestamp", trunc_seconds("last_modified_timestamp"))
