"""The daily run without re-reading what is already there.

* ``merge_increment`` (JOB-5 and JOB-6 for new batches): a ledger in the warehouse says
  through which batch the landing has been merged.  Later batches are compared with those
  partitions of the merged table that they touch, and only rows that are not there yet are
  appended.  Partitions that the increment does not touch are not read.  If the job dies
  after the append and before the ledger, the next run finds the rows there and adds nothing.
* ``update_latest`` (WIN-1 for new batches): the newest version of every case and the newest
  survey are kept in tables bucketed by ``case_no``.  An increment is first reduced to its own
  newest rows and meets the state in one sort-merge join; the state is not shuffled, neither
  when it is read nor when the next version of it is written.
* ``fact_from_latest`` (JOB-7): both states have the same buckets, so they join in place.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casekit import schemas
from casekit.functions.casting import conform, trunc_seconds, with_event_date, with_load_stamp
from casekit.operators.merge import latest_per_key
from casekit.sources.landing import newest_batch, read_landed
from casekit.sources.tables import append_table
from casekit.sources.versions import BucketedTable, append_small, read_small

_LEDGER = "stream string, through_batch long, merged_at string"


class Ledger:
    """Which batches of each landing stream have been consumed, by which job."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def through(self, stream: str) -> int | None:
        """The last consumed batch of a stream."""
        rows = read_small(self.spark, self.path, _LEDGER)
        return None if rows is None else rows.where(F.col("stream") == stream).agg(
            F.max("through_batch")).first()[0]

    def consumed(self, stream: str, through_batch: int) -> None:
        append_small(self.spark, self.path, _LEDGER,
                     (stream, through_batch, _dt.datetime.now(_dt.timezone.utc).isoformat()))


def rows_not_in(new: DataFrame, old: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of ``new`` that ``old`` does not hold (NULL equals NULL).  Joined on a
    64-bit digest of the columns and decided by the columns themselves."""
    digest = F.xxhash64(*columns)
    seen = old.select(digest.alias("__d"), F.struct(*columns).alias("__row"))
    # in this form the rows are no keys of the join: it deals both sides by the digest alone, and
    # the new rows, dealt so to become distinct, stay where they are
    equal = F.exists(F.array("__row"), lambda r: r.eqNullSafe(F.struct(*columns)))
    same = (F.col("__new") == F.col("__d")) & equal
    return (new.select(*columns, digest.alias("__new")).repartition("__new").distinct()
            .join(seen, same, "left_anti").drop("__new"))


def within_range(rows: DataFrame, column: str) -> Column:
    """A filter for the values of ``column`` from the least to the greatest in ``rows``, and
    for NULL where ``rows`` has it: no row outside it can equal one of ``rows``."""
    c = F.col(column)
    lo, hi, nulls = rows.agg(F.min(c).cast("string"), F.max(c).cast("string"),
                             F.count_if(c.isNull())).first()
    kind = rows.schema[column].dataType
    known = F.lit(False) if lo is None else c.between(F.lit(lo).cast(kind), F.lit(hi).cast(kind))
    return (known | c.isNull()) if nulls else known


def touched_partitions(rows: DataFrame, column: str) -> Column:
    """A filter for the values of ``column`` in ``rows``, as literals, so that a scan leaves
    the other partitions alone.  The values are dates: the driver holds one a day."""
    days = [r[0] for r in rows.select(column).distinct().collect()]
    known = F.col(column).isin(*[d for d in days if d is not None]) if any(days) else F.lit(False)
    return (known | F.col(column).isNull()) if None in days else known


def merge_rows(spark: SparkSession, wh, key: str, rows: DataFrame, schema: T.StructType,
               part: str, time: str, as_of: _dt.datetime | str | None = None) -> None:
    """Append those of ``rows`` that the merged table does not hold yet.  Of the table only
    the partitions and the range of ``time`` that ``rows`` touches are compared."""
    body = [f.name for f in schema.fields if f.name not in (schemas.STAMP, part)]
    new = with_event_date(conform(rows, T.StructType([schema[n] for n in body]), strict=False),
                          part.replace("_date", "_timestamp"), part)
    there = wh.read(spark, key).where(touched_partitions(new, part)).where(within_range(new, time))
    fresh = rows_not_in(new, there, [*body, part])
    append_table(with_load_stamp(fresh, as_of, schemas.STAMP), wh.location(spark, key), schema,
                 wh.parts(part), wh.fmt)


def merge_increment(spark: SparkSession, wh, as_of: _dt.datetime | str | None = None,
                    landing_cases: str | None = None, landing_surveys: str | None = None) -> dict[str, int]:
    """Merge the landed batches that no earlier run has merged into the daily tables.

    The merged tables must be there (``merge_history``).  Returns the last merged batch of
    each stream that had new ones.
    """
    ledger, landed, done = Ledger(spark, wh.control("merge_ledger")), wh.landing(), {}
    for stream, path, key, record, schema, part, time in (
            ("cases", landing_cases or landed.cases, "case_dly", schemas.CASE,
             schemas.CASE_DLY_MERGE, "create_date", "last_modified_timestamp"),
            ("surveys", landing_surveys or landed.surveys, "survey_dly", schemas.SURVEY,
             schemas.SURVEY_DLY_MERGE, "survey_date", "survey_timestamp")):
        before, newest = ledger.through(stream), newest_batch(spark, path)
        if newest is None or (before is not None and newest <= before):
            continue
        merge_rows(spark, wh, key, read_landed(spark, path, record, before, newest), schema, part,
                   time, as_of)
        ledger.consumed(stream, newest)
        done[stream] = newest
    return done


# ------------------------------------------------------------- latest versions

#: How the newest row of a case is told: by time, newest first, then by these columns.
CASE_TIES = [c for c in schemas.CASE_COLUMNS if c not in ("case_no", "last_modified_timestamp")]
SURVEY_TIES = ["survey_id", "Q1", "Q3", "Q2", "Q5", "Q4"]


def newest_versions(rows: DataFrame, schema: T.StructType, time: str, ties: Sequence[str]) -> DataFrame:
    """One row per case with its time uncut, so that later rows can be compared with it."""
    c = conform(rows, schema)
    if "create_timestamp" in ties:
        c = c.withColumn("create_timestamp", trunc_seconds("create_timestamp"))
    return latest_per_key(c, ["case_no"], [(time, "desc")], tiebreak=list(ties))


def comes_first(a: str, b: str, time: str, ties: Sequence[str]) -> Column:
    """Does row ``a`` stand before row ``b``: by ``time`` descending, then ``ties`` ascending,
    NULL last everywhere?  True where they are equal."""
    def step(x: Column, y: Column, before: Column, rest: Column) -> Column:
        return (F.when(x.eqNullSafe(y), rest).when(y.isNull(), True).when(x.isNull(), False)
                .otherwise(before))
    out = F.lit(True)
    for c in reversed(ties):
        x, y = F.col(f"{a}.{c}"), F.col(f"{b}.{c}")
        out = step(x, y, x < y, out)
    x, y = F.col(f"{a}.{time}"), F.col(f"{b}.{time}")
    return step(x, y, x > y, out)


def update_latest(state: BucketedTable, rows: DataFrame, time: str, ties: Sequence[str]) -> None:
    """The next version of a latest-row table: its rows and ``rows``, the newest of each case.
    Rows without a case number are a case of their own, as in the full build."""
    new = newest_versions(rows, state.schema, time, ties)
    if state.current() is None:
        state.replace(new.repartition(state.buckets, "case_no"))
        return
    columns = state.schema.fieldNames()
    there, new = state.read(), new.repartition(state.buckets, "case_no")
    packed = lambda df, name: df.where("case_no IS NOT NULL").select(
        F.col("case_no").alias(f"{name}_no"), F.struct(*columns).alias(name))
    both = packed(there, "old").join(packed(new, "new").hint("merge"),
                                     F.col("old_no") == F.col("new_no"), "full_outer")
    newer = F.col("old").isNull() | (F.col("new").isNotNull() & ~comes_first("old", "new", time, ties))
    known = both.select(F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row")).select("row.*")
    # at most two rows without a case number: the state's and the increment's
    lone = latest_per_key(there.unionByName(new).where("case_no IS NULL"), ["case_no"],
                          [(time, "desc")], tiebreak=list(ties))
    state.replace(known.unionByName(lone))


def latest_tables(spark: SparkSession, wh, buckets: int | None = None) -> tuple[BucketedTable, BucketedTable]:
    """The bucketed newest cases and newest surveys of a warehouse."""
    return (BucketedTable(spark, wh.control("latest_case"), "case_no", schemas.CASE, buckets),
            BucketedTable(spark, wh.control("latest_survey"), "case_no", schemas.SURVEY, buckets))


def update_latest_tables(spark: SparkSession, wh, cases: DataFrame, surveys: DataFrame,
                         buckets: int | None = None) -> None:
    """Both latest-row tables brought up to date with new cases and surveys."""
    case_state, survey_state = latest_tables(spark, wh, buckets)
    update_latest(case_state, cases, "last_modified_timestamp", CASE_TIES)
    update_latest(survey_state, surveys, "survey_timestamp", SURVEY_TIES)


def fact_from_latest(spark: SparkSession, wh, as_of: _dt.datetime | str | None = None) -> DataFrame:
    """The fact of JOB-7 from the latest-row tables: one join, no exchange."""
    case_state, survey_state = latest_tables(spark, wh)
    c = case_state.read().withColumn("last_modified_timestamp", trunc_seconds("last_modified_timestamp"))
    s = survey_state.read().withColumn("survey_timestamp", trunc_seconds("survey_timestamp"))
    j = with_load_stamp(c.join(s.hint("merge"), "case_no", "left"), as_of=as_of, name=schemas.STAMP)
    j = j.withColumn("create_date", F.col("create_timestamp").cast("date"))
    return j.select(*schemas.FACT.fieldNames())
