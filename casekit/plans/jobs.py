"""The pipeline's jobs, end to end, over a warehouse folder.

Every job reads its inputs from, and writes its outputs to, tables in a
shared warehouse folder; a written table is where one job's lineage ends and
the next begins, so a lost executor never forces recomputation across jobs.

=========  ======================================================  ==========
job        what it does                                            tables out
=========  ======================================================  ==========
JOB-1      delimited reference files -> typed -> database          (JDBC)
JOB-2      database dimensions -> stamped, partitioned tables      dim_*
JOB-3      database history extracts -> staging tables             *_stg
JOB-4      live streams: landing, per-batch KPIs, join + publish   landing_*
JOB-5      landing tables -> stamped increments                    *_incr
JOB-6      staging UNION increments -> merged daily tables         *_dly
JOB-7      latest case ⟕ latest survey -> fact                     fact
JOB-8      fact ⟕ dimensions, scores, hours -> wide                wide
JOB-9      KPI catalogue over wide (one scan)                      (rows)
JOB-10     forward new files' lines to a sink                      (sink)
=========  ======================================================  ==========
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casekit import schemas
from casekit.config import TableNames
from casekit.functions.casting import conform, with_event_date, with_load_stamp
from casekit.operators.enrich import priority_lookup
from casekit.operators.kpi import kpi_report
from casekit.operators.merge import merge_distinct
from casekit.plans.fact import WideDims, build_fact, build_wide
from casekit.sources.delimited import read_delimited
from casekit.sources.jdbc import read_jdbc, write_jdbc
from casekit.sources.landing import manifest, read_landed
from casekit.sources.tables import declared, read_table, replace_catalog_table
from casekit.sources.versions import VersionedTable
from casekit.streaming.join import forward_files
from casekit.streaming.live import FollowingLookup, LiveSinks, start_live
from casekit.streaming.sources import MAX_FILES, stream_files


@dataclass
class Warehouse:
    """Where the tables are: folders ``<root>/<prefix>_<name>``, or with ``catalog``
    (a database name) tables ``<catalog>.<prefix>_<name>``; ``fmt`` is their format.
    ``by_date=False`` leaves the tables unpartitioned, for data too small for a file a day.

    Jobs replace a table with ``replace``: folders by a new version and a pointer (readers
    and a crash never meet half a table), catalog tables by a second table that takes the
    name.  ``read`` also takes a plain folder that something else has written."""
    root: str
    names: TableNames = field(default_factory=TableNames)
    catalog: str | None = None
    fmt: str = "parquet"
    by_date: bool = True

    def parts(self, *columns: str) -> list[str]:
        return list(columns) if self.by_date else []

    def path(self, key: str) -> str:
        name = self.names.name(key)
        return f"{self.catalog}.{name}" if self.catalog else f"{self.root.rstrip('/')}/{name}"

    def control(self, name: str) -> str:
        """Folder of a table that the jobs keep for themselves (ledger, latest rows)."""
        return f"{self.root.rstrip('/')}/control/{self.names.prefix}_{name}"

    def location(self, spark: SparkSession, key: str) -> str:
        """Where the rows of a table are now: folder, or catalog name."""
        if self.catalog:
            return self.path(key)
        now = VersionedTable(spark, self.path(key), self.fmt).current()
        return now.folder if now else self.path(key)

    def version(self, spark: SparkSession, *keys: str) -> tuple[str, ...]:
        """Changes when a job replaces one of the tables (folder tables)."""
        return tuple(self.location(spark, k) for k in keys)

    def read(self, spark: SparkSession, key: str) -> DataFrame:
        return read_table(spark, self.location(spark, key), fmt=self.fmt)

    def replace(self, df: DataFrame, key: str, partition_by: list[str],
                schema: T.StructType | None = None) -> None:
        """Replace a table as a whole; with a schema its columns are the declared ones."""
        if self.catalog:
            replace_catalog_table(df, self.path(key), schema, partition_by, self.fmt)
            return
        out = declared(df, schema, partition_by) if schema is not None else df
        VersionedTable(df.sparkSession, self.path(key), self.fmt).replace(out, partition_by)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete versions of all folder tables but the newest ``keep``."""
        return 0 if self.catalog else sum(
            VersionedTable(spark, self.path(f.name), self.fmt).vacuum(keep)
            for f in fields(self.names) if f.name != "prefix")

    def landing(self) -> LiveSinks:
        """Folders of the live job."""
        return LiveSinks.under(f"{self.root.rstrip('/')}/live")


# Reference tables by file stem, with their declared schema.
REFERENCE_FILES = {
    "calendar": schemas.CALENDAR, "call_center": schemas.CALL_CENTER,
    "case_category": schemas.CASE_CATEGORY, "country": schemas.COUNTRY,
    "case_priority": schemas.CASE_PRIORITY, "employee": schemas.EMPLOYEE,
    "product": schemas.PRODUCT, "questions": schemas.SURVEY_QUESTION,
    "case_stg": schemas.CASE_HISTORY, "survey_stg": schemas.SURVEY_HISTORY,
}
DIMENSIONS = ["calendar", "call_center", "case_category", "country", "case_priority",
              "employee", "product", "questions"]
# History extracts carry their partition date, derived from the event time.
HISTORY_DATES = {"case_stg": ("create_timestamp", "create_date"),
                 "survey_stg": ("survey_timestamp", "survey_date")}


def reference_frame(spark: SparkSession, key: str, path: str) -> DataFrame:
    """One delimited reference file read as text and conformed to its schema;
    history extracts also get their partition date from the event time."""
    schema = REFERENCE_FILES[key]
    src = schema
    if key in HISTORY_DATES:
        src = T.StructType([f for f in schema.fields if f.name != HISTORY_DATES[key][1]])
    df = read_delimited(spark, path, src)
    if key in HISTORY_DATES:
        ts, d = HISTORY_DATES[key]
        df = with_event_date(df, ts, d)
    return df


def load_reference_tables(spark: SparkSession, files: dict[str, str], url: str,
                          properties: dict, names: TableNames | None = None,
                          mode: str = "errorifexists") -> None:
    """JOB-1: each delimited file (key -> path) conformed and written over JDBC."""
    names = names or TableNames()
    for key, path in files.items():
        write_jdbc(reference_frame(spark, key, path), url, names.name(key), properties, mode=mode)


def load_dimensions(spark: SparkSession, url: str, properties: dict, wh: Warehouse,
                    as_of: _dt.datetime | str | None = None) -> None:
    """JOB-2: database dimensions -> stamped tables, partitioned by load date
    (employees by hire date)."""
    for key in DIMENSIONS:
        refresh_dimension(read_jdbc(spark, url, table=wh.names.name(key),
                                    properties=properties), wh, key, as_of)


def refresh_dimension(df: DataFrame, wh: Warehouse, key: str,
                      as_of: _dt.datetime | str | None = None) -> None:
    """The write half of JOB-2 for one dimension: stamped, partitioned, and replacing
    what an earlier load wrote."""
    part = "hire_date" if key == "employee" else "create_date"
    out = with_load_stamp(df, as_of, date_col=None if key == "employee" else part)
    wh.replace(out, key, wh.parts(part))


def load_history(spark: SparkSession, url: str, properties: dict, wh: Warehouse,
                 as_of: _dt.datetime | str | None = None, num_partitions: int | None = None,
                 bounds: tuple | None = None) -> None:
    """JOB-3: history extracts (projection + load stamp) -> staging tables.

    ``num_partitions`` and ``bounds`` (on the partition date) split the
    extract into parallel range queries instead of one long read.
    """
    for key, cols in (("case_stg", schemas.CASE_COLUMNS), ("survey_stg", schemas.SURVEY_COLUMNS)):
        ts, d = HISTORY_DATES[key]
        query = f"SELECT {', '.join(cols)}, {d} FROM {wh.names.name(key)}"
        kw = {}
        if num_partitions and bounds:
            kw = dict(partition_column=d, lower_bound=bounds[0], upper_bound=bounds[1],
                      num_partitions=num_partitions)
        df = read_jdbc(spark, url, query=query, properties=properties, **kw)
        refresh_history(df, wh, key, as_of)


def refresh_history(df: DataFrame, wh: Warehouse, key: str,
                    as_of: _dt.datetime | str | None = None) -> None:
    """The write half of JOB-3 for one history extract."""
    wh.replace(with_load_stamp(df, as_of), key, wh.parts(HISTORY_DATES[key][1]))


def build_increment(spark: SparkSession, landing_cases: str, landing_surveys: str,
                    wh: Warehouse, as_of: _dt.datetime | str | None = None) -> None:
    """JOB-5: all landed stream records -> stamped increment tables.

    ``incremental.merge_increment`` is the form that takes only new batches.
    """
    for path, schema, out in ((landing_cases, schemas.CASE, "case_incr"),
                              (landing_surveys, schemas.SURVEY, "survey_incr")):
        ts, d = HISTORY_DATES["case_stg" if out == "case_incr" else "survey_stg"]
        rows = with_event_date(_landed_or_plain(spark, path, schema), ts, d)
        wh.replace(with_load_stamp(rows, as_of), out, wh.parts(d))


def _landed_or_plain(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A live job's landing folder, or any other folder of records."""
    if manifest(spark, path) is None:
        plain = read_table(spark, path)
        if "batch_id" not in plain.columns:
            return conform(plain, schema, strict=False)
    return read_landed(spark, path, schema)


def merge_history(spark: SparkSession, wh: Warehouse, as_of: _dt.datetime | str | None = None,
                  increments: bool = True) -> None:
    """JOB-6: staging UNION increment (distinct) -> merged daily tables.  Without
    ``increments`` the merged tables start from the staging tables alone, for
    ``incremental.merge_increment`` to add to."""
    for stg, incr, out, schema, part in (
            ("case_stg", "case_incr", "case_dly", schemas.CASE_DLY_MERGE, "create_date"),
            ("survey_stg", "survey_incr", "survey_dly", schemas.SURVEY_DLY_MERGE, "survey_date")):
        merged = merge_distinct([wh.read(spark, k) for k in ([stg, incr] if increments else [stg])],
                                schema, as_of=as_of)
        wh.replace(merged, out, wh.parts(part), schema)


def build_fact_job(spark: SparkSession, wh: Warehouse,
                   as_of: _dt.datetime | str | None = None) -> None:
    """JOB-7: latest case ⟕ latest survey -> fact (partitioned by create date)."""
    fact = build_fact(wh.read(spark, "case_dly"), wh.read(spark, "survey_dly"), as_of=as_of)
    wh.replace(fact, "fact", wh.parts("create_date"), schemas.FACT)


def warehouse_dims(spark: SparkSession, wh: Warehouse) -> WideDims:
    return WideDims(*[conform(wh.read(spark, k), s, strict=False) for k, s in (
        ("calendar", schemas.CALENDAR), ("call_center", schemas.CALL_CENTER),
        ("case_category", schemas.CASE_CATEGORY), ("case_priority", schemas.CASE_PRIORITY),
        ("employee", schemas.EMPLOYEE), ("product", schemas.PRODUCT),
        ("questions", schemas.SURVEY_QUESTION))])


def build_wide_job(spark: SparkSession, wh: Warehouse) -> None:
    """JOB-8: fact ⟕ dimensions with scores -> wide (partitioned by case create date)."""
    wide = build_wide(wh.read(spark, "fact"), warehouse_dims(spark, wh))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in wide.schema.fields])
    wh.replace(wide, "wide", wh.parts("case_create_date"), schema)


def kpi_job(spark: SparkSession, wh: Warehouse,
            as_of: _dt.datetime | str | None = None) -> DataFrame:
    """JOB-9: the KPI catalogue in one scan of the wide table.

    Only the nine columns the KPIs use are read (column pruning reaches the
    Parquet scan).
    """
    return kpi_report(wh.read(spark, "wide"), as_of)


@dataclass
class LiveJob:
    queries: list[StreamingQuery]

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    def await_all(self, poll_s: float = 1.0) -> None:
        """Wait until all have ended; if one fails, stop the others and raise."""
        while any(q.isActive for q in self.queries):
            for q in self.queries:
                if not q.isActive and q.exception() is not None:
                    self.stop()
                    raise q.exception()
            next(q for q in self.queries if q.isActive).awaitTermination(poll_s)
        for q in self.queries:
            if q.exception() is not None:
                raise q.exception()


def run_live(spark: SparkSession, case_messages: DataFrame, survey_messages: DataFrame,
             wh: Warehouse, checkpoint_root: str, out_path: str | None = None,
             publish_options: dict | None = None, trigger: dict | None = None,
             show: int = 0) -> LiveJob:
    """JOB-4: the live job over two message streams, as one query.

    Each batch is decoded once and gives the landed cases, surveys and rejects,
    the KPIs of the enriched cases, and the cases joined to the surveys of the
    same batch, published as JSON (to files at ``out_path`` or, with
    ``publish_options``, to a topic).  Only the two tables of the priority
    lookup are read besides; when JOB-2 replaces one of them, the next batch sees it.
    """
    lookup = following_priority(spark, wh)
    sinks = wh.landing()
    sinks.published, sinks.publish_options = out_path, publish_options
    return LiveJob([start_live(case_messages, survey_messages, sinks, lookup,
                               f"{checkpoint_root.rstrip('/')}/live", trigger, show)])


def following_priority(spark: SparkSession, wh: Warehouse) -> FollowingLookup:
    """The priority lookup of a warehouse, loaded again when one of its tables is replaced."""
    tables = {"case_category": schemas.CASE_CATEGORY, "case_priority": schemas.CASE_PRIORITY}

    def load() -> DataFrame:
        category, priority = (conform(wh.read(spark, k), s, strict=False) for k, s in tables.items())
        return priority_lookup(category, priority, how="inner")

    return FollowingLookup(lambda: wh.version(spark, *tables), load)


def forward_files_job(spark: SparkSession, directory: str, archive_dir: str, checkpoint: str,
                      fmt: str = "text", path: str | None = None, options: dict | None = None,
                      trigger: dict | None = None, max_files: int = MAX_FILES) -> StreamingQuery:
    """JOB-10: every line of every new file, forwarded once."""
    return forward_files(stream_files(spark, directory, archive_dir, max_files), checkpoint,
                         fmt=fmt, path=path, options=options, trigger=trigger)


def stored_kpis(spark: SparkSession, wh: Warehouse, as_of) -> DataFrame:
    """JOB-6 .. JOB-9 in sequence over what is already in the warehouse."""
    merge_history(spark, wh, as_of)
    build_fact_job(spark, wh, as_of)
    build_wide_job(spark, wh)
    return kpi_job(spark, wh, as_of)


__all__ = ["Warehouse", "reference_frame", "load_reference_tables", "load_dimensions", "load_history",
           "refresh_dimension", "refresh_history", "build_increment", "merge_history", "build_fact_job", "build_wide_job", "kpi_job",
           "run_live", "forward_files_job", "stored_kpis", "warehouse_dims"]
