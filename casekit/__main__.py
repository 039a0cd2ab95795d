"""Command line for the pipeline jobs (run through ``spark-submit``).

    spark-submit --py-files casekit.zip casekit/__main__.py <job> --warehouse <root> ...
    python -m casekit <job> --warehouse <root> ...        (local / preconfigured session)

jobs: load-reference, load-dimensions, load-history, build-increment, merge-history,
      merge-increment, build-fact, build-wide, kpi, compact-landing, vacuum, forward-files, run-live

The session (master, executors, ``spark.checkpoint.dir``) comes from
``spark-submit``; nothing here fixes cluster settings.
"""

from __future__ import annotations

import argparse
import hashlib
import sys

from pyspark.sql import SparkSession

from casekit.operators.kpi import show_kpis
from casekit.plans import incremental, jobs
from casekit.session import checkpoint_root
from casekit.sources.landing import compact_landing
from casekit.streaming.sources import MAX_FILES, MAX_OFFSETS, stream_messages


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="casekit", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=["load-reference", "load-dimensions", "load-history",
                                   "build-increment", "merge-history", "merge-increment",
                                   "build-fact", "build-wide", "kpi", "compact-landing", "vacuum",
                                   "forward-files", "run-live"])
    p.add_argument("--warehouse", required=True, help="root folder of the warehouse tables")
    p.add_argument("--catalog", help="database of the warehouse tables (default: folders)")
    p.add_argument("--table-format", default="parquet", help="format of the warehouse tables")
    p.add_argument("--jdbc-url", help="load-*: database")
    p.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE",
                   help="load-*: connection property (repeat)")
    p.add_argument("--reference-dir", help="load-reference: folder with one <table>.* per table")
    p.add_argument("--reference-suffix", default="", help="load-reference: file suffix")
    p.add_argument("--max-files", type=int, default=MAX_FILES,
                   help="streams: files of one micro-batch at most")
    p.add_argument("--max-offsets", type=int, default=MAX_OFFSETS,
                   help="streams: broker messages of one micro-batch at most")
    p.add_argument("--kpi-rows", type=int, default=1000, help="kpi: rows to print")
    p.add_argument("--kpi-out", help="kpi: also write the report to this folder")
    p.add_argument("--as-of", default=None, help="load stamp / KPI end time (default: now)")
    p.add_argument("--landing-cases", help="build-/merge-increment, compact-landing: case landing table")
    p.add_argument("--landing-surveys", help="build-/merge-increment, compact-landing: survey landing table")
    p.add_argument("--source-dir", help="forward-files: watched directory")
    p.add_argument("--archive-dir", help="forward-files: where finished files go")
    p.add_argument("--out", help="forward-files / run-live: output folder (text sink)")
    p.add_argument("--format", default="text", help="run-live: message source (kafka|text)")
    p.add_argument("--cases", help="run-live: case topic(s) or directory")
    p.add_argument("--surveys", help="run-live: survey topic(s) or directory")
    p.add_argument("--bootstrap", help="run-live: kafka.bootstrap.servers")
    p.add_argument("--publish-topic", help="run-live / forward-files: topic to send to")
    p.add_argument("--trigger", default="15 seconds", help="processing-time trigger")
    p.add_argument("--checkpoint", help="streams: checkpoint folder (default: under "
                   "spark.checkpoint.dir, one per warehouse / source folder)")
    p.add_argument("--show", type=int, default=0, metavar="ROWS",
                   help="run-live: print so many KPI rows per batch")
    p.add_argument("--once", action="store_true",
                   help="streams: process what is available, then stop (catch-up run)")
    return p


def _checkpoint(spark: SparkSession, args, job: str, scope: str) -> str:
    """The stream's checkpoint: given, or one stable folder per job and scope, so
    a restart resumes its own progress and nothing else's."""
    if args.checkpoint:
        return args.checkpoint
    tag = hashlib.sha256(scope.rstrip("/").encode()).hexdigest()
    return f"{checkpoint_root(spark)}/casekit/{job}/{tag}"


def _messages(spark: SparkSession, args, what: str):
    if args.format == "kafka":
        return stream_messages(spark, "kafka", max_offsets=args.max_offsets, options={
            "kafka.bootstrap.servers": args.bootstrap, "subscribe": what})
    return stream_messages(spark, "text", path=what, max_files=args.max_files)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"casekit-{args.job}").getOrCreate()
    wh = jobs.Warehouse(args.warehouse, catalog=args.catalog, fmt=args.table_format)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    properties = dict(x.split("=", 1) for x in args.jdbc_property)
    topic = ({"kafka.bootstrap.servers": args.bootstrap, "topic": args.publish_topic}
             if args.publish_topic else None)
    if args.job == "load-reference":
        jobs.load_reference_tables(spark, {
            k: f"{args.reference_dir.rstrip('/')}/{k}{args.reference_suffix}"
            for k in jobs.REFERENCE_FILES}, args.jdbc_url, properties, wh.names)
    elif args.job == "load-dimensions":
        jobs.load_dimensions(spark, args.jdbc_url, properties, wh, args.as_of)
    elif args.job == "load-history":
        jobs.load_history(spark, args.jdbc_url, properties, wh, args.as_of)
    elif args.job == "build-increment":
        landed = wh.landing()
        jobs.build_increment(spark, args.landing_cases or landed.cases,
                             args.landing_surveys or landed.surveys, wh, args.as_of)
    elif args.job == "merge-increment":
        incremental.merge_increment(spark, wh, args.as_of, args.landing_cases, args.landing_surveys)
    elif args.job == "compact-landing":
        for path in (args.landing_cases or wh.landing().cases,
                     args.landing_surveys or wh.landing().surveys):
            compact_landing(spark, path)
    elif args.job == "vacuum":
        wh.vacuum(spark)
    elif args.job == "merge-history":
        jobs.merge_history(spark, wh, args.as_of)
    elif args.job == "build-fact":
        jobs.build_fact_job(spark, wh, args.as_of)
    elif args.job == "build-wide":
        jobs.build_wide_job(spark, wh)
    elif args.job == "kpi":
        report = jobs.kpi_job(spark, wh, args.as_of)
        if args.kpi_out:
            report.coalesce(1).write.mode("overwrite").parquet(args.kpi_out)
        show_kpis(report, args.kpi_rows)
    elif args.job == "forward-files":
        ck = _checkpoint(spark, args, "forward-files", args.source_dir)
        jobs.forward_files_job(spark, args.source_dir, args.archive_dir, ck,
                               fmt="kafka" if topic else "text",
                               path=None if topic else args.out, options=topic, trigger=trigger,
                               max_files=args.max_files).awaitTermination()
    elif args.job == "run-live":
        jobs.run_live(spark, _messages(spark, args, args.cases),
                      _messages(spark, args, args.surveys), wh,
                      _checkpoint(spark, args, "live", args.warehouse), out_path=args.out,
                      publish_options=topic, trigger=trigger, show=args.show).await_all()
    return 0


if __name__ == "__main__":
    sys.exit(main())
