"""The stored pipeline (tables in a warehouse folder) equals the in-memory one."""

import datetime as dt

from pyspark.sql import functions as F

from casekit import schemas
from casekit.functions import with_event_date, with_load_stamp
from casekit.operators import kpi_report
from casekit.plans.fact import WideDims, build_fact, build_wide
from casekit.plans.jobs import (Warehouse, build_increment, kpi_job, run_live, stored_kpis)
from casekit.sources import driver_views as dv
from casekit.sources.tables import refresh_staging, write_table
from casekit.functions.jsonio import encode_arrays, text_fields
from casekit.streaming.sources import stream_messages

SF = "/root/testdata/sf0.001"
AS_OF = dv.AS_OF
# A small fixture: cases created in one quarter keep the file count low.
LO, HI = dt.datetime(1996, 1, 1), dt.datetime(1996, 4, 1)


def _in_quarter(df, col):
    return df.where((F.col(col) >= F.lit(LO)) & (F.col(col) < F.lit(HI)))


def test_stored_pipeline_matches_in_memory(spark, tmp_dir):
    wh = Warehouse(f"{tmp_dir}/wh")
    cases = _in_quarter(dv.cases(spark, SF), "create_timestamp")
    hist = cases.where(F.col("last_modified_timestamp") < F.lit(dt.datetime(1996, 6, 1)))
    incr = cases.where(F.col("last_modified_timestamp") >= F.lit(dt.datetime(1996, 5, 1)))
    surveys = dv.surveys(spark, SF).where(F.col("case_no").isin(
        [r.case_no for r in cases.select("case_no").distinct().collect()]))
    s_hist = surveys.where(F.col("survey_timestamp") < F.lit(dt.datetime(2024, 1, 20)))
    # staging as the history import leaves it: text columns, date partition
    refresh_staging(with_event_date(text_fields(hist), "create_timestamp", "create_date"),
                    wh.path("case_stg"), ["create_date"])
    refresh_staging(with_event_date(text_fields(s_hist, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                                    "survey_timestamp", "survey_date"),
                    wh.path("survey_stg"), ["survey_date"])
    # landing as the live job leaves it
    write_table(incr, f"{tmp_dir}/land_cases")
    write_table(surveys, f"{tmp_dir}/land_surveys")
    build_increment(spark, f"{tmp_dir}/land_cases", f"{tmp_dir}/land_surveys", wh, AS_OF)
    dims = {"calendar": dv.calendar(spark, SF), "call_center": dv.call_center(spark, SF),
            "case_category": dv.case_category(spark), "case_priority": dv.case_priority(spark),
            "employee": dv.employee(spark, SF), "product": dv.product(spark, SF),
            "questions": dv.survey_questions(spark)}
    for k, df in dims.items():
        write_table(with_load_stamp(df, AS_OF), wh.path(k))
    got = {r.kpi: r.value for r in stored_kpis(spark, wh, AS_OF).collect()}

    wide = build_wide(build_fact(cases, surveys, AS_OF), WideDims(
        dims["calendar"], dims["call_center"], dims["case_category"], dims["case_priority"],
        dims["employee"], dims["product"], dims["questions"]))
    want = {r.kpi: r.value for r in kpi_report(wide, AS_OF).collect()}
    assert got == want and got["Total_Numbers_of_Cases"] > 0
    # the stored wide keeps one row per case and reads pruned columns for KPIs
    plan = kpi_job(spark, wh, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "email" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_run_live_smoke(spark, tmp_dir):
    wh = Warehouse(f"{tmp_dir}/wh")
    for k, df in {"calendar": dv.calendar(spark, SF), "call_center": dv.call_center(spark, SF),
                  "case_category": dv.case_category(spark),
                  "case_priority": dv.case_priority(spark), "employee": dv.employee(spark, SF),
                  "product": dv.product(spark, SF),
                  "questions": dv.survey_questions(spark)}.items():
        write_table(df, wh.path(k))
    cases = _in_quarter(dv.cases(spark, SF), "create_timestamp")
    encode_arrays(text_fields(cases), 20).write.text(f"{tmp_dir}/cin")
    encode_arrays(text_fields(dv.surveys(spark, SF), "yyyy-MM-dd HH:mm:ss.SSSSSS"), 20) \
        .write.text(f"{tmp_dir}/sin")
    job = run_live(spark, stream_messages(spark, "text", f"{tmp_dir}/cin"),
                   stream_messages(spark, "text", f"{tmp_dir}/sin"), wh, f"{tmp_dir}/ck",
                   out_path=f"{tmp_dir}/joined", trigger={"availableNow": True})
    job.await_all()
    landed = spark.read.parquet(wh.landing().cases)
    assert landed.count() == cases.count()
    landed = landed.drop("batch_id")
    status = spark.read.parquet(wh.landing().status)
    assert status.where("Case_Type = 'Total Cases'").first().Cases_numbers == \
        cases.select("case_no").distinct().count()
    assert schemas.CASE.fieldNames() == landed.columns
    from casekit.sources.tables import read_landing
    typed = read_landing(spark, wh.landing().cases, schemas.CASE)
    assert typed.columns == schemas.CASE.fieldNames()
    assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, cases.collect()))


def test_cli_kpi_over_stored_wide(spark, tmp_dir, capsys):
    from casekit.__main__ import main
    wh = Warehouse(f"{tmp_dir}/wh")
    wide = build_wide(build_fact(dv.cases(spark, SF), dv.surveys(spark, SF), AS_OF), WideDims(
        dv.calendar(spark, SF), dv.call_center(spark, SF), dv.case_category(spark),
        dv.case_priority(spark), dv.employee(spark, SF), dv.product(spark, SF),
        dv.survey_questions(spark)))
    write_table(wide, wh.path("wide"))
    assert main(["kpi", "--warehouse", wh.root, "--as-of", str(AS_OF)]) == 0
    out = capsys.readouterr().out
    assert "Total_Numbers_of_Cases" in out and "Total_Surveys_Last_1Month" in out


def test_cli_run_live_once(spark, tmp_dir):
    from casekit.__main__ import main
    wh = Warehouse(f"{tmp_dir}/wh")
    for k, df in {"calendar": dv.calendar(spark, SF), "call_center": dv.call_center(spark, SF),
                  "case_category": dv.case_category(spark),
                  "case_priority": dv.case_priority(spark), "employee": dv.employee(spark, SF),
                  "product": dv.product(spark, SF),
                  "questions": dv.survey_questions(spark)}.items():
        write_table(df, wh.path(k))
    cases = _in_quarter(dv.cases(spark, SF), "create_timestamp")
    encode_arrays(text_fields(cases), 20).write.text(f"{tmp_dir}/cin")
    encode_arrays(text_fields(dv.surveys(spark, SF), "yyyy-MM-dd HH:mm:ss.SSSSSS"), 20) \
        .write.text(f"{tmp_dir}/sin")
    assert main(["run-live", "--warehouse", wh.root, "--format", "text",
                 "--cases", f"{tmp_dir}/cin", "--surveys", f"{tmp_dir}/sin",
                 "--out", f"{tmp_dir}/joined", "--once"]) == 0
    assert spark.read.parquet(wh.landing().cases).count() == cases.count()
    assert spark.read.parquet(wh.landing().surveys).count() == \
        dv.surveys(spark, SF).count()


def test_dimension_refresh_replaces_and_wide_builds(spark, tmp_dir):
    """Two daily loads, also where the session overwrites partitions dynamically."""
    from casekit.plans.jobs import refresh_dimension, warehouse_dims
    mode = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(mode)
    dims = {"calendar": dv.calendar(spark, SF), "call_center": dv.call_center(spark, SF),
            "case_category": dv.case_category(spark), "case_priority": dv.case_priority(spark),
            "employee": dv.employee(spark, SF), "product": dv.product(spark, SF),
            "questions": dv.survey_questions(spark)}
    try:
        for setting in ("dynamic", "static"):
            spark.conf.set(mode, setting)
            wh = Warehouse(f"{tmp_dir}/{setting}")
            for day in ("2001-11-03", "2001-11-04"):
                for key, frame in dims.items():
                    refresh_dimension(frame, wh, key, f"{day} 00:00:00")
            assert wh.read(spark, "case_priority").count() == 3
            fact = build_fact(dv.cases(spark, SF), dv.surveys(spark, SF), AS_OF)
            wide = build_wide(fact, warehouse_dims(spark, wh))
            assert wide.count() == fact.count()
            wide.collect()
    finally:
        spark.conf.set(mode, old)


def test_needed_columns_decide_which_dimensions_are_read(spark):
    dims = WideDims(dv.calendar(spark, SF), dv.call_center(spark, SF), dv.case_category(spark),
                    dv.case_priority(spark), dv.employee(spark, SF), dv.product(spark, SF),
                    dv.survey_questions(spark))
    fact = build_fact(dv.cases(spark, SF), dv.surveys(spark, SF), AS_OF)
    full = build_wide(fact, dims)
    some = ["case_no", "priority", "overall_feedback", "case_create_date_desc"]
    part = build_wide(fact, dims, columns=some)
    assert sorted(map(tuple, part.collect()), key=str) == sorted(map(tuple, full.select(*some).collect()), key=str)
    jobs_before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    build_wide(fact, dims, columns=["case_no", "status"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs_before


def test_a_failed_query_stops_the_live_job(spark, tmp_dir):
    import pytest
    from casekit.plans.jobs import LiveJob

    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")
    spark.createDataFrame([("a",)], "value string").write.text(f"{tmp_dir}/in")
    source = stream_messages(spark, "text", f"{tmp_dir}/in")
    good = (source.writeStream.format("noop").option("checkpointLocation", f"{tmp_dir}/g").start())
    bad = (source.writeStream.foreachBatch(fail).option("checkpointLocation", f"{tmp_dir}/b").start())
    with pytest.raises(Exception, match="sink is gone"):
        LiveJob([good, bad]).await_all()
    assert not good.isActive and not bad.isActive


def test_checkpoints_of_alike_names_differ(spark):
    import argparse
    from casekit.__main__ import _checkpoint
    args = argparse.Namespace(checkpoint=None)
    names = ["/a/b-c", "/a/b/c", "/a/b_c", "/x" * 100 + "/1", "/y" * 100 + "/1"]
    assert len({_checkpoint(spark, args, "live", n) for n in names}) == len(names)


def test_fact_job_leaves_no_stale_partition(spark, tmp_dir):
    from casekit.plans.jobs import build_fact_job
    wh = Warehouse(f"{tmp_dir}/wh")
    cases = _in_quarter(dv.cases(spark, SF), "create_timestamp")
    write_table(dv.surveys(spark, SF), wh.path("survey_dly"))
    for days in (9, 0):
        moved = cases.withColumn("create_timestamp", F.col("create_timestamp")
                                 - F.expr(f"INTERVAL {days} DAY"))
        write_table(moved, wh.path("case_dly"))
        build_fact_job(spark, wh, AS_OF)
    fact = wh.read(spark, "fact")
    assert fact.count() == fact.select("case_no").distinct().count() == \
        cases.select("case_no").distinct().count()
