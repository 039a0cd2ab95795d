"""

Every query reads the benchmark tables under ``sf_dir`` (mapped onto the
case/survey model by ``casekit.sources.driver_views``) and runs over whole
tables.  ``oracle_sql`` gives an independent DuckDB formulation for each.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_views as ov  # noqa: E402
from casekit import schemas  # noqa: E402
from casekit.config import BANDS, KPI_WINDOWS, QUESTION_FEEDBACK  # noqa: E402
from casekit.functions import (conform, conform_checked, hours_between, in_last,  # noqa: E402
                               parse_range, score_label, split_rejects, with_event_date,
                               with_load_stamp)
from casekit.operators import (DimSpec, enrich, kpi_counts, kpi_feedback,  # noqa: E402
                               kpi_report, live_priority_counts, live_status_counts,
                               merge_distinct, priority_lookup, regional_lookup,
                               score_answers, score_bands)
from casekit.operators.kpi import KPI_COLUMNS, kpi_name  # noqa: E402
from casekit.plans.fact import (WideDims, build_fact, build_wide, latest_cases,  # noqa: E402
                                latest_surveys, score_feedback, wide_dim_specs)
from casekit.functions.jsonio import (decode_json, encode_arrays, encode_rows,  # noqa: E402
                                      pack_arrays, text_fields)
from casekit.plans.incremental import (fact_from_latest, merge_increment,  # noqa: E402
                                       update_latest_tables)
from casekit.plans.jobs import (Warehouse, build_increment, following_priority,  # noqa: E402
                                merge_history, refresh_dimension, refresh_history, stored_kpis)
from casekit.session import scratch_path  # noqa: E402
from casekit.sources.landing import compact_landing, read_landed  # noqa: E402
from casekit.sources import driver_views as dv  # noqa: E402
from casekit.sources.delimited import read_delimited, write_delimited  # noqa: E402
from casekit.sources.tables import (overwrite_partitions, read_landing,  # noqa: E402
                                    rebuild_table, write_table)
from casekit.streaming import (LiveSinks, count_first_seen, counted_kinds,  # noqa: E402
                               cumulative_counts, decode_cases, decode_surveys, dedup_stream,
                               enrich_stream, forward_files, join_streams, land_newest,
                               land_stream, merged_sketches, newest_landed, priority_kinds,
                               publish_json, published_rows, rocksdb_state, sketch_counts, start_live,
                               stream_files, stream_messages)
from casekit.streaming.join import FILE_OPTIONS  # noqa: E402
from casekit.streaming.live import replace_batch  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = dv.AS_OF


# ----------------------------------------------------------------- helpers

def _fact(spark, d):
    return build_fact(dv.cases(spark, d), dv.surveys(spark, d), as_of=AS_OF)


def _dims(spark, d):
    return WideDims(dv.calendar(spark, d), dv.call_center(spark, d), dv.case_category(spark),
                    dv.case_priority(spark), dv.employee(spark, d), dv.product(spark, d),
                    dv.survey_questions(spark))


def _wide(spark, d, columns=None):
    return build_wide(_fact(spark, d), _dims(spark, d), columns=columns)


def _round_hours(df):
    return df.withColumn("hours_to_close", F.round("hours_to_close", 6))


# ----------------------------------------------------------------- queries

def q_conform_cast(spark, d):
    """All cases as text, as a history extract holds them, conformed to the typed schema."""
    return conform(text_fields(dv.cases(spark, d)), schemas.CASE)


def q_event_date(spark, d):
    return with_event_date(text_fields(dv.cases(spark, d)), "create_timestamp",
                           "create_date").select(
        "case_no", "create_timestamp", "last_modified_timestamp", "create_date")


def q_load_stamp_fixed(spark, d):
    return with_load_stamp(dv.cases(spark, d).select("case_no", "status",
                                                     "last_modified_timestamp"),
                           as_of=AS_OF, date_col="load_date")


def q_load_stamp_now(spark, d):
    """Without ``as_of`` every row carries the query's own time, in whole seconds."""
    rows = with_load_stamp(dv.cases(spark, d).select("case_no", "status"), date_col="load_date")
    now = F.date_trunc("second", F.localtimestamp())
    return rows.select("case_no", "status", (F.col("row_insertion_dttm") == now).alias("is_now"),
                       (F.col("load_date") == F.to_date(now)).alias("is_today"))


def q_answers_lenient(spark, d):
    """Survey answers as text, some with a zero and some with a real fraction: only
    whole numbers count."""
    s = text_fields(dv.surveys(spark, d), SURVEY_TS)
    k = F.col("survey_id").cast("long") % 7
    return conform(s.withColumn("Q1", F.when(k == 0, F.concat("Q1", F.lit(".5")))
                                .when(k == 1, F.concat("Q1", F.lit(".0")))
                                .when(k == 2, F.lit("n/a")).otherwise(F.col("Q1"))),
                   schemas.SURVEY)


def q_filter_status(spark, d):
    return _fact(spark, d).where(F.col("status") == "Open").select(
        "case_no", "status", "last_modified_timestamp")


def q_filter_in_priority(spark, d):
    return _wide(spark, d).where(F.col("priority").isin("High", "Highest")).select(
        "case_no", "priority", "severity")


def q_filter_last_window(spark, d):
    return _fact(spark, d).where(in_last("last_modified_timestamp", "7 DAY", AS_OF)).select(
        "case_no", "status", "last_modified_timestamp")


def q_filter_not_neutral(spark, d):
    return _wide(spark, d).where(F.col("overall_feedback").isNotNull()
                                 & (F.col("overall_feedback") != "Neutral")).select(
        "case_no", "overall_feedback")


def q_merge_cases(spark, d):
    return merge_distinct([dv.case_history(spark, d), dv.case_increment(spark, d)],
                          schemas.CASE_DLY_MERGE, as_of=AS_OF)


def q_merge_surveys(spark, d):
    return merge_distinct([dv.survey_history(spark, d), dv.survey_increment(spark, d)],
                          schemas.SURVEY_DLY_MERGE, as_of=AS_OF)


def q_latest_case(spark, d):
    return latest_cases(dv.cases(spark, d))


def q_latest_survey(spark, d):
    return latest_surveys(dv.surveys(spark, d))


def q_fact_case_survey(spark, d):
    return _fact(spark, d)


def q_fact_from_merged(spark, d):
    """The whole batch path: merge history and increments, then build the fact."""
    cases = merge_distinct([dv.case_history(spark, d), dv.case_increment(spark, d)],
                           schemas.CASE_DLY_MERGE, as_of=AS_OF)
    surveys = merge_distinct([dv.survey_history(spark, d), dv.survey_increment(spark, d)],
                             schemas.SURVEY_DLY_MERGE, as_of=AS_OF)
    return build_fact(cases, surveys, as_of=AS_OF)


def _cases_with_priority(spark, d, how):
    lookup = priority_lookup(dv.case_category(spark), dv.case_priority(spark), how=how)
    spec = DimSpec(lookup, left=["category", "sub_category"],
                   right=["category_key", "sub_category_key"],
                   columns=["Priority_key", "priority", "severity"], name="case_priority")
    return enrich(dv.cases(spark, d).select("case_no", "status", "category", "sub_category",
                                            "last_modified_timestamp"), [spec])


def q_priority_inner(spark, d):
    """Live-path lookup: category ⋈ priority (inner), every case kept."""
    return _cases_with_priority(spark, d, "inner")


def q_priority_left(spark, d):
    """Batch-path lookup: category ⟕ priority, every case kept."""
    return _cases_with_priority(spark, d, "left")


def q_enrich_calendar(spark, d):
    specs = wide_dim_specs(_dims(spark, d))
    return enrich(_fact(spark, d).select("case_no", "create_timestamp"), specs[:1])


def q_enrich_center_employee_product(spark, d):
    specs = wide_dim_specs(_dims(spark, d))
    f = _fact(spark, d).select("case_no", "call_center_id", "created_employee_key",
                               "product_code")
    return enrich(f, [specs[1], specs[3], specs[4]])


def q_enrich_category(spark, d):
    specs = wide_dim_specs(_dims(spark, d))
    return enrich(_fact(spark, d).select("case_no", "category", "sub_category"), [specs[2]])


def q_bands_score(spark, d):
    s = dv.surveys(spark, d).select("survey_id", "Q1", "Q2", "Q3", "Q5")
    return score_bands(s, dv.survey_questions(spark))


def q_feedback_labels(spark, d):
    s = dv.surveys(spark, d).select("survey_id", "Q1", "Q2", "Q3", "Q5")
    scored = score_bands(s, dv.survey_questions(spark))
    return scored.select("survey_id", *[score_label(c).alias(c) for c in
                                        schemas.FEEDBACK_COLUMNS[:4]])


def q_feedback_overall(spark, d):
    s = dv.surveys(spark, d).select("survey_id", "Q1", "Q2", "Q3", "Q5")
    return score_feedback(s, dv.survey_questions(spark)).select("survey_id", "overall_feedback")


def q_hours_to_close(spark, d):
    f = _fact(spark, d)
    return f.select("case_no", "status", F.round(F.when(
        F.col("status") == "Closed",
        hours_between("create_timestamp", "last_modified_timestamp")), 6).alias("hours_to_close"))


def q_wide_case_survey(spark, d):
    return _round_hours(_wide(spark, d))


def _kpis(spark, d, names, *columns):
    """KPIs over the wide table, built with the columns they read and no others."""
    wide = _wide(spark, d, ["case_no", "last_modified_timestamp", *columns])
    return kpi_counts(wide, AS_OF, names=names)


def q_kpi_total(spark, d):
    return _kpis(spark, d, ["Total_Numbers_of_Cases"])


def q_kpi_open(spark, d):
    return _kpis(spark, d, [kpi_name("open", w.label) for w in KPI_WINDOWS], "status")


def q_kpi_closed(spark, d):
    return _kpis(spark, d, [kpi_name("closed", w.label) for w in KPI_WINDOWS], "status")


def q_kpi_p1(spark, d):
    return _kpis(spark, d, ["Total_Piority_1_Cases"], "Priority_key")


def q_kpi_high(spark, d):
    return _kpis(spark, d, ["Total_High_Piority_Cases"], "priority")


def q_kpi_surveys(spark, d):
    return _kpis(spark, d, [kpi_name("surveys", w.label) for w in KPI_WINDOWS],
                 "survey_timestamp")


def q_kpi_feedback(spark, d):
    return kpi_feedback(_wide(spark, d, ["case_no", "last_modified_timestamp",
                                         "overall_feedback"]), AS_OF)


def q_kpi_report(spark, d):
    return kpi_report(_wide(spark, d, KPI_COLUMNS), AS_OF)


def _live_batch(spark, d):
    return _cases_with_priority(spark, d, "inner")


def q_live_status_counts(spark, d):
    return live_status_counts(_live_batch(spark, d))


def q_live_priority_counts(spark, d):
    return live_priority_counts(_live_batch(spark, d))


# ------------------------------------------------ JSON, files and streams

SURVEY_TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ONCE = {"availableNow": True}


def _case_messages(spark, d):
    return encode_arrays(text_fields(dv.cases(spark, d)), 20)


def _survey_messages(frame):
    return encode_arrays(text_fields(frame, SURVEY_TS), 20)


#: Message files are compressed; a file that cannot be split stays within some 130 MB of text
#: (messages of 20 records).
MESSAGE_FILES = {"compression": "lz4", "maxRecordsPerFile": 20_000}
#: Those of a cut are smaller, so that one micro-batch gives every core the same work.
CUT_MESSAGES = 5_000
#: A cut is one micro-batch, however many files it has.
ALL_FILES = 2**31 - 1


def _write_text(frame, path, mode="overwrite", **more):
    frame.write.mode(mode).options(**{**MESSAGE_FILES, **more}).text(path)


def q_json_decode_explode(spark, d):
    return decode_cases(_case_messages(spark, d))


def q_json_publish_rows(spark, d):
    return decode_json(encode_rows(_fact(spark, d)), schemas.FACT)


def q_json_publish_array(spark, d):
    return decode_json(encode_arrays(_fact(spark, d), 20), schemas.FACT)


#: Every 40th case message record is cut short after this many characters.
CUT_EVERY, CUT_AT = 40, 40


def _damaged_messages(spark, d):
    """All cases as JSON arrays of 20, some records cut short."""
    rec = encode_rows(text_fields(dv.cases(spark, d)))
    cut = F.get_json_object("value", "$.case_no").cast("long") % CUT_EVERY == 0
    return pack_arrays(rec.select(F.when(cut, F.left("value", F.lit(CUT_AT))).otherwise(F.col("value"))
                                  .alias("value")), 20)


def q_json_decode_damaged(spark, d):
    """The good records of messages that hold damaged ones too."""
    return decode_json(_damaged_messages(spark, d), schemas.CASE, bad="quarantine")[0]


def q_json_rejects(spark, d):
    """The damaged records, as raw text."""
    return decode_json(_damaged_messages(spark, d), schemas.CASE,
                       bad="quarantine")[1].select("raw")


def q_csv_round_trip(spark, d):
    base = scratch_path(spark, "csv_round_trip")
    write_delimited(text_fields(dv.cases(spark, d)), f"{base}/cases")
    return read_delimited(spark, f"{base}/cases", schemas.CASE)


_FACT_BY_MONTH = schemas.struct(*[(f.name, f.dataType) for f in schemas.FACT.fields],
                                ("create_month", schemas.D))


def q_partition_overwrite(spark, d):
    """Write the fact partitioned by month, then replace the 1998 months only.

    (Monthly rather than daily partitions keep this small-data check from
    writing thousands of six-row files; the operator is the same.)
    """
    base = scratch_path(spark, "partition_overwrite")
    fact = _fact(spark, d).withColumn("create_month", F.trunc("create_date", "month"))
    write_table(fact, f"{base}/fact", ["create_month"])
    changed = (fact.where(F.year("create_date") == 1998)
               .withColumn("status", F.upper("status")))
    overwrite_partitions(changed, f"{base}/fact", _FACT_BY_MONTH, ["create_month"])
    return read_landing(spark, f"{base}/fact", _FACT_BY_MONTH)


def _reference_tsv(spark, d, key, frame):
    """JOB-1 without the database: a dimension as a delimited text file (all
    text, header, columns in another order), read back typed by name."""
    from casekit.plans.jobs import reference_frame
    base = scratch_path(spark, f"reference_{key}")
    cols = list(reversed(frame.columns))
    write_delimited(text_fields(frame.select(*cols)), f"{base}/{key}")
    return reference_frame(spark, key, f"{base}/{key}")


def q_reference_employee_tsv(spark, d):
    return _reference_tsv(spark, d, "employee", dv.employee(spark, d))


def q_reference_calendar_tsv(spark, d):
    return _reference_tsv(spark, d, "calendar", dv.calendar(spark, d))


def q_reference_call_center_tsv(spark, d):
    return _reference_tsv(spark, d, "call_center", dv.call_center(spark, d))


def q_reference_product_tsv(spark, d):
    return _reference_tsv(spark, d, "product", dv.product(spark, d))


def q_reference_country_tsv(spark, d):
    return _reference_tsv(spark, d, "country", dv.country(spark, d))


def q_reference_literals_tsv(spark, d):
    """The three small reference files, joined to the cases that use them."""
    cat = _reference_tsv(spark, d, "case_category", dv.case_category(spark))
    pri = _reference_tsv(spark, d, "case_priority", dv.case_priority(spark))
    questions = _reference_tsv(spark, d, "questions", dv.survey_questions(spark))
    cases = enrich_stream(dv.cases(spark, d), priority_lookup(cat, pri, how="inner"))
    scored = score_bands(dv.surveys(spark, d), questions).where(
        F.col("referral_feedback") == 1).select("case_no").distinct()
    return (cases.join(scored, "case_no", "left_semi").groupBy("priority", "severity")
            .agg(F.count(F.lit(1)).alias("cases")))


def q_reference_case_history_tsv(spark, d):
    return _reference_tsv(spark, d, "case_stg", text_fields(dv.cases(spark, d)))


def q_reference_survey_history_tsv(spark, d):
    return _reference_tsv(spark, d, "survey_stg", text_fields(dv.surveys(spark, d), SURVEY_TS))


# ------------------------------------------------------------- stored jobs

def _staged(spark, d, name, **options):
    """A warehouse with dimensions, history and increments as the loading jobs leave
    them."""
    wh = Warehouse(scratch_path(spark, name), **options)
    dims = {"calendar": dv.calendar(spark, d), "call_center": dv.call_center(spark, d),
            "case_category": dv.case_category(spark), "case_priority": dv.case_priority(spark),
            "employee": dv.employee(spark, d), "product": dv.product(spark, d),
            "questions": dv.survey_questions(spark)}
    for key, frame in dims.items():
        refresh_dimension(frame, wh, key, AS_OF)
    refresh_history(with_event_date(dv.case_history(spark, d), "create_timestamp",
                                    "create_date"), wh, "case_stg", AS_OF)
    refresh_history(with_event_date(dv.survey_history(spark, d), "survey_timestamp",
                                    "survey_date"), wh, "survey_stg", AS_OF)
    landed = wh.landing()
    write_table(dv.case_increment(spark, d), landed.cases)
    write_table(dv.survey_increment(spark, d), landed.surveys)
    build_increment(spark, landed.cases, landed.surveys, wh, AS_OF)
    return wh


def q_stored_pipeline_kpis(spark, d):
    """JOB-2, 3, 5 to 9 through written tables (folders, Parquet)."""
    wh = _staged(spark, d, "stored_pipeline", by_date=False)
    return stored_kpis(spark, wh, AS_OF)


def q_stored_pipeline_catalog(spark, d):
    """The same through ORC tables of a catalog database; the merged cases."""
    base = scratch_path(spark, "stored_catalog")
    db = "casekit_" + base.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{base}/{db}'")
    wh = Warehouse(base, catalog=db, fmt="orc", by_date=False)
    refresh_history(with_event_date(dv.case_history(spark, d), "create_timestamp",
                                    "create_date"), wh, "case_stg", AS_OF)
    refresh_history(with_event_date(dv.survey_history(spark, d), "survey_timestamp",
                                    "survey_date"), wh, "survey_stg", AS_OF)
    write_table(dv.case_increment(spark, d), wh.landing().cases)
    write_table(dv.survey_increment(spark, d), wh.landing().surveys)
    build_increment(spark, wh.landing().cases, wh.landing().surveys, wh, AS_OF)
    merge_history(spark, wh, AS_OF)
    return wh.read(spark, "case_dly")


def q_dimension_refresh(spark, d):
    """The product dimension loaded on two days, first with other brands.  Only the
    second load is there."""
    wh = Warehouse(scratch_path(spark, "dimension_refresh"))
    true = dv.product(spark, d)
    refresh_dimension(true.withColumn("brand", F.upper("brand")), wh, "product",
                      "2001-11-03 00:00:00")
    refresh_dimension(true, wh, "product", AS_OF)
    return wh.read(spark, "product")


def q_fact_rebuild(spark, d):
    """A fact built while half of the cases stood under another create date, then
    rebuilt: one row per case, no partition left over.  (By month, as above.)"""
    base = scratch_path(spark, "fact_rebuild")
    cases, surveys = dv.cases(spark, d), dv.surveys(spark, d)
    moved = F.col("case_no").cast("long") % 2 == 0
    earlier = cases.withColumn("create_timestamp", F.when(
        moved, F.col("create_timestamp") - F.expr("INTERVAL 400 DAY"))
        .otherwise(F.col("create_timestamp")))
    for version in (earlier, cases):
        fact = build_fact(version, surveys, AS_OF).withColumn(
            "create_month", F.trunc("create_date", "month"))
        rebuild_table(fact, f"{base}/fact", _FACT_BY_MONTH, ["create_month"])
    return read_landing(spark, f"{base}/fact", _FACT_BY_MONTH)


def q_incremental_merge(spark, d):
    """Merged cases from the history alone, then two landed batches merged one after the
    other (each run of the job takes what the ledger has not)."""
    wh = _history_only(spark, d, "incremental_merge")
    landed, cases, surveys = wh.landing(), dv.case_increment(spark, d), dv.survey_increment(spark, d)
    for b in (0, 1):
        replace_batch(cases.where(F.col("product_code").cast("long") % 2 == b), landed.cases, b)
        replace_batch(surveys.where(F.col("survey_id").cast("long") % 2 == b), landed.surveys, b)
        merge_increment(spark, wh, AS_OF)
    return wh.read(spark, "case_dly")


def _history_only(spark, d, name):
    """A warehouse whose merged tables hold the history and no increment."""
    wh = Warehouse(scratch_path(spark, name), by_date=False)
    refresh_history(with_event_date(dv.case_history(spark, d), "create_timestamp",
                                    "create_date"), wh, "case_stg", AS_OF)
    refresh_history(with_event_date(dv.survey_history(spark, d), "survey_timestamp",
                                    "survey_date"), wh, "survey_stg", AS_OF)
    merge_history(spark, wh, AS_OF, increments=False)
    return wh


def q_incremental_fact(spark, d):
    """The fact from bucketed latest-row tables, brought up to date three times: with the
    history and with two halves of the increment."""
    wh = Warehouse(scratch_path(spark, "incremental_fact"))
    cases, surveys = dv.case_increment(spark, d), dv.survey_increment(spark, d)
    update_latest_tables(spark, wh, dv.case_history(spark, d), dv.survey_history(spark, d), buckets=8)
    for b in (0, 1):
        update_latest_tables(spark, wh, cases.where(F.col("product_code").cast("long") % 2 == b),
                             surveys.where(F.col("survey_id").cast("long") % 2 == b))
    return fact_from_latest(spark, wh, AS_OF)


def _checked_surveys(spark, d):
    """Survey texts with planted values that are no numbers and no times."""
    s = text_fields(dv.surveys(spark, d), SURVEY_TS)
    k = F.col("survey_id").cast("long")
    return conform_checked(s.withColumn("Q1", F.when(k % 7 == 2, "n/a").otherwise(F.col("Q1")))
                           .withColumn("survey_timestamp", F.when(k % 11 == 3, "yesterday")
                                       .otherwise(F.col("survey_timestamp"))),
                           schemas.SURVEY)


def q_load_checked(spark, d):
    """The surveys whose values all convert."""
    return split_rejects(_checked_surveys(spark, d), "survey_id")[0]


def q_load_rejects(spark, d):
    """Every value that does not convert, with its column and raw text."""
    return split_rejects(_checked_surveys(spark, d), "survey_id")[1]


def q_bands_index(spark, d):
    """The four feedback scores by interval search over unpivoted answers."""
    parsed = dv.survey_questions(spark).select("question_id", *[
        parse_range(c).alias(c) for c, _ in BANDS])
    bands = parsed.select(F.col("question_id").alias("question"), F.explode(F.array(*[
        F.struct(F.col(c).getField("lo").alias("lo"), F.col(c).getField("hi").alias("hi"),
                 F.lit(score).alias("score"), F.lit(rank).alias("rank"))
        for rank, (c, score) in enumerate(BANDS)])).alias("b")).select("question", "b.*")
    s = dv.surveys(spark, d).select("survey_id", "Q1", "Q2", "Q3", "Q5")
    scored = score_answers(s.unpivot("survey_id", list(QUESTION_FEEDBACK), "question", "answer"), bands)
    back = scored.groupBy("survey_id").agg(
        *[F.max(F.when(F.col("question") == q, F.col("answer"))).alias(q) for q in QUESTION_FEEDBACK],
        *[F.max(F.when(F.col("question") == q, F.col("score"))).alias(out)
          for q, out in QUESTION_FEEDBACK.items()])
    return back


def q_bands_many(spark, d):
    """Line items scored by hundreds of overlapping bands a question, taken from the parts."""
    p = dv.table(spark, d, "part").select("p_partkey", "p_size")
    lo = F.col("p_partkey") * 37 % 9973
    bands = p.select((F.col("p_partkey") % 4).cast("string").alias("question"), lo.alias("lo"),
                     (lo + F.col("p_size")).alias("hi"),
                     (F.col("p_partkey") % 7 - 3).cast("int").alias("score"),
                     F.col("p_partkey").alias("rank"))
    answers = dv.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linenumber") % 5).cast("string").alias("question"),
        (F.col("l_partkey") * 101 % 10_007).alias("answer"))
    return score_answers(answers, bands)


def q_enrich_regional_calendar(spark, d):
    """Latest cases with the calendar of their region: EU has rows for some days only, and
    other cases fall back on the US calendar."""
    us = dv.calendar(spark, d)
    eu = us.where(F.dayofmonth("calendar_date") % 3 == 0).select(
        *[F.upper("month_name").alias(c) if c == "month_name" else
          F.lit("EU").alias(c) if c == "geo_region_cd" else F.col(c) for c in us.columns])
    cases = _fact(spark, d).select("case_no", "create_timestamp", F.expr(
        "CASE call_center_id % 3 WHEN 0 THEN 'EU' WHEN 1 THEN 'APAC' END").alias("region"))
    return regional_lookup(cases, us.unionByName(eu), F.col("create_timestamp").cast("date"), "region",
                           "calendar_date", "geo_region_cd", ["date_desc", "month_name"], "US",
                           prefix="case_create_")


# ----------------------------------------------------------------- streams

CUTS = 3


def _append_messages(frame, path, ts_format="yyyy-MM-dd HH:mm:ss"):
    """Records as JSON arrays, in files of at most ``CUT_MESSAGES``."""
    _write_text(encode_arrays(text_fields(frame, ts_format), 20), path, "append", maxRecordsPerFile=CUT_MESSAGES)


def _cuts(frame, key, path, ts_format="yyyy-MM-dd HH:mm:ss"):
    """For each cut b a function that writes the records whose key leaves remainder b."""
    return [lambda b=b: _append_messages(frame.where(F.col(key).cast("long") % CUTS == b), path, ts_format)
            for b in range(CUTS)]


def _run_in_cuts(cuts, start):
    """One micro-batch a cut: its files arrive, and the query, resumed from its checkpoint,
    reads them all."""
    for writes in cuts:
        for write in writes if isinstance(writes, (tuple, list)) else [writes]:
            write()
        start().awaitTermination()


def _case_stream(spark, d, base, key="case_no"):
    """The case messages as a stream, and the cuts that feed it."""
    cuts = _cuts(dv.cases(spark, d), key, f"{base}/in")
    _touch(spark, f"{base}/in")
    return stream_messages(spark, "text", f"{base}/in", max_files=ALL_FILES), cuts


def _survey_stream(spark, d, base):
    cuts = _cuts(dv.surveys(spark, d), "survey_id", f"{base}/surveys", SURVEY_TS)
    _touch(spark, f"{base}/surveys")
    return stream_messages(spark, "text", f"{base}/surveys", max_files=ALL_FILES), cuts


def _touch(spark, path):
    """A watched folder must be there before its stream is defined."""
    _write_text(spark.createDataFrame([], "value string"), path)


def q_stream_land_cases(spark, d):
    base = scratch_path(spark, "stream_land_cases")
    messages, cuts = _case_stream(spark, d, base)
    _run_in_cuts(cuts, lambda: land_stream(decode_cases(messages), f"{base}/landing", f"{base}/ckpt",
                                           trigger=ONCE))
    return read_landing(spark, f"{base}/landing", schemas.CASE)


def q_stream_timed_trigger(spark, d):
    """One query on a processing-time trigger while the files arrive, stopped, and started
    again from its checkpoint, which adds nothing."""
    base = scratch_path(spark, "stream_timed_trigger")
    messages, cuts = _case_stream(spark, d, base)

    def start(**trigger):
        return land_stream(decode_cases(messages), f"{base}/landing", f"{base}/ckpt", trigger=trigger)

    query = start(processingTime="1 second")
    for write in cuts:
        write()
        query.processAllAvailable()
    query.stop()
    start(**ONCE).awaitTermination()
    return read_landing(spark, f"{base}/landing", schemas.CASE)


def _lookup(spark):
    return priority_lookup(dv.case_category(spark), dv.case_priority(spark), how="inner")


_ENRICHED = ("case_no", "status", "category", "sub_category", "last_modified_timestamp",
             "Priority_key", "priority", "severity")


def q_stream_enrich(spark, d):
    base = scratch_path(spark, "stream_enrich")
    messages, cuts = _case_stream(spark, d, base)
    out = enrich_stream(decode_cases(messages), _lookup(spark)).select(*_ENRICHED)
    _run_in_cuts(cuts, lambda: land_stream(out, f"{base}/landing", f"{base}/ckpt", trigger=ONCE))
    return spark.read.parquet(f"{base}/landing")


def q_stream_lookup_change(spark, d):
    """Three batches; the priority table is replaced after the first, and the later batches
    see the new one.  The lookup is loaded twice, not once a batch."""
    base = scratch_path(spark, "stream_lookup_change")
    wh = Warehouse(base)
    refresh_dimension(dv.case_category(spark), wh, "case_category", AS_OF)
    refresh_dimension(dv.case_priority(spark), wh, "case_priority", AS_OF)
    lookup = following_priority(spark, wh)
    messages, cuts = _case_stream(spark, d, base)

    def change():
        refresh_dimension(dv.case_priority(spark).withColumn("severity", F.upper("severity")),
                          wh, "case_priority", AS_OF)

    def handle(batch, batch_id):
        replace_batch(lookup(decode_cases(batch)).select(*_ENRICHED), f"{base}/landing", batch_id)

    _run_in_cuts([cuts[0], (change, cuts[1]), cuts[2]], lambda: (
        messages.writeStream.foreachBatch(handle).option("checkpointLocation", f"{base}/ckpt")
        .trigger(**ONCE).start()))
    if lookup.loads != 2:
        raise RuntimeError(f"the lookup was loaded {lookup.loads} times, not twice")
    return spark.read.parquet(f"{base}/landing").withColumn("batch_id", F.col("batch_id").cast("long"))


def _live(spark, d, name, damaged=False, arrange=zip):
    """The live job over both streams in three micro-batches; its output folders.
    ``arrange`` deals the cuts of both streams to the micro-batches."""
    base = scratch_path(spark, name)
    cases, case_cuts = _case_stream(spark, d, base)
    surveys, survey_cuts = _survey_stream(spark, d, base)
    cuts = list(arrange(case_cuts, survey_cuts))
    if damaged:
        cuts[0] += (lambda: _write_text(_damaged_messages(spark, d), f"{base}/in", "append"),)
    sinks = LiveSinks.under(f"{base}/out", published=f"{base}/published")
    _run_in_cuts(cuts, lambda: start_live(cases, surveys, sinks, _lookup(spark), f"{base}/ckpt",
                                          trigger=ONCE))
    return sinks


def q_stream_kpi_batches(spark, d):
    """Status counts of every micro-batch."""
    return spark.read.parquet(_live(spark, d, "stream_kpi").status).select(
        F.col("batch_id").cast("long"), "Case_Type", "Cases_numbers")


def q_stream_priority_batches(spark, d):
    """Priority counts of every micro-batch."""
    return spark.read.parquet(_live(spark, d, "stream_priority").priority).select(
        F.col("batch_id").cast("long"), "priority", "severity", "Cases_numbers")


def q_stream_batch_without_cases(spark, d):
    """Status counts where the second micro-batch holds surveys only: it adds no rows."""
    sinks = _live(spark, d, "stream_no_cases", arrange=lambda cases, surveys: [
        (cases[0], surveys[0]), (surveys[1],), (cases[1], cases[2], surveys[2])])
    return spark.read.parquet(sinks.status).select(
        F.col("batch_id").cast("long"), "Case_Type", "Cases_numbers")


def q_stream_fan_out_landing(spark, d):
    """The cases landed by the live job (one decode per batch)."""
    return read_landing(spark, _live(spark, d, "stream_fan_out").cases, schemas.CASE)


def q_landing_compaction(spark, d):
    """The cases landed by the live job in three batches, the first two compacted and their
    folders removed."""
    sinks = _live(spark, d, "landing_compaction")
    compact_landing(spark, sinks.cases, remove=True)
    return read_landed(spark, sinks.cases, schemas.CASE)


def q_stream_rejects(spark, d):
    """What the live job could not decode, landed with its raw text."""
    return spark.read.parquet(_live(spark, d, "stream_rejects", damaged=True).rejects).select(
        "kind", "raw")


def q_stream_join_batch(spark, d):
    """Cases joined to the surveys that arrive in the same micro-batch, published."""
    sinks = _live(spark, d, "stream_join")
    return decode_json(spark.read.text(sinks.published), schemas.CASE_SURVEY)


def q_stream_join_state(spark, d):
    """Cases joined to the surveys of any batch: in three batches, two thirds of the pairs
    meet across batches, through state."""
    base = scratch_path(spark, "stream_join_state")
    cases, case_cuts = _case_stream(spark, d, base)
    surveys, survey_cuts = _survey_stream(spark, d, base)
    out = join_streams(decode_cases(cases, keep=("ingest_ts",)), decode_surveys(surveys, keep=("ingest_ts",)),
                       within="30 days")
    with rocksdb_state(spark, idle_batches=False, lean=True):
        _run_in_cuts(zip(case_cuts, survey_cuts),
                     lambda: land_stream(out, f"{base}/landing", f"{base}/ckpt", trigger=ONCE))
    return read_landing(spark, f"{base}/landing", schemas.CASE_SURVEY)


def q_stream_cumulative_counts(spark, d):
    """Distinct cases in total, Open and Closed up to and with each of three batches; the
    versions of a case are spread over the batches."""
    base = scratch_path(spark, "stream_cumulative")
    messages, cuts = _case_stream(spark, d, base, key="product_code")
    kinds = counted_kinds(decode_cases(messages))
    with rocksdb_state(spark):
        _run_in_cuts(cuts, lambda: count_first_seen(kinds, ["Case_Type"], f"{base}/counts",
                                                    f"{base}/ckpt", ONCE))
    return cumulative_counts(spark, f"{base}/counts", ["Case_Type"])


def q_stream_cumulative_priority(spark, d):
    """Distinct cases per priority and severity up to and with each of three batches."""
    base = scratch_path(spark, "stream_cumulative_priority")
    messages, cuts = _case_stream(spark, d, base, key="product_code")
    kinds = priority_kinds(enrich_stream(decode_cases(messages), _lookup(spark)))
    groups = ["priority", "severity"]
    with rocksdb_state(spark):
        _run_in_cuts(cuts, lambda: count_first_seen(kinds, groups, f"{base}/counts", f"{base}/ckpt", ONCE))
    return cumulative_counts(spark, f"{base}/counts", groups)


def q_stream_sketch_counts(spark, d):
    """The same counts over all batches from merged sketches: are they within 5 % (three
    standard errors) of the exact ones?"""
    base = scratch_path(spark, "stream_sketch")
    messages, cuts = _case_stream(spark, d, base, key="product_code")
    kinds = counted_kinds(decode_cases(messages))
    _run_in_cuts(cuts, lambda: sketch_counts(kinds, ["Case_Type"], f"{base}/sketches", f"{base}/ckpt", ONCE))
    exact = live_status_counts(dv.cases(spark, d)).withColumnRenamed("Cases_numbers", "exact")
    return (merged_sketches(spark, f"{base}/sketches", ["Case_Type"]).join(exact, "Case_Type")
            .select("Case_Type", F.col("exact").alias("Cases_numbers"),
                    (F.abs(F.col("Cases_numbers") - F.col("exact")) <= 0.05 * F.col("exact"))
                    .alias("sketch_is_close")))


def q_stream_newest_case(spark, d):
    """The newest version of every case, held in keyed state over three batches."""
    base = scratch_path(spark, "stream_newest")
    messages, cuts = _case_stream(spark, d, base, key="product_code")
    with rocksdb_state(spark):
        _run_in_cuts(cuts, lambda: land_newest(decode_cases(messages), f"{base}/newest", f"{base}/ckpt", ONCE))
    return newest_landed(spark.read.parquet(f"{base}/newest"))


def q_stream_dedup(spark, d):
    """History and increment overlap by five days; redelivered surveys dropped, in
    four micro-batches."""
    base = scratch_path(spark, "stream_dedup")
    _touch(spark, f"{base}/in")
    cuts = [lambda part=part, b=b: _write_text(_survey_messages(
        part.where(F.col("survey_id").cast("long") % 2 == b)), f"{base}/in", "append")
        for part in (dv.survey_history(spark, d), dv.survey_increment(spark, d)) for b in (0, 1)]
    surveys = decode_surveys(stream_messages(spark, "text", f"{base}/in", max_files=ALL_FILES),
                             keep=("ingest_ts",))
    out = dedup_stream(surveys, ["survey_id"])
    with rocksdb_state(spark):
        _run_in_cuts(cuts, lambda: land_stream(out, f"{base}/landing", f"{base}/ckpt", trigger=ONCE))
    return read_landing(spark, f"{base}/landing", schemas.SURVEY)


def q_stream_publish_array(spark, d):
    """Case stream published as bounded JSON arrays from foreachBatch, read back."""
    base = scratch_path(spark, "stream_publish_array")
    messages, cuts = _case_stream(spark, d, base)
    _run_in_cuts(cuts, lambda: publish_json(decode_cases(messages), f"{base}/ckpt", fmt="text",
                                            path=f"{base}/out", envelope="array", max_rows=500, trigger=ONCE))
    return decode_cases(spark.read.text(f"{base}/out"))


def q_stream_published_counts(spark, d):
    """Records published by every micro-batch: the observed metric beside what lies in the
    batch's folder.  The second batch holds no record and sends nothing."""
    base = scratch_path(spark, "stream_published_counts")
    messages, cuts = _case_stream(spark, d, base)
    empty = spark.createDataFrame([("[]",)], "value string")
    cuts.insert(1, lambda: _write_text(empty, f"{base}/in", "append"))
    started = []

    def start():
        started.append(publish_json(decode_cases(messages), f"{base}/ckpt", fmt="text", path=f"{base}/out",
                                    envelope="array", max_rows=500, trigger=ONCE))
        return started[-1]

    _run_in_cuts(cuts, start)
    metric = spark.createDataFrame([row for q in started for row in published_rows(q)],
                                   "batch_id long, published long")
    stored = decode_cases(spark.read.text(f"{base}/out"), keep=("batch_id",)).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("stored"))
    return metric.join(stored, "batch_id", "left").na.fill(0, ["stored"])


def q_file_forward(spark, d):
    base = scratch_path(spark, "file_forward")
    _write_text(_case_messages(spark, d), f"{base}/in")
    lines = stream_files(spark, f"{base}/in", archive_dir=f"{base}/done")
    forward_files(lines, f"{base}/ckpt", fmt="text", path=f"{base}/out",
                  options=FILE_OPTIONS, trigger=ONCE).awaitTermination()
    return decode_cases(spark.read.text(f"{base}/out"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_cast": q_conform_cast,
    "event_date": q_event_date,
    "load_stamp_fixed": q_load_stamp_fixed,
    "load_stamp_now": q_load_stamp_now,
    "answers_lenient": q_answers_lenient,
    "filter_status": q_filter_status,
    "filter_in_priority": q_filter_in_priority,
    "filter_last_window": q_filter_last_window,
    "filter_not_neutral": q_filter_not_neutral,
    "merge_cases": q_merge_cases,
    "merge_surveys": q_merge_surveys,
    "latest_case": q_latest_case,
    "latest_survey": q_latest_survey,
    "fact_case_survey": q_fact_case_survey,
    "fact_from_merged": q_fact_from_merged,
    "priority_inner": q_priority_inner,
    "priority_left": q_priority_left,
    "enrich_calendar": q_enrich_calendar,
    "enrich_center_employee_product": q_enrich_center_employee_product,
    "enrich_category": q_enrich_category,
    "bands_score": q_bands_score,
    "feedback_labels": q_feedback_labels,
    "feedback_overall": q_feedback_overall,
    "hours_to_close": q_hours_to_close,
    "wide_case_survey": q_wide_case_survey,
    "kpi_total": q_kpi_total,
    "kpi_open": q_kpi_open,
    "kpi_closed": q_kpi_closed,
    "kpi_p1": q_kpi_p1,
    "kpi_high": q_kpi_high,
    "kpi_surveys": q_kpi_surveys,
    "kpi_feedback": q_kpi_feedback,
    "kpi_report": q_kpi_report,
    "live_status_counts": q_live_status_counts,
    "live_priority_counts": q_live_priority_counts,
    "json_decode_explode": q_json_decode_explode,
    "json_decode_damaged": q_json_decode_damaged,
    "json_rejects": q_json_rejects,
    "json_publish_rows": q_json_publish_rows,
    "json_publish_array": q_json_publish_array,
    "csv_round_trip": q_csv_round_trip,
    "partition_overwrite": q_partition_overwrite,
    "reference_employee_tsv": q_reference_employee_tsv,
    "reference_calendar_tsv": q_reference_calendar_tsv,
    "reference_case_history_tsv": q_reference_case_history_tsv,
    "reference_survey_history_tsv": q_reference_survey_history_tsv,
    "reference_call_center_tsv": q_reference_call_center_tsv,
    "reference_product_tsv": q_reference_product_tsv,
    "reference_country_tsv": q_reference_country_tsv,
    "reference_literals_tsv": q_reference_literals_tsv,
    "stored_pipeline_kpis": q_stored_pipeline_kpis,
    "stored_pipeline_catalog": q_stored_pipeline_catalog,
    "dimension_refresh": q_dimension_refresh,
    "fact_rebuild": q_fact_rebuild,
    "stream_land_cases": q_stream_land_cases,
    "stream_enrich": q_stream_enrich,
    "stream_kpi_batches": q_stream_kpi_batches,
    "stream_fan_out_landing": q_stream_fan_out_landing,
    "stream_priority_batches": q_stream_priority_batches,
    "stream_rejects": q_stream_rejects,
    "stream_join_batch": q_stream_join_batch,
    "stream_dedup": q_stream_dedup,
    "file_forward": q_file_forward,
    "stream_publish_array": q_stream_publish_array,
    "stream_published_counts": q_stream_published_counts,
    "stream_timed_trigger": q_stream_timed_trigger,
    "stream_batch_without_cases": q_stream_batch_without_cases,
    "stream_join_state": q_stream_join_state,
    "stream_cumulative_counts": q_stream_cumulative_counts,
    "stream_cumulative_priority": q_stream_cumulative_priority,
    "stream_sketch_counts": q_stream_sketch_counts,
    "incremental_merge": q_incremental_merge,
    "incremental_fact": q_incremental_fact,
    "landing_compaction": q_landing_compaction,
    "stream_lookup_change": q_stream_lookup_change,
    "bands_index": q_bands_index,
    "bands_many": q_bands_many,
    "stream_newest_case": q_stream_newest_case,
    "load_checked": q_load_checked,
    "load_rejects": q_load_rejects,
    "enrich_regional_calendar": q_enrich_regional_calendar,
}


# ------------------------------------------------------------- oracle SQL

def _kpi_stmt(name, cond):
    where = f" WHERE {cond}" if cond else ""
    return f"SELECT count(case_no) AS {name} FROM wide{where}"


def _kpi_row(items):
    """One row with several KPI columns (each its own scalar subquery)."""
    cols = ", ".join(f"({_kpi_stmt(n, c)}) AS {n}" for n, c in items)
    return f"SELECT {cols}"


_WIN = {w.label: w.interval for w in KPI_WINDOWS}


def _open_closed(status):
    return [(kpi_name(status.lower(), k),
             f"status = '{status}' AND {ov.in_last_sql(v)}") for k, v in _WIN.items()]


def _survey_items():
    return [(kpi_name("surveys", k),
             f"survey_timestamp IS NOT NULL AND {ov.in_last_sql(v)}") for k, v in _WIN.items()]


def _feedback_union():
    parts = []
    for k, v in _WIN.items():
        parts.append(
            f"SELECT overall_feedback AS Response, '{k}' AS window, count(*) AS "
            f"Total_Response_Count FROM wide WHERE overall_feedback IS NOT NULL AND "
            f"overall_feedback <> 'Neutral' AND {ov.in_last_sql(v)} GROUP BY overall_feedback")
    return " UNION ALL ".join(parts)


def _report_union():
    items = ([("Total_Numbers_of_Cases", None)] + _open_closed("Open") + _open_closed("Closed")
             + [("Total_Piority_1_Cases", "Priority_key = 'P1'"),
                ("Total_High_Piority_Cases", "priority IN ('High', 'Highest')")]
             + _survey_items())
    parts = [f"SELECT '{n}' AS kpi, count(case_no) AS value FROM wide"
             + (f" WHERE {c}" if c else "") for n, c in items]
    for label in ("Positive", "Negative"):
        for k, v in _WIN.items():
            parts.append(f"SELECT '{label}_{kpi_name('response', k)}' AS kpi, count(*) AS value "
                         f"FROM wide WHERE overall_feedback = '{label}' AND {ov.in_last_sql(v)}")
    return " UNION ALL ".join(parts)


_CASE_TYPED = ("status, category, sub_category, last_modified_timestamp, case_no, "
               "create_timestamp, created_employee_key, call_center_id, product_code, "
               "country_cd, communication_mode")


def _cases_priority_sql(view):
    return (f"SELECT c.case_no, c.status, c.category, c.sub_category, c.last_modified_timestamp, "
            f"p.Priority_key, p.priority, p.severity FROM cases c LEFT JOIN {view} p "
            f"ON c.category = p.category_key AND c.sub_category = p.sub_category_key")


_MERGED_CASES = f"""SELECT DISTINCT status, category, sub_category,
         CAST(last_modified_timestamp AS TIMESTAMP) AS last_modified_timestamp, case_no,
         CAST(create_timestamp AS TIMESTAMP) AS create_timestamp, created_employee_key,
         call_center_id, product_code, country_cd, communication_mode,
         CAST(CAST(create_timestamp AS TIMESTAMP) AS DATE) AS create_date
  FROM (SELECT {_CASE_TYPED} FROM case_hist UNION ALL SELECT {_CASE_TYPED} FROM case_incr) u"""

_MERGED_SURVEYS = """SELECT DISTINCT TRY_CAST(TRY_CAST(Q1 AS DOUBLE) AS INTEGER) AS Q1,
         TRY_CAST(TRY_CAST(Q3 AS DOUBLE) AS INTEGER) AS Q3,
         TRY_CAST(TRY_CAST(Q2 AS DOUBLE) AS INTEGER) AS Q2,
         TRY_CAST(TRY_CAST(Q5 AS DOUBLE) AS INTEGER) AS Q5, Q4, case_no,
         CAST(survey_timestamp AS TIMESTAMP) AS survey_timestamp, survey_id,
         CAST(CAST(survey_timestamp AS TIMESTAMP) AS DATE) AS survey_date
  FROM (SELECT CAST(Q1 AS VARCHAR) AS Q1, CAST(Q3 AS VARCHAR) AS Q3, CAST(Q2 AS VARCHAR) AS Q2,
               CAST(Q5 AS VARCHAR) AS Q5, Q4, case_no, CAST(survey_timestamp AS VARCHAR)
               AS survey_timestamp, survey_id FROM survey_hist
        UNION ALL
        SELECT CAST(Q1 AS VARCHAR), CAST(Q3 AS VARCHAR), CAST(Q2 AS VARCHAR),
               CAST(Q5 AS VARCHAR), Q4, case_no, CAST(survey_timestamp AS VARCHAR),
               survey_id FROM survey_incr) u"""


def _fact_over(cases, surveys):
    """The fact over given case and survey relations."""
    return f"""WITH newest_case AS ({ov.newest_case(cases)}),
        newest_survey AS ({ov.newest_survey(surveys)})
        {ov.fact_sql('newest_case', 'newest_survey')}"""


ORACLE: dict[str, str] = {
    "conform_cast": f"""SELECT status, category, sub_category,
        TRY_CAST(last_modified_timestamp AS TIMESTAMP) AS last_modified_timestamp, case_no,
        TRY_CAST(create_timestamp AS TIMESTAMP) AS create_timestamp, created_employee_key,
        call_center_id, product_code, country_cd, communication_mode FROM case_text""",
    "event_date": """SELECT case_no, create_timestamp, last_modified_timestamp,
        TRY_CAST(create_timestamp AS DATE) AS create_date FROM case_text""",
    "answers_lenient": """SELECT * REPLACE (CASE CAST(survey_id AS BIGINT) % 7
        WHEN 0 THEN NULL WHEN 2 THEN NULL ELSE Q1 END AS Q1) FROM surveys""",
    "load_stamp_fixed": f"""SELECT case_no, status, last_modified_timestamp,
        {ov.AS_OF_SQL} AS row_insertion_dttm, CAST({ov.AS_OF_SQL} AS DATE) AS load_date
        FROM cases""",
    "load_stamp_now": "SELECT case_no, status, true AS is_now, true AS is_today FROM cases",
    "filter_status": """SELECT case_no, status, last_modified_timestamp FROM fact
        WHERE status = 'Open'""",
    "filter_in_priority": """SELECT case_no, priority, severity FROM wide
        WHERE priority IN ('High', 'Highest')""",
    "filter_last_window": f"""SELECT case_no, status, last_modified_timestamp FROM fact
        WHERE {ov.in_last_sql('7 DAY')}""",
    "filter_not_neutral": """SELECT case_no, overall_feedback FROM wide
        WHERE overall_feedback IS NOT NULL AND overall_feedback <> 'Neutral'""",
    "merge_cases": f"""SELECT * EXCLUDE (create_date), {ov.AS_OF_SQL} AS row_insertion_dttm,
        create_date FROM ({_MERGED_CASES}) m""",
    "merge_surveys": f"""SELECT * EXCLUDE (survey_date), {ov.AS_OF_SQL} AS row_insertion_dttm,
        survey_date FROM ({_MERGED_SURVEYS}) m""",
    "latest_case": "SELECT * FROM case_latest",
    "latest_survey": "SELECT * FROM survey_latest",
    "fact_case_survey": "SELECT * FROM fact",
    "priority_inner": _cases_priority_sql("cat_pri_inner"),
    "priority_left": _cases_priority_sql("cat_pri_left"),
    "enrich_calendar": """SELECT case_no, create_timestamp,
        case_create_date_desc, case_create_week_day_nbr, case_create_week_number,
        case_create_week_name, case_create_year_week_number, case_create_month_number,
        case_create_month_name, case_create_quarter_number, case_create_quarter_name,
        case_create_half_year_number, case_create_half_year_name FROM wide""",
    "enrich_center_employee_product": """SELECT f.case_no, f.call_center_id,
        f.created_employee_key, f.product_code, w.call_center_vendor, w.location,
        w.call_center_country, w.first_name, w.last_name, w.email, w.gender, w.ldap,
        w.manager, w.hire_date, w.department, w.brand, w.commodity_desc, w.sub_commodity_desc
        FROM fact f JOIN wide w ON w.case_no IS NOT DISTINCT FROM f.case_no""",
    "enrich_category": """SELECT f.case_no, f.category, f.sub_category,
        w.category_description, w.sub_category_description, w.Priority_key, w.priority,
        w.severity, w.sla_hours
        FROM fact f JOIN wide w ON w.case_no IS NOT DISTINCT FROM f.case_no""",
    "bands_score": f"""SELECT survey_id, Q1, Q2, Q3, Q5, support_process_feedback,
        employee_conversation_feedback, employee_technical_feedback, referral_feedback
        FROM ({ov.scored('surveys', 'sv')}) x""",
    "feedback_labels": f"""SELECT survey_id,
        {ov.label_sql('support_process_feedback')} AS support_process_feedback,
        {ov.label_sql('employee_conversation_feedback')} AS employee_conversation_feedback,
        {ov.label_sql('employee_technical_feedback')} AS employee_technical_feedback,
        {ov.label_sql('referral_feedback')} AS referral_feedback
        FROM ({ov.scored('surveys', 'sv')}) x""",
    "feedback_overall": f"""SELECT survey_id, {ov.overall_sql(
        'support_process_feedback', 'employee_conversation_feedback',
        'employee_technical_feedback', 'referral_feedback')} AS overall_feedback
        FROM ({ov.scored('surveys', 'sv')}) x""",
    "hours_to_close": """SELECT case_no, status, round(CASE WHEN status = 'Closed' THEN
        (epoch(last_modified_timestamp) - epoch(create_timestamp)) / 3600 END, 6)
        AS hours_to_close FROM fact""",
    "wide_case_survey": "SELECT * REPLACE (round(hours_to_close, 6) AS hours_to_close) FROM wide",
    "kpi_total": _kpi_row([("Total_Numbers_of_Cases", None)]),
    "kpi_open": _kpi_row(_open_closed("Open")),
    "kpi_closed": _kpi_row(_open_closed("Closed")),
    "kpi_p1": _kpi_row([("Total_Piority_1_Cases", "Priority_key = 'P1'")]),
    "kpi_high": _kpi_row([("Total_High_Piority_Cases", "priority IN ('High', 'Highest')")]),
    "kpi_surveys": _kpi_row(_survey_items()),
    "kpi_feedback": _feedback_union(),
    "kpi_report": _report_union(),
    "live_status_counts": """UNPIVOT (
        SELECT count(DISTINCT case_no) AS "Total Cases",
               count(DISTINCT case_no) FILTER (status = 'Open') AS "Open Cases",
               count(DISTINCT case_no) FILTER (status = 'Closed') AS "Closed Cases" FROM cases)
        ON COLUMNS(*) INTO NAME Case_Type VALUE Cases_numbers""",
    "live_priority_counts": """SELECT p.priority, p.severity,
        count(DISTINCT c.case_no) AS Cases_numbers FROM cases c LEFT JOIN cat_pri_inner p
        ON c.category = p.category_key AND c.sub_category = p.sub_category_key
        GROUP BY p.priority, p.severity""",
}
ORACLE["fact_from_merged"] = _fact_over(_MERGED_CASES, _MERGED_SURVEYS)

_BATCH = "CAST(case_no AS BIGINT) % 3"
_CUT_SHORT = "CAST(case_no AS BIGINT) % 40 = 0"
ORACLE.update({
    "json_decode_explode": "SELECT * FROM cases",
    "json_publish_rows": "SELECT * FROM fact",
    "json_publish_array": "SELECT * FROM fact",
    "csv_round_trip": "SELECT * FROM cases",
    "partition_overwrite": """SELECT * REPLACE (CASE WHEN year(create_date) = 1998
        THEN upper(status) ELSE status END AS status),
        CAST(date_trunc('month', create_date) AS DATE) AS create_month FROM fact""",
    "stream_land_cases": "SELECT * FROM cases",
    "reference_employee_tsv": "SELECT * FROM employee",
    "reference_calendar_tsv": "SELECT * FROM calendar",
    "reference_case_history_tsv": """SELECT case_no, create_timestamp, last_modified_timestamp,
        created_employee_key, call_center_id, status, category, sub_category,
        communication_mode, country_cd, product_code,
        TRY_CAST(create_timestamp AS DATE) AS create_date FROM case_text""",
    "reference_survey_history_tsv": """SELECT survey_id, case_no,
        strftime(survey_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS survey_timestamp,
        CAST(Q1 AS VARCHAR) AS Q1, CAST(Q2 AS VARCHAR) AS Q2, CAST(Q3 AS VARCHAR) AS Q3, Q4,
        CAST(Q5 AS VARCHAR) AS Q5, CAST(survey_timestamp AS DATE) AS survey_date FROM surveys""",
    "reference_call_center_tsv": "SELECT * FROM call_center",
    "reference_product_tsv": "SELECT * FROM product",
    "reference_country_tsv": """SELECT CAST(n_nationkey AS INTEGER) AS id, n_name AS Name,
        upper(n_name[1:2]) AS Alpha_2, upper(n_name[1:3]) AS Alpha_3 FROM nation""",
    "reference_literals_tsv": f"""SELECT priority, severity, count(*) AS cases
        FROM ({_cases_priority_sql('cat_pri_inner')}) c
        WHERE case_no IN (SELECT case_no FROM ({ov.scored('surveys', 'sv')}) x
                          WHERE referral_feedback = 1)
        GROUP BY ALL""",
    "stored_pipeline_kpis": ORACLE["kpi_report"],
    "stored_pipeline_catalog": ORACLE["merge_cases"],
    "dimension_refresh": f"""SELECT *, {ov.AS_OF_SQL} AS row_insertion_dttm,
        CAST({ov.AS_OF_SQL} AS DATE) AS create_date FROM product""",
    "fact_rebuild": """SELECT *, CAST(date_trunc('month', create_date) AS DATE)
        AS create_month FROM fact""",
    "json_decode_damaged": f"SELECT * FROM cases WHERE NOT ({_CUT_SHORT})",
    "json_rejects": f"""SELECT left('{{"status":"' || status || '","category":"' || category
        || '","sub_category":"' || sub_category || '","last', 40) AS raw
        FROM cases WHERE {_CUT_SHORT}""",
    "stream_enrich": _cases_priority_sql("cat_pri_inner"),
    "stream_kpi_batches": f"""UNPIVOT (
        SELECT {_BATCH} AS batch_id, count(DISTINCT case_no) AS "Total Cases",
               count(DISTINCT case_no) FILTER (status = 'Open') AS "Open Cases",
               count(DISTINCT case_no) FILTER (status = 'Closed') AS "Closed Cases"
        FROM cases GROUP BY 1)
        ON COLUMNS(* EXCLUDE (batch_id)) INTO NAME Case_Type VALUE Cases_numbers""",
    "stream_priority_batches": f"""SELECT {_BATCH} AS batch_id, priority, severity,
        count(DISTINCT case_no) AS Cases_numbers
        FROM ({_cases_priority_sql('cat_pri_inner')}) c GROUP BY ALL""",
    "stream_fan_out_landing": "SELECT * FROM cases",
    "stream_rejects": f"""SELECT 'case' AS kind, left('{{"status":"' || status
        || '","category":"' || category || '","sub_category":"' || sub_category
        || '","last', 40) AS raw FROM cases WHERE {_CUT_SHORT}""",
    "stream_join_batch": """SELECT c.*, s.* EXCLUDE (case_no)
        FROM cases c JOIN surveys s ON s.case_no = c.case_no
        AND CAST(s.survey_id AS BIGINT) % 3 = CAST(c.case_no AS BIGINT) % 3""",
    "stream_dedup": "SELECT * FROM surveys",
    "file_forward": "SELECT * FROM cases",
    "stream_publish_array": "SELECT * FROM cases",
    "stream_published_counts": """SELECT cut + CAST(cut > 0 AS BIGINT) AS batch_id,
        count(*) AS published, count(*) AS stored
        FROM (SELECT CAST(case_no AS BIGINT) % 3 AS cut FROM cases) GROUP BY 1
        UNION ALL SELECT 1, 0, 0""",
    "stream_timed_trigger": "SELECT * FROM cases",
    "stream_batch_without_cases": """UNPIVOT (
        SELECT CASE WHEN CAST(case_no AS BIGINT) % 3 = 0 THEN 0::BIGINT ELSE 2::BIGINT END AS batch_id,
               count(DISTINCT case_no) AS "Total Cases",
               count(DISTINCT case_no) FILTER (status = 'Open') AS "Open Cases",
               count(DISTINCT case_no) FILTER (status = 'Closed') AS "Closed Cases"
        FROM cases GROUP BY 1)
        ON COLUMNS(* EXCLUDE (batch_id)) INTO NAME Case_Type VALUE Cases_numbers""",
    "stream_join_state": "SELECT c.*, s.* EXCLUDE (case_no) FROM cases c JOIN surveys s USING (case_no)",
    "stream_cumulative_counts": """UNPIVOT (
        SELECT b.batch_id, count(DISTINCT case_no) AS "Total Cases",
               count(DISTINCT case_no) FILTER (status = 'Open') AS "Open Cases",
               count(DISTINCT case_no) FILTER (status = 'Closed') AS "Closed Cases"
        FROM cases JOIN (SELECT unnest([0, 1, 2])::BIGINT AS batch_id) b
          ON CAST(product_code AS BIGINT) % 3 <= b.batch_id GROUP BY 1)
        ON COLUMNS(* EXCLUDE (batch_id)) INTO NAME Case_Type VALUE Cases_numbers""",
    "stream_cumulative_priority": """SELECT b.batch_id, p.priority, p.severity,
        count(DISTINCT c.case_no) AS Cases_numbers
        FROM cases c JOIN (SELECT unnest([0, 1, 2])::BIGINT AS batch_id) b
          ON CAST(c.product_code AS BIGINT) % 3 <= b.batch_id
        LEFT JOIN cat_pri_inner p ON c.category = p.category_key
          AND c.sub_category = p.sub_category_key GROUP BY ALL""",
    "stream_sketch_counts": f"SELECT *, true AS sketch_is_close FROM ({ORACLE['live_status_counts']}) x",
    "incremental_merge": ORACLE["merge_cases"],
    "incremental_fact": "SELECT * FROM fact",
    "landing_compaction": "SELECT * FROM cases",
    "stream_lookup_change": f"""SELECT * REPLACE (CASE WHEN {_BATCH} = 0 THEN severity
        ELSE upper(severity) END AS severity), {_BATCH} AS batch_id
        FROM ({_cases_priority_sql('cat_pri_inner')}) x""",
    "bands_index": ORACLE["bands_score"],
    "bands_many": """SELECT l_orderkey, l_linenumber, question, answer,
        arg_min(score, p_partkey) AS score
        FROM (SELECT row_number() OVER () AS n, l_orderkey, l_linenumber, CAST(l_linenumber % 5 AS VARCHAR) AS question,
                     l_partkey * 101 % 10007 AS answer FROM lineitem) a
        LEFT JOIN (SELECT *, p_partkey * 37 % 9973 AS lo, CAST(p_partkey % 7 - 3 AS INTEGER) AS score
                   FROM part) p
          ON CAST(p_partkey % 4 AS VARCHAR) = question AND answer BETWEEN lo AND lo + p_size
        GROUP BY n, l_orderkey, l_linenumber, question, answer""",
    "stream_newest_case": "SELECT * FROM case_latest",
    "load_checked": """SELECT * FROM surveys WHERE CAST(survey_id AS BIGINT) % 7 <> 2
        AND CAST(survey_id AS BIGINT) % 11 <> 3""",
    "load_rejects": """SELECT survey_id, 'Q1' AS "column", 'n/a' AS raw FROM surveys
        WHERE CAST(survey_id AS BIGINT) % 7 = 2
        UNION ALL SELECT survey_id, 'survey_timestamp', 'yesterday' FROM surveys
        WHERE CAST(survey_id AS BIGINT) % 11 = 3""",
    "enrich_regional_calendar": """SELECT f.case_no, f.create_timestamp,
        CASE CAST(f.call_center_id AS BIGINT) % 3 WHEN 0 THEN 'EU' WHEN 1 THEN 'APAC' END AS region,
        c.date_desc AS case_create_date_desc,
        CASE WHEN CAST(f.call_center_id AS BIGINT) % 3 = 0 AND day(c.calendar_date) % 3 = 0
             THEN upper(c.month_name) ELSE c.month_name END AS case_create_month_name
        FROM fact f LEFT JOIN calendar c ON c.calendar_date = CAST(f.create_timestamp AS DATE)""",
})


# ------------------------------------------------------------------ contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the KPI report over the wide case/survey table (sf0.001)."""
    return kpi_report(_wide(spark, SMOKE_DIR, KPI_COLUMNS), AS_OF)


def _training_data():
    """Queries and SQL of the training-data sub-package and of the corpus pipeline,
    where they are present."""
    found, sql = {}, {}
    try:
        from casekit.llm import queries as llm
        found.update(llm.QUERIES)
        sql.update(llm.ORACLE)
        import corpus_pipeline
        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ModuleNotFoundError as e:
        if e.name not in ("casekit.llm", "corpus_pipeline"):
            raise
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in ORACLE.items():
        if name in QUERIES:
            if sql.lstrip().upper().startswith("WITH "):
                # Splice our own CTEs after the view CTEs.
                body = sql.lstrip()[5:]
                out[name] = ov.with_views("SELECT 1").rsplit("\nSELECT 1", 1)[0] + ",\n" + body
            else:
                out[name] = ov.with_views(sql)
    return {**out, **_training_data()[1]}
