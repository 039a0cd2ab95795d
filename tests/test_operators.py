import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casekit import schemas
from casekit.operators import (DimSpec, enrich, latest_per_key, live_priority_counts,
                               live_status_counts, merge_distinct, score_bands)
from casekit.plans.fact import build_fact, latest_cases
from casekit.sources import driver_views as dv

T0 = dt.datetime(2001, 1, 1, 10, 0, 0)


def _cases(spark, rows):
    return spark.createDataFrame(rows, schemas.CASE)


def _case(no, ts, status="Open", sub="A0"):
    return (status, sub[0], sub, ts, no, T0, "1", "2", "3", "US", "mail")


def test_latest_per_key_nulls_and_ties(spark):
    rows = [_case("1", T0), _case("1", None), _case("1", T0 + dt.timedelta(hours=1)),
            _case(None, T0), _case(None, T0 + dt.timedelta(days=1)),
            _case("2", T0, status="Open"), _case("2", T0, status="Closed")]
    got = {r.case_no: r for r in latest_cases(_cases(spark, rows)).collect()}
    assert got["1"].last_modified_timestamp == T0 + dt.timedelta(hours=1)
    assert got[None].last_modified_timestamp == T0 + dt.timedelta(days=1)
    # tie on time: broken by the next column (status) ascending
    assert got["2"].status == "Closed"


def test_latest_per_key_same_second_tie(spark):
    a = _case("7", T0.replace(microsecond=100000), status="Open")
    b = _case("7", T0.replace(microsecond=900000), status="Closed")
    got = latest_cases(_cases(spark, [a, b])).collect()
    assert len(got) == 1 and got[0].status == "Closed"   # tie after truncation
    assert got[0].last_modified_timestamp == T0


def test_latest_per_key_order_independent(spark):
    rows = [_case(str(i % 5), T0 + dt.timedelta(minutes=i % 3), status=s)
            for i in range(40) for s in ("Open", "Closed")]
    ref = sorted(tuple(r) for r in latest_cases(_cases(spark, rows)).collect())
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = _cases(spark, rows).repartition(3)
        assert sorted(tuple(r) for r in latest_cases(df).collect()) == ref


def test_latest_per_key_plans_partial_limit(spark):
    df = _cases(spark, [_case("1", T0)])
    plan = latest_per_key(df, ["case_no"], [("last_modified_timestamp", "desc")]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_merge_distinct_collapses_sources(spark):
    hist = spark.createDataFrame(
        [("5", "4", "3", "2", "txt", "9", "2001-01-01 10:00:00", "s1", "2000-01-01 00:00:00")],
        "Q1 string, Q3 string, Q2 string, Q5 string, Q4 string, case_no string, "
        "survey_timestamp string, survey_id string, row_insertion_dttm string")
    incr = spark.createDataFrame([(5, 4, 3, 2, "txt", "9", T0, "s1")], schemas.SURVEY)
    out = merge_distinct([hist, incr], schemas.SURVEY_DLY_MERGE, as_of="2001-11-04 00:00:00")
    rows = out.collect()
    assert len(rows) == 1
    assert rows[0].Q1 == 5 and rows[0].survey_date == dt.date(2001, 1, 1)
    assert rows[0].row_insertion_dttm == dt.datetime(2001, 11, 4)
    again = merge_distinct([out, incr], schemas.SURVEY_DLY_MERGE, as_of="2001-11-04 00:00:00")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))   # idempotent


def test_enrich_keeps_rows_and_bad_keys(spark):
    fact = spark.createDataFrame([("1", "10"), ("2", "x"), ("3", None), ("4", "11")],
                                 "case_no string, emp string")
    emp = spark.createDataFrame([(10, "Ann"), (11, "Bob")], "emp_key int, first_name string")
    out = enrich(fact, [DimSpec(emp, ["emp"], ["emp_key"], ["first_name"])])
    got = {r.case_no: r.first_name for r in out.collect()}
    assert got == {"1": "Ann", "2": None, "3": None, "4": "Bob"}


def test_enrich_duplicate_key(spark):
    fact = spark.createDataFrame([("1", "2001-01-01")], "case_no string, d string")
    cal = spark.createDataFrame([(dt.date(2001, 1, 1), "US"), (dt.date(2001, 1, 1), "EU"),
                                 (None, "X"), (None, "Y")], "calendar_date date, region string")
    spec = DimSpec(cal, [F.col("d").cast("date")], ["calendar_date"], ["region"], name="calendar")
    with pytest.raises(Exception, match="calendar: key"):
        enrich(fact, [spec]).collect()
    spec.on_duplicate = "first"
    assert [r.region for r in enrich(fact, [spec]).collect()] == ["EU"]


def test_enrich_probe_bound(spark):
    fact = spark.createDataFrame([("1", "a")], "case_no string, k string")
    dim = spark.createDataFrame([("a", "x" * 50), ("b", "y")], "k string, v string")
    # two rows of 16 + 8 + 1 + 8 bytes and the values
    small = enrich(fact, [DimSpec(dim, ["k"], ["k"], ["v"], max_broadcast_bytes=117)])
    big = enrich(fact, [DimSpec(dim, ["k"], ["k"], ["v"], max_broadcast_bytes=116)])
    assert "ResolvedHint (strategy=broadcast)" in small._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in big._jdf.queryExecution().analyzed().toString()
    assert small.collect() == big.collect()


def _questions(spark, rows=None):
    rows = rows or [(q, "", "rating", "0-10", "0-4", "5-7", "8-10")
                    for q in ("Q1", "Q2", "Q3", "Q5")]
    return spark.createDataFrame(rows, schemas.SURVEY_QUESTION)


def test_score_bands_boundaries(spark):
    vals = [0, 4, 5, 7, 8, 10, 11, None]
    df = spark.createDataFrame([(v, v, v, v) for v in vals], "Q1 int, Q2 int, Q3 int, Q5 int")
    got = [r.support_process_feedback for r in score_bands(df, _questions(spark)).collect()]
    assert got == [-1, -1, 0, 0, 1, 1, None, None]


def test_score_bands_odd_ranges_and_duplicates(spark):
    rows = [("Q1", "", "r", "", "9-10", "n/a", None), ("Q2", "", "r", "", "0-4", "5-7", "10-10"),
            ("Q3", "", "r", "", "0-4", "5-7", "8-10"), ("Q5", "", "r", "", "0-4", "5-7", "8-10")]
    df = spark.createDataFrame([(9, 10, 1, 1), (5, 9, 1, 1)], "Q1 int, Q2 int, Q3 int, Q5 int")
    got = [(r.support_process_feedback, r.employee_conversation_feedback)
           for r in score_bands(df, _questions(spark, rows)).collect()]
    assert got == [(-1, 1), (None, None)]
    dup = _questions(spark) .unionByName(_questions(spark).limit(1))
    with pytest.raises(Exception, match="defined more than once"):
        score_bands(df, dup).collect()


def test_live_status_counts_open_and_closed_once(spark):
    batch = spark.createDataFrame([("1", "Open"), ("1", "Closed"), ("2", "Open"), ("2", "Open"),
                                   (None, "Open")], "case_no string, status string")
    got = {r.Case_Type: r.Cases_numbers for r in live_status_counts(batch).collect()}
    assert got == {"Total Cases": 2, "Open Cases": 2, "Closed Cases": 1}


def test_live_priority_counts_unmatched_group(spark):
    batch = spark.createDataFrame([("1", "High", "Major"), ("1", "High", "Major"),
                                   ("2", None, None)],
                                  "case_no string, priority string, severity string")
    got = {(r.priority, r.severity): r.Cases_numbers for r in live_priority_counts(batch).collect()}
    assert got == {("High", "Major"): 1, (None, None): 1}


def test_fact_left_join_semantics(spark):
    cases = _cases(spark, [_case("1", T0), _case(None, T0), _case("3", T0)])
    surveys = spark.createDataFrame(
        [(5, 5, 5, 5, "a", "1", T0, "s1"), (6, 6, 6, 6, "b", "1", T0 + dt.timedelta(days=400),
                                             "s2"),
         (1, 1, 1, 1, "c", None, T0, "s3"), (1, 1, 1, 1, "d", "99", T0, "s4")], schemas.SURVEY)
    fact = {r.case_no: r for r in build_fact(cases, surveys, as_of=T0).collect()}
    assert set(fact) == {"1", None, "3"}
    assert fact["1"].survey_id == "s2"           # latest survey, however late
    assert fact[None].survey_id is None and fact["3"].survey_id is None
    assert fact["1"].create_date == T0.date()


def test_driver_views_counts(spark):
    d = "/root/testdata/sf0.01"
    assert dv.cases(spark, d).count() == 60000
    assert dv.case_history(spark, d).count() == 43975
    assert dv.case_increment(spark, d).count() == 24614
    assert dv.calendar(spark, d).count() == 2399


def test_enrich_two_unnamed_dims(spark):
    fact = spark.createDataFrame([("1", "a", "x")], "case_no string, k1 string, k2 string")
    d1 = spark.createDataFrame([("a", 1)], "k string, v1 int")
    d2 = spark.createDataFrame([("x", 2)], "k string, v2 int")
    out = enrich(fact, [DimSpec(d1, ["k1"], ["k"], ["v1"]), DimSpec(d2, ["k2"], ["k"], ["v2"])])
    assert [tuple(r) for r in out.collect()] == [("1", "a", "x", 1, 2)]


def test_kpi_feedback_absent_class_gives_no_row(spark):
    from casekit.operators import kpi_feedback
    as_of = dt.datetime(2001, 11, 4)
    wide = spark.createDataFrame(
        [("1", "Positive", as_of), ("2", "Negative", as_of - dt.timedelta(days=3)),
         ("3", "Neutral", as_of), ("4", None, as_of)],
        "case_no string, overall_feedback string, last_modified_timestamp timestamp_ntz")
    got = {(r.Response, r.window): r.Total_Response_Count
           for r in kpi_feedback(wide, as_of).collect()}
    assert got == {("Positive", "1HR"): 1, ("Positive", "1Day"): 1, ("Positive", "Week"): 1,
                   ("Positive", "1Month"): 1, ("Negative", "Week"): 1, ("Negative", "1Month"): 1}


def test_shuffle_joins_come_before_broadcast_joins(spark):
    from casekit.operators.enrich import DimSpec, enrich
    fact = spark.createDataFrame([(1, 1, "x"), (2, None, "y")], "a int, b int, c string")
    small = spark.createDataFrame([(1, "s")], "k int, small string")
    large = spark.createDataFrame([(1, "l")], "k int, large string")
    out = enrich(fact, [DimSpec(small, ["a"], ["k"], broadcast=True),
                        DimSpec(large.hint("merge"), ["b"], ["k"], max_broadcast_bytes=0)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("small#") < plan.index("large#")
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "strategy=broadcast" in joins[0] and "strategy=broadcast" not in joins[1]   # the outer one comes first
    assert out.columns == ["a", "b", "c", "small", "large"]
    assert sorted(map(tuple, out.collect())) == [(1, 1, "x", "s", "l"), (2, None, "y", None, None)]
