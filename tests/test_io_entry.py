import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from casekit import schemas
from casekit.functions.jsonio import text_fields
from casekit.sources import driver_views as dv
from casekit.sources.delimited import read_delimited, write_delimited
from casekit.sources.jdbc import jdbc_options
from casekit.sources.tables import (ensure_table, overwrite_partitions, read_landing,
                                    write_table)

SF = "/root/testdata/sf0.001"


def test_delimited_round_trip(spark, tmp_dir):
    cases = dv.cases(spark, SF)
    write_delimited(text_fields(cases), f"{tmp_dir}/tsv")
    back = read_delimited(spark, f"{tmp_dir}/tsv", schemas.CASE)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cases.collect()))


def test_overwrite_partitions_dynamic(spark, tmp_dir):
    df = spark.createDataFrame([("a", dt.date(2001, 1, 1)), ("b", dt.date(2001, 1, 2))],
                               "v string, d date")
    write_table(df, f"{tmp_dir}/t", ["d"])
    new = spark.createDataFrame([(dt.date(2001, 1, 2), "B")], "d date, v string")
    overwrite_partitions(new, f"{tmp_dir}/t", schemas.struct(("v", schemas.S), ("d", schemas.D)),
                         ["d"])
    got = sorted(map(tuple, read_landing(spark, f"{tmp_dir}/t", schemas.struct(
        ("v", schemas.S), ("d", schemas.D))).collect()))
    assert got == [("B", dt.date(2001, 1, 2)), ("a", dt.date(2001, 1, 1))]


def test_catalog_table(spark):
    name = "ck_fact_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_table(spark, name, schemas.FACT, ["create_date"])
    ensure_table(spark, name, schemas.FACT, ["create_date"])     # rerun is fine
    assert spark.table(name).columns[-1] == "create_date"
    from casekit.functions import conform
    row = conform(spark.createDataFrame([("Open", "1", dt.date(2001, 1, 1))],
                                        "status string, case_no string, create_date date"),
                  schemas.FACT, strict=False)
    overwrite_partitions(row, name, schemas.FACT, ["create_date"])
    overwrite_partitions(row.withColumn("status", F.lit("Closed")), name, schemas.FACT,
                         ["create_date"])
    got = spark.table(name).select("status", "case_no").collect()
    assert [tuple(r) for r in got] == [("Closed", "1")]


def test_jdbc_options():
    o = jdbc_options("jdbc:x", query="select 1 as id", partition_column="id", lower_bound=0,
                     upper_bound=10, num_partitions=4, properties={"user": "u"})
    assert o["dbtable"] == "(select 1 as id) q" and o["numPartitions"] == "4" and "query" not in o
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 23
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["fact_case_survey", "wide_case_survey", "kpi_report",
                                  "merge_surveys", "kpi_feedback"])
def test_against_oracle(spark, name):
    import __spark_entry__ as E
    from tools.check_oracle import digest
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_no_local_paths_in_library():
    root = os.path.join(os.path.dirname(os.path.dirname(__file__)), "casekit")
    for dirpath, _, files in os.walk(root):
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(dirpath, f)).read()
                assert "/root/testdata" not in text or f == "driver_views.py"


def test_bucketed_tables_join_without_shuffle(spark):
    a = spark.range(1000).selectExpr("cast(id as string) AS k", "id AS v")
    b = spark.range(1000).selectExpr("cast(id as string) AS k", "id * 2 AS w")
    write_table(a, "ck_bucket_a", bucket_by=(4, ["k"]))
    write_table(b, "ck_bucket_b", bucket_by=(4, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("ck_bucket_a").join(spark.table("ck_bucket_b"), "k")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert j.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


class _Recorder:
    """Stands in for Spark's reader/writer builders: records every call."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self
        return call


def test_jdbc_reader_and_writer_wiring():
    from casekit.sources.jdbc import read_jdbc, write_jdbc

    class FakeSpark:
        read = _Recorder()

    class FakeFrame:
        write = _Recorder()

    read_jdbc(FakeSpark, "jdbc:db://h/x", query="select a from t", properties={"user": "u"},
              partition_column="a", lower_bound=1, upper_bound=100, num_partitions=8)
    opts = [c for c in FakeSpark.read.calls if c[0] == "options"][0][2]
    assert FakeSpark.read.calls[0] == ("format", ("jdbc",), {})
    assert opts["dbtable"] == "(select a from t) q" and opts["partitionColumn"] == "a"
    assert opts["numPartitions"] == "8" and opts["user"] == "u"
    assert FakeSpark.read.calls[-1][0] == "load"

    write_jdbc(FakeFrame, "jdbc:db://h/x", "cases_dim", {"user": "u"})
    names = [c[0] for c in FakeFrame.write.calls]
    assert names[0] == "format" and names[-1] == "save"
    assert ("mode", ("errorifexists",), {}) in FakeFrame.write.calls
    assert ("option", ("dbtable", "cases_dim"), {}) in FakeFrame.write.calls


def test_kafka_source_wiring(spark):
    from casekit.streaming.sources import stream_messages

    class FakeSpark:
        readStream = _Recorder()

    stream_messages(FakeSpark, "kafka", options={"kafka.bootstrap.servers": "b:9092",
                                                 "subscribe": "cases,cases_replay"})
    calls = FakeSpark.readStream.calls
    assert calls[0] == ("format", ("kafka",), {})
    assert calls[1][2]["subscribe"] == "cases,cases_replay"
    assert [c[0] for c in calls[2:]] == ["load", "select"]


def test_reference_frame_header_case_and_order(spark, tmp_dir):
    from casekit.plans.jobs import reference_frame
    rows = [("s1", "10", "2024-01-05 10:00:00", "5", "7", "9", "fine", "x"),
            ("s2", "11", "not a time", "5.0", "", "3", "ok", "2")]
    df = spark.createDataFrame(rows, "survey_id string, Case_no string, survey_timestamp string, "
                                     "Q1 string, Q2 string, Q3 string, Q4 string, Q5 string")
    write_delimited(df, f"{tmp_dir}/surveys")
    got = {r.survey_id: r for r in reference_frame(spark, "survey_stg",
                                                   f"{tmp_dir}/surveys").collect()}
    assert got["s1"].case_no == "10" and got["s1"].survey_date == dt.date(2024, 1, 5)
    assert got["s2"].survey_date is None          # bad timestamp -> NULL, no failure
    assert got["s1"].Q2 == "7" and got["s1"].Q5 == "x"   # history keeps answers as text
