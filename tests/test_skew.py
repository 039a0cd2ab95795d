"""A key holding a third of all rows: results stay exact and the plans combine
rows before the shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from casekit import schemas
from casekit.operators import live_status_counts, merge_distinct
from casekit.plans.fact import build_fact, latest_cases

T0 = dt.datetime(2001, 1, 1)


def _skewed_cases(spark, n=3000):
    # case "hot" holds one third of the rows; the rest are spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "Open").otherwise("Closed").alias("status"),
        F.lit("A").alias("category"), F.lit("A0").alias("sub_category"),
        (F.lit(T0) + F.make_interval(secs=F.col("id").cast("int"))).cast("timestamp_ntz")
         .alias("last_modified_timestamp"),
        F.when(F.col("id") < n // 3, "hot").otherwise((F.col("id") % 1000).cast("string"))
         .alias("case_no"),
        F.lit(T0).cast("timestamp_ntz").alias("create_timestamp"),
        F.lit("1").alias("created_employee_key"), F.lit("2").alias("call_center_id"),
        F.lit("3").alias("product_code"), F.lit("US").alias("country_cd"),
        F.lit("mail").alias("communication_mode")).repartition(6)


def test_latest_hot_key_exact(spark):
    cases = _skewed_cases(spark)
    got = {r.case_no: r.last_modified_timestamp for r in latest_cases(cases).collect()}
    want = {r.case_no: r.m for r in cases.groupBy("case_no").agg(
        F.max("last_modified_timestamp").alias("m")).collect()}
    assert got == want and len(got) == 1000 + 1 - 0   # 1000 spread keys ("0".."999") + "hot"


def test_fact_hot_key_one_row(spark):
    cases = _skewed_cases(spark)
    surveys = spark.range(900).select(
        F.lit(5).alias("Q1"), F.lit(5).alias("Q3"), F.lit(5).alias("Q2"), F.lit(5).alias("Q5"),
        F.lit("x").alias("Q4"), F.lit("hot").alias("case_no"),
        (F.lit(T0) + F.make_interval(secs=F.col("id").cast("int"))).cast("timestamp_ntz")
         .alias("survey_timestamp"), F.col("id").cast("string").alias("survey_id"))
    fact = build_fact(cases, surveys, as_of=T0)
    assert fact.count() == 1001
    assert fact.where("case_no = 'hot'").first().survey_id == "899"


def test_live_counts_hot_key(spark):
    got = {r.Case_Type: r.Cases_numbers for r in live_status_counts(_skewed_cases(spark)).collect()}
    assert got["Total Cases"] == 1001
    plan = live_status_counts(_skewed_cases(spark))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan     # per-case flags combined before the shuffle


def test_merge_hot_duplicates(spark):
    cases = _skewed_cases(spark)
    hot = cases.where("case_no = 'hot'").limit(1)
    copies = hot.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(1000)))).drop("k")
    many = cases.unionByName(copies)
    out = merge_distinct([many, cases], schemas.CASE_DLY_MERGE, as_of=T0)
    assert out.count() == 3000


def test_hot_date_is_written_by_several_tasks(spark, tmp_dir):
    from casekit.sources.tables import write_table
    n = 60_000
    rows = spark.range(n).select(
        F.when(F.col("id") < n // 3, "hot").otherwise((F.col("id") % 10).cast("string")).alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"))
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "256k")
        write_table(rows, f"{tmp_dir}/t", ["d"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = [f for f in spark.read.parquet(f"{tmp_dir}/t").inputFiles()]
    hot = [f for f in files if "d=hot" in f]
    assert len(hot) >= 2 and len(files) < 60
    assert spark.read.parquet(f"{tmp_dir}/t").count() == n
