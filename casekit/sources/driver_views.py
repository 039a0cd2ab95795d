"""Case, survey and dimension frames over the benchmark tables.

The benchmark ships TPC-H-like tables and an event log; this module maps them
onto the case/survey model so every job can run on them:

* a case version is a line item of an order (case_no = order key);
* a survey is an event (two events per case number);
* dimensions come from supplier/nation/region, customer, part and the order
  dates; the category, priority and question tables are fixed literals.

Every frame selects only the columns it needs, so scans are pruned.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit import schemas
from casekit.sources.literal import literal_frame

# history/increment split points (the increment overlaps one
# year of history), and the benchmark's newest case timestamp used as as_of.
CASE_HISTORY_BEFORE = "2000-01-01 00:00:00"
CASE_INCR_FROM = "1999-01-01 00:00:00"
SURVEY_HISTORY_BEFORE = "2024-01-20 00:00:00"
SURVEY_INCR_FROM = "2024-01-15 00:00:00"
AS_OF = _dt.datetime(2001, 11, 4, 0, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One case version per line item (typed timestamps, string keys)."""
    # joined on the case number, so that what goes on by it finds its rows dealt already
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("case_no"), "l_partkey", "l_suppkey",
        "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("case_no"), "o_custkey", "o_orderdate",
        "o_orderpriority")
    j = li.join(o, "case_no", "inner")
    return j.select(
        F.when(F.col("l_linestatus") == "O", "Open").otherwise("Closed").alias("status"),
        F.col("l_returnflag").alias("category"),
        F.concat(F.col("l_returnflag"), (F.col("l_linenumber") % 4).cast("string"))
         .alias("sub_category"),
        F.col("l_shipdate").alias("last_modified_timestamp"),
        "case_no",
        F.col("o_orderdate").alias("create_timestamp"),
        F.col("o_custkey").cast("string").alias("created_employee_key"),
        F.col("l_suppkey").cast("string").alias("call_center_id"),
        F.col("l_partkey").cast("string").alias("product_code"),
        F.lit("US").alias("country_cd"),
        F.col("o_orderpriority").alias("communication_mode"))


def case_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases older than the split, as the history extract holds them (text)."""
    c = cases(spark, sf_dir).where(
        F.col("last_modified_timestamp") < F.lit(CASE_HISTORY_BEFORE).cast("timestamp_ntz"))
    return c.select(*[F.col(n).cast("string").alias(n) for n in schemas.CASE_COLUMNS])


def case_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases from the increment onwards (typed, as decoded from the stream)."""
    return cases(spark, sf_dir).where(
        F.col("last_modified_timestamp") >= F.lit(CASE_INCR_FROM).cast("timestamp_ntz"))


def surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey per event; answers derived from the event's fields."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type",
                                                "value", "props")
    return ev.select(
        (F.floor("value") % 11).cast("int").alias("Q1"),
        (F.col("event_id") % 13).cast("int").alias("Q3"),
        (F.get_json_object("props", "$.k").try_cast("int") % 11).alias("Q2"),
        (F.col("user_id") % 11).cast("int").alias("Q5"),
        F.col("event_type").alias("Q4"),
        F.expr("event_id div 2").cast("string").alias("case_no"),
        F.col("ts").alias("survey_timestamp"),
        F.col("event_id").cast("string").alias("survey_id"))


def survey_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older surveys with answers held as text, as in the history extract."""
    s = surveys(spark, sf_dir).where(
        F.col("survey_timestamp") < F.lit(SURVEY_HISTORY_BEFORE).cast("timestamp_ntz"))
    return s.select(*[F.col(n).cast("string").alias(n) for n in schemas.SURVEY_COLUMNS])


def survey_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surveys(spark, sf_dir).where(
        F.col("survey_timestamp") >= F.lit(SURVEY_INCR_FROM).cast("timestamp_ntz"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per distinct order date."""
    d = (table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
         .distinct())
    wk = F.weekofyear("d")
    half = F.when(F.month("d") <= 6, 1).otherwise(2)
    return d.select(
        F.col("d").alias("calendar_date"),
        F.date_format("d", "yyyy-MM-dd").alias("date_desc"),
        F.dayofweek("d").alias("week_day_nbr"),
        wk.alias("week_number"),
        F.concat(F.lit("Week "), wk.cast("string")).alias("week_name"),
        (F.year("d") * 100 + wk).alias("year_week_number"),
        F.month("d").alias("month_number"),
        F.date_format("d", "MMMM").alias("month_name"),
        F.quarter("d").alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter("d").cast("string")).alias("quarter_name"),
        half.alias("half_year_number"),
        F.concat(F.lit("H"), half.cast("string")).alias("half_year_name"),
        F.lit("US").alias("geo_region_cd"))


def call_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (s.join(n, s["s_nationkey"] == n["n_nationkey"])
          .join(r, F.col("n_regionkey") == r["r_regionkey"]))
    return j.select(F.col("s_suppkey").cast("string").alias("call_center_id"),
                    F.col("s_name").alias("call_center_vendor"),
                    F.col("n_name").alias("location"),
                    F.col("r_name").alias("country"))


def country(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return n.select(F.col("n_nationkey").cast("int").alias("id"), F.col("n_name").alias("Name"),
                    F.upper(F.substring("n_name", 1, 2)).alias("Alpha_2"),
                    F.upper(F.substring("n_name", 1, 3)).alias("Alpha_3"))


def employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                "c_mktsegment")
    key = F.col("c_custkey")
    return c.select(
        key.cast("int").alias("emp_key"),
        F.col("c_name").alias("first_name"),
        F.concat(F.lit("Nation"), F.col("c_nationkey").cast("string")).alias("last_name"),
        F.concat(F.lit("emp"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("emp"), key.cast("string")).alias("ldap"),
        F.date_add(F.lit("1990-01-01").cast("date"), (key % 3650).cast("int")).alias("hire_date"),
        F.col("c_mktsegment").alias("manager"))


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return p.select(F.col("p_partkey").cast("string").alias("product_id"),
                    F.col("p_type").alias("department"),
                    F.col("p_brand").alias("brand"),
                    F.col("p_name").alias("commodity_desc"),
                    F.col("p_size").cast("string").alias("sub_commodity_desc"))


# Category keys (flag + digit; R3 deliberately absent), the
# priority table (P4 deliberately absent) and the survey questions.
CATEGORY_FLAGS = {"A": "Accepted", "N": "New", "R": "Returned"}
MISSING_SUB_CATEGORIES = {"R3"}
PRIORITIES = [("P1", "Highest", "Critical", "4"),
              ("P2", "High", "Major", "8"),
              ("P3", "Medium", "Minor", "24")]
QUESTIONS = [
    ("Q1", "How satisfied are you with the support process?"),
    ("Q2", "How was the conversation with the employee?"),
    ("Q3", "How well did the employee solve the technical problem?"),
    ("Q5", "How likely are you to recommend us?"),
]
NEGATIVE_RANGE, NEUTRAL_RANGE, POSITIVE_RANGE = "0-4", "5-7", "8-10"


def case_category(spark: SparkSession) -> DataFrame:
    rows = []
    for flag, desc in CATEGORY_FLAGS.items():
        for digit in range(4):
            sub = f"{flag}{digit}"
            if sub in MISSING_SUB_CATEGORIES:
                continue
            rows.append((flag, sub, desc, f"{desc} {digit}", f"P{digit + 1}"))
    return literal_frame(spark, rows, schemas.CASE_CATEGORY)


def case_priority(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, PRIORITIES, schemas.CASE_PRIORITY)


def survey_questions(spark: SparkSession) -> DataFrame:
    rows = [(q, desc, "rating", "0-10", NEGATIVE_RANGE, NEUTRAL_RANGE, POSITIVE_RANGE)
            for q, desc in QUESTIONS]
    return literal_frame(spark, rows, schemas.SURVEY_QUESTION)
