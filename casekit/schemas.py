"""Declared schemas of every table the pipeline reads or writes.

This is the one place that names columns (case keys are ``category`` and
``sub_category`` everywhere, both in the stream and in batch).  Column order
follows the declared tables: note that survey answers run Q1, Q3, Q2, Q5, Q4.
Every writer matches columns by name, so the odd order cannot swap Q2 and Q3.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DateType()
TS = T.TimestampNTZType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def strings(*names: str) -> T.StructType:
    return struct(*[(n, S) for n in names])


CALENDAR = struct(
    ("calendar_date", D), ("date_desc", S), ("week_day_nbr", I), ("week_number", I),
    ("week_name", S), ("year_week_number", I), ("month_number", I), ("month_name", S),
    ("quarter_number", I), ("quarter_name", S), ("half_year_number", I),
    ("half_year_name", S), ("geo_region_cd", S))
CALL_CENTER = strings("call_center_id", "call_center_vendor", "location", "country")
CASE_CATEGORY = strings("category_key", "sub_category_key", "category_description",
                        "sub_category_description", "priority")
COUNTRY = struct(("id", I), ("Name", S), ("Alpha_2", S), ("Alpha_3", S))
CASE_PRIORITY = strings("Priority_key", "priority", "severity", "SLA")
EMPLOYEE = struct(("emp_key", I), ("first_name", S), ("last_name", S), ("email", S),
                  ("gender", S), ("ldap", S), ("hire_date", D), ("manager", S))
PRODUCT = strings("product_id", "department", "brand", "commodity_desc", "sub_commodity_desc")
SURVEY_QUESTION = strings("question_id", "question_desc", "response_type", "range",
                          "negative_response_range", "neutral_response_range",
                          "positive_response_range")

# History extracts as landed in the relational store: everything text except
# the derived date.
CASE_HISTORY = struct(
    ("case_no", S), ("create_timestamp", S), ("last_modified_timestamp", S),
    ("created_employee_key", S), ("call_center_id", S), ("status", S), ("category", S),
    ("sub_category", S), ("communication_mode", S), ("country_cd", S), ("product_code", S),
    ("create_date", D))
SURVEY_HISTORY = struct(
    ("survey_id", S), ("case_no", S), ("survey_timestamp", S), ("Q1", S), ("Q2", S),
    ("Q3", S), ("Q4", S), ("Q5", S), ("survey_date", D))

CASE_COLUMNS = ["status", "category", "sub_category", "last_modified_timestamp", "case_no",
                "create_timestamp", "created_employee_key", "call_center_id", "product_code",
                "country_cd", "communication_mode"]
SURVEY_COLUMNS = ["Q1", "Q3", "Q2", "Q5", "Q4", "case_no", "survey_timestamp", "survey_id"]
ANSWERS = ["Q1", "Q3", "Q2", "Q5"]

# Messages as they arrive on the wire (JSON).  Answers are decoded as text and
# converted afterwards, so 5, 5.0 and "5" all give 5.
CASE_MESSAGE = strings(*CASE_COLUMNS)
SURVEY_MESSAGE = strings(*SURVEY_COLUMNS)

# Typed records used from landing onwards.
CASE = struct(*[(c, TS if c.endswith("_timestamp") else S) for c in CASE_COLUMNS])
SURVEY = struct(*[(c, I if c in ANSWERS else (TS if c == "survey_timestamp" else S))
                  for c in SURVEY_COLUMNS])
CASE_SURVEY = struct(*[(f.name, f.dataType) for f in CASE.fields] +
                     [(f.name, f.dataType) for f in SURVEY.fields if f.name != "case_no"])

STAMP = "row_insertion_dttm"
FACT = struct(*[(f.name, f.dataType) for f in CASE_SURVEY.fields], (STAMP, TS), ("create_date", D))

FEEDBACK_COLUMNS = ["support_process_feedback", "employee_conversation_feedback",
                    "employee_technical_feedback", "referral_feedback", "overall_feedback"]
CALENDAR_ATTRS = ["date_desc", "week_day_nbr", "week_number", "week_name", "year_week_number",
                  "month_number", "month_name", "quarter_number", "quarter_name",
                  "half_year_number", "half_year_name"]
WIDE_COLUMNS = (
    ["status", "last_modified_timestamp", "case_no", "create_timestamp", "product_code",
     "country_cd", "communication_mode", "Q1", "Q3", "Q2", "Q5", "Q4", "survey_timestamp",
     "call_center_vendor", "location", "call_center_country", "category_description",
     "sub_category_description", "Priority_key", "priority", "severity", "sla_hours",
     "hours_to_close", "first_name", "last_name", "email", "gender", "ldap", "manager",
     "hire_date", "department", "brand", "commodity_desc", "sub_commodity_desc"]
    + FEEDBACK_COLUMNS + [f"case_create_{c}" for c in CALENDAR_ATTRS] + ["case_create_date"])

# Merged daily tables as produced by merge_distinct: stamp, then the date.
CASE_DLY_MERGE = struct(*[(f.name, f.dataType) for f in CASE.fields], (STAMP, TS), ("create_date", D))
SURVEY_DLY_MERGE = struct(*[(f.name, f.dataType) for f in SURVEY.fields], (STAMP, TS),
                          ("survey_date", D))
