"""DuckDB SQL for the benchmark-table views (the correctness oracle).

Independent SQL formulation of the case/survey views and jobs: answer bands
come from a table of parsed bounds joined per question, and every KPI is its
own statement.  Only fixed literal values are shared with the library.
"""

from __future__ import annotations

from casekit.sources import driver_views as dv

AS_OF_SQL = "TIMESTAMP '2001-11-04 00:00:00'"

CASE_ORDER = ["status", "category", "sub_category", "create_timestamp", "created_employee_key",
              "call_center_id", "product_code", "country_cd", "communication_mode"]


def _values(rows, cols):
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


def _category_rows():
    rows = []
    for flag, desc in dv.CATEGORY_FLAGS.items():
        for digit in range(4):
            sub = f"{flag}{digit}"
            if sub not in dv.MISSING_SUB_CATEGORIES:
                rows.append((flag, sub, desc, f"{desc} {digit}", f"P{digit + 1}"))
    return rows


def _question_rows():
    return [(q, d, "rating", "0-10", dv.NEGATIVE_RANGE, dv.NEUTRAL_RANGE, dv.POSITIVE_RANGE)
            for q, d in dv.QUESTIONS]


# question id -> (alias of its bounds row, answer column, score column)
SCORED = [("Q1", "qb1", "support_process_feedback"),
          ("Q2", "qb2", "employee_conversation_feedback"),
          ("Q3", "qb3", "employee_technical_feedback"),
          ("Q5", "qb5", "referral_feedback")]


def score_sql(q, answer=None, bounds=None):
    """Score of one answer against the bounds row aliased ``bounds``."""
    a = answer or q
    b = bounds or dict((x, y) for x, y, _ in SCORED)[q]
    return (f"CASE WHEN {a} BETWEEN {b}.neg_lo AND {b}.neg_hi THEN -1 "
            f"WHEN {a} BETWEEN {b}.neu_lo AND {b}.neu_hi THEN 0 "
            f"WHEN {a} BETWEEN {b}.pos_lo AND {b}.pos_hi THEN 1 END")


def scored(source, alias="src", answer_prefix=None):
    """``SELECT <alias>.*, <four scores> FROM source`` with the bounds joined."""
    pre = answer_prefix or alias
    cols = ", ".join(f"{score_sql(q, f'{pre}.{q}', b)} AS {name}" for q, b, name in SCORED)
    joins = " ".join(f"LEFT JOIN band_bounds {b} ON {b}.question_id = '{q}'"
                     for q, b, _ in SCORED)
    return f"SELECT {alias}.*, {cols} FROM {source} {alias} {joins}"


def label_sql(x):
    return (f"CASE WHEN {x} = -1 THEN 'Negative' WHEN {x} = 0 THEN 'Neutral' "
            f"WHEN {x} = 1 THEN 'Positive' ELSE NULL END")


def overall_sql(a, b, c, d):
    s = f"{a} + {b} + {c} + {d}"
    return (f"CASE WHEN {s} > 0 THEN 'Positive' WHEN {s} = 0 THEN 'Neutral' "
            f"WHEN {s} < 0 THEN 'Negative' ELSE NULL END")


def newest_case(source):
    """One row per case: QUALIFY on the whole-second time, then the exact one."""
    exact = {"create_timestamp": "date_trunc('second', create_timestamp)"}
    ties = ", ".join(f"{exact.get(c, c)} NULLS LAST" for c in CASE_ORDER)
    return f"""SELECT status, category, sub_category,
         date_trunc('second', last_modified_timestamp) AS last_modified_timestamp, case_no,
         date_trunc('second', create_timestamp) AS create_timestamp, created_employee_key,
         call_center_id, product_code, country_cd, communication_mode
  FROM ({source})
  QUALIFY row_number() OVER (PARTITION BY case_no ORDER BY last_modified_timestamp
    DESC NULLS LAST, {ties}) = 1"""


def newest_survey(source):
    return f"""SELECT Q1, Q3, Q2, Q5, Q4, case_no,
         date_trunc('second', survey_timestamp) AS survey_timestamp, survey_id
  FROM ({source})
  QUALIFY row_number() OVER (PARTITION BY case_no ORDER BY survey_timestamp DESC NULLS LAST,
    survey_id NULLS LAST, Q1 NULLS LAST, Q3 NULLS LAST, Q2 NULLS LAST, Q5 NULLS LAST,
    Q4 NULLS LAST) = 1"""


def fact_sql(cases, surveys):
    """Newest cases with their newest survey, if any."""
    return f"""SELECT c.*, s.* EXCLUDE (case_no), {AS_OF_SQL} AS row_insertion_dttm,
         CAST(c.create_timestamp AS DATE) AS create_date
  FROM {cases} c LEFT JOIN {surveys} s ON s.case_no = c.case_no"""


VIEWS = {
    "cases": """
  SELECT CASE WHEN l.l_linestatus = 'O' THEN 'Open' ELSE 'Closed' END AS status,
         l.l_returnflag AS category,
         l.l_returnflag || CAST(l.l_linenumber % 4 AS VARCHAR) AS sub_category,
         l.l_shipdate AS last_modified_timestamp,
         CAST(l.l_orderkey AS VARCHAR) AS case_no,
         o.o_orderdate AS create_timestamp,
         CAST(o.o_custkey AS VARCHAR) AS created_employee_key,
         CAST(l.l_suppkey AS VARCHAR) AS call_center_id,
         CAST(l.l_partkey AS VARCHAR) AS product_code,
         'US' AS country_cd,
         o.o_orderpriority AS communication_mode
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "case_hist": f"""
  SELECT CAST(status AS VARCHAR) AS status, category, sub_category,
         strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S') AS last_modified_timestamp,
         case_no, strftime(create_timestamp, '%Y-%m-%d %H:%M:%S') AS create_timestamp,
         created_employee_key, call_center_id, product_code, country_cd, communication_mode
  FROM cases WHERE last_modified_timestamp < TIMESTAMP '{dv.CASE_HISTORY_BEFORE}'""",
    "case_incr": f"""
  SELECT * FROM cases WHERE last_modified_timestamp >= TIMESTAMP '{dv.CASE_INCR_FROM}'""",
    "surveys": """
  SELECT CAST(floor(value) % 11 AS INTEGER) AS Q1,
         CAST(event_id % 13 AS INTEGER) AS Q3,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 11 AS Q2,
         CAST(user_id % 11 AS INTEGER) AS Q5,
         event_type AS Q4,
         CAST(event_id // 2 AS VARCHAR) AS case_no,
         ts AS survey_timestamp,
         CAST(event_id AS VARCHAR) AS survey_id
  FROM events""",
    "survey_hist": f"""
  SELECT CAST(Q1 AS VARCHAR) AS Q1, CAST(Q3 AS VARCHAR) AS Q3, CAST(Q2 AS VARCHAR) AS Q2,
         CAST(Q5 AS VARCHAR) AS Q5, Q4, case_no,
         strftime(survey_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS survey_timestamp, survey_id
  FROM surveys WHERE survey_timestamp < TIMESTAMP '{dv.SURVEY_HISTORY_BEFORE}'""",
    "survey_incr": f"""
  SELECT * FROM surveys WHERE survey_timestamp >= TIMESTAMP '{dv.SURVEY_INCR_FROM}'""",
    "case_text": """
  SELECT * REPLACE (strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S')
                    AS last_modified_timestamp,
                    strftime(create_timestamp, '%Y-%m-%d %H:%M:%S') AS create_timestamp)
  FROM cases""",
    "case_latest": newest_case("SELECT * FROM cases"),
    "survey_latest": newest_survey("SELECT * FROM surveys"),
    "fact": fact_sql("case_latest", "survey_latest"),
    "calendar": """
  SELECT d AS calendar_date, strftime(d, '%Y-%m-%d') AS date_desc,
         CAST(dayofweek(d) + 1 AS INTEGER) AS week_day_nbr,
         CAST(weekofyear(d) AS INTEGER) AS week_number,
         'Week ' || CAST(weekofyear(d) AS VARCHAR) AS week_name,
         CAST(year(d) * 100 + weekofyear(d) AS INTEGER) AS year_week_number,
         CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
         CAST(quarter(d) AS INTEGER) AS quarter_number,
         'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
         CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS half_year_number,
         'H' || CASE WHEN month(d) <= 6 THEN '1' ELSE '2' END AS half_year_name,
         'US' AS geo_region_cd
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x""",
    "call_center": """
  SELECT CAST(s_suppkey AS VARCHAR) AS call_center_id, s_name AS call_center_vendor,
         n_name AS location, r_name AS country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "employee": """
  SELECT CAST(c_custkey AS INTEGER) AS emp_key, c_name AS first_name,
         'Nation' || CAST(c_nationkey AS VARCHAR) AS last_name,
         'emp' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         'emp' || CAST(c_custkey AS VARCHAR) AS ldap,
         CAST(DATE '1990-01-01' + CAST(c_custkey % 3650 AS INTEGER) AS DATE) AS hire_date,
         c_mktsegment AS manager
  FROM customer""",
    "product": """
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS department, p_brand AS brand,
         p_name AS commodity_desc, CAST(p_size AS VARCHAR) AS sub_commodity_desc
  FROM part""",
    "case_category": _values(_category_rows(), ["category_key", "sub_category_key",
                                                "category_description",
                                                "sub_category_description", "priority"]),
    "case_priority": _values(dv.PRIORITIES, ["Priority_key", "priority", "severity", "SLA"]),
    "survey_question": _values(_question_rows(), [
        "question_id", "question_desc", "response_type", "range", "negative_response_range",
        "neutral_response_range", "positive_response_range"]),
    "cat_pri_left": """
  SELECT cat.category_key, cat.sub_category_key, cat.category_description,
         cat.sub_category_description, pri.Priority_key, pri.priority, pri.severity, pri.SLA
  FROM case_category cat LEFT JOIN case_priority pri ON pri.Priority_key = cat.priority""",
    "cat_pri_inner": """
  SELECT cat.category_key, cat.sub_category_key, cat.category_description,
         cat.sub_category_description, pri.Priority_key, pri.priority, pri.severity, pri.SLA
  FROM case_category cat JOIN case_priority pri ON pri.Priority_key = cat.priority""",
    "band_bounds": """
  SELECT question_id,
         TRY_CAST(split_part(negative_response_range, '-', 1) AS INTEGER) AS neg_lo,
         TRY_CAST(split_part(negative_response_range, '-', 2) AS INTEGER) AS neg_hi,
         TRY_CAST(split_part(neutral_response_range, '-', 1) AS INTEGER) AS neu_lo,
         TRY_CAST(split_part(neutral_response_range, '-', 2) AS INTEGER) AS neu_hi,
         TRY_CAST(split_part(positive_response_range, '-', 1) AS INTEGER) AS pos_lo,
         TRY_CAST(split_part(positive_response_range, '-', 2) AS INTEGER) AS pos_hi
  FROM survey_question""",
    "fact_scored": scored("fact", "fs"),
    "wide": f"""
  SELECT fs.status, fs.last_modified_timestamp, fs.case_no, fs.create_timestamp,
         fs.product_code, fs.country_cd, fs.communication_mode,
         fs.Q1, fs.Q3, fs.Q2, fs.Q5, fs.Q4, fs.survey_timestamp,
         ctr.call_center_vendor, ctr.location, ctr.country AS call_center_country,
         cp.category_description, cp.sub_category_description, cp.Priority_key, cp.priority,
         cp.severity, cp.SLA AS sla_hours,
         CASE WHEN fs.status = 'Closed' THEN (epoch(fs.last_modified_timestamp)
              - epoch(fs.create_timestamp)) / 3600 END AS hours_to_close,
         emp.first_name, emp.last_name, emp.email, emp.gender, emp.ldap, emp.manager,
         emp.hire_date, prod.department, prod.brand, prod.commodity_desc,
         prod.sub_commodity_desc,
         {label_sql('fs.support_process_feedback')} AS support_process_feedback,
         {label_sql('fs.employee_conversation_feedback')} AS employee_conversation_feedback,
         {label_sql('fs.employee_technical_feedback')} AS employee_technical_feedback,
         {label_sql('fs.referral_feedback')} AS referral_feedback,
         {overall_sql('fs.support_process_feedback', 'fs.employee_conversation_feedback',
                      'fs.employee_technical_feedback', 'fs.referral_feedback')}
           AS overall_feedback,
         cal.date_desc AS case_create_date_desc, cal.week_day_nbr AS case_create_week_day_nbr,
         cal.week_number AS case_create_week_number, cal.week_name AS case_create_week_name,
         cal.year_week_number AS case_create_year_week_number,
         cal.month_number AS case_create_month_number, cal.month_name AS case_create_month_name,
         cal.quarter_number AS case_create_quarter_number,
         cal.quarter_name AS case_create_quarter_name,
         cal.half_year_number AS case_create_half_year_number,
         cal.half_year_name AS case_create_half_year_name,
         fs.create_date AS case_create_date
  FROM fact_scored fs
  LEFT JOIN calendar cal ON cal.calendar_date = CAST(fs.create_timestamp AS DATE)
  LEFT JOIN call_center ctr ON ctr.call_center_id = fs.call_center_id
  LEFT JOIN cat_pri_left cp ON cp.category_key = fs.category
                            AND cp.sub_category_key = fs.sub_category
  LEFT JOIN employee emp ON emp.emp_key = TRY_CAST(fs.created_employee_key AS INTEGER)
  LEFT JOIN product prod ON prod.product_id = fs.product_code""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with every view as a CTE (DuckDB skips unused ones)."""
    ctes = ",\n".join(f"{name} AS ({body}\n)" for name, body in VIEWS.items())
    return f"WITH {ctes}\n{sql}"


def in_last_sql(interval: str, col: str = "last_modified_timestamp") -> str:
    return f"{col} BETWEEN {AS_OF_SQL} - INTERVAL {interval} AND {AS_OF_SQL}"
