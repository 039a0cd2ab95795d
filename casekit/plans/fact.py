"""Fact and wide-table builds.

``build_fact``: latest version of every case, left-joined to the latest
survey of that case.  Both sides are reduced to one row per ``case_no`` by a
window partitioned on ``case_no``; the join then reuses that partitioning
(no further exchange) and, with one row per key on each side, cannot fan out
however skewed the keys were.

``build_wide``: the fact joined to its dimensions, with survey answers scored
into feedback bands, an overall feedback and the hours to close.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit import schemas
from casekit.config import QUESTION_FEEDBACK
from casekit.functions.casting import conform, trunc_seconds, with_load_stamp
from casekit.functions.sentiment import overall_label, score_label
from casekit.functions.timewin import hours_between
from casekit.operators.bands import score_bands
from casekit.operators.enrich import DEFAULT_BROADCAST_BYTES, DimSpec, enrich, priority_lookup
from casekit.operators.merge import latest_per_key


def latest_cases(cases: DataFrame) -> DataFrame:
    """Newest version per case (timestamps cut to whole seconds).

    Two versions in the same second are told apart by their original
    sub-second time (the newer wins), then by the other columns in order.
    """
    c = conform(cases, schemas.CASE).withColumn("__raw_ts", F.col("last_modified_timestamp"))
    c = c.withColumns({"last_modified_timestamp": trunc_seconds("last_modified_timestamp"),
                       "create_timestamp": trunc_seconds("create_timestamp")})
    return latest_per_key(c, ["case_no"], [("last_modified_timestamp", "desc"),
                                           ("__raw_ts", "desc")]).drop("__raw_ts")


def latest_surveys(surveys: DataFrame) -> DataFrame:
    """Newest survey per case (timestamps cut to whole seconds).

    Same-second surveys are told apart by their original sub-second time,
    then by survey id and the answers.
    """
    s = conform(surveys, schemas.SURVEY).withColumn("__raw_ts", F.col("survey_timestamp"))
    s = s.withColumn("survey_timestamp", trunc_seconds("survey_timestamp"))
    return latest_per_key(s, ["case_no"], [("survey_timestamp", "desc"), ("__raw_ts", "desc")],
                          tiebreak=["survey_id", "Q1", "Q3", "Q2", "Q5", "Q4"]).drop("__raw_ts")


def build_fact(cases: DataFrame, surveys: DataFrame,
               as_of: _dt.datetime | str | None = None) -> DataFrame:
    """One row per case: latest case version ⟕ latest survey, stamped."""
    c = latest_cases(cases)
    s = latest_surveys(surveys)
    j = c.join(s, "case_no", "left")
    j = with_load_stamp(j, as_of=as_of, name=schemas.STAMP)
    j = j.withColumn("create_date", F.col("create_timestamp").cast("date"))
    return j.select(*schemas.FACT.fieldNames())


@dataclass
class WideDims:
    calendar: DataFrame
    call_center: DataFrame
    case_category: DataFrame
    case_priority: DataFrame
    employee: DataFrame
    product: DataFrame
    questions: DataFrame


def wide_dim_specs(dims: WideDims, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                   on_duplicate: str = "error") -> list[DimSpec]:
    """The five lookups of the wide table, in the order the columns appear."""
    cat = priority_lookup(dims.case_category, dims.case_priority, how="left")
    common = dict(max_broadcast_bytes=max_broadcast_bytes, on_duplicate=on_duplicate)
    return [
        DimSpec(dims.calendar, left=[F.col("create_timestamp").cast("date")],
                right=["calendar_date"], columns=schemas.CALENDAR_ATTRS,
                prefix="case_create_", name="calendar", **common),
        DimSpec(dims.call_center, left=["call_center_id"], right=["call_center_id"],
                columns=["call_center_vendor", "location", "country"],
                rename={"country": "call_center_country"}, name="call_center", **common),
        DimSpec(cat, left=["category", "sub_category"],
                right=["category_key", "sub_category_key"],
                columns=["category_description", "sub_category_description", "Priority_key",
                         "priority", "severity", "SLA"],
                rename={"SLA": "sla_hours"}, name="case_category", **common),
        DimSpec(dims.employee, left=["created_employee_key"], right=["emp_key"],
                columns=["first_name", "last_name", "email", "gender", "ldap", "manager",
                         "hire_date"], name="employee", **common),
        DimSpec(dims.product, left=["product_code"], right=["product_id"],
                columns=["department", "brand", "commodity_desc", "sub_commodity_desc"],
                name="product", **common),
    ]


def score_feedback(df: DataFrame, questions: DataFrame,
                   mapping: dict | None = None) -> DataFrame:
    """Scores per question, their labels and the overall label."""
    mapping = dict(mapping or QUESTION_FEEDBACK)
    scored = score_bands(df, questions, mapping)
    outs = list(mapping.values())
    return scored.withColumns({
        "overall_feedback": overall_label(*outs),
        **{o: score_label(o) for o in outs},
    })


def build_wide(fact: DataFrame, dims: WideDims,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
               on_duplicate: str = "error",
               columns: Sequence[str] | None = None) -> DataFrame:
    """Fact ⟕ calendar, call centre, category/priority, employee, product;
    answers scored; hours to close for closed cases.

    ``columns`` names the columns that the caller needs: a dimension (or the
    question table) that brings none of them is neither read nor measured.
    """
    need = list(schemas.WIDE_COLUMNS if columns is None else columns)
    unknown = set(need) - set(schemas.WIDE_COLUMNS)
    if unknown:
        raise ValueError(f"not columns of the wide table: {sorted(unknown)}")
    base = fact.withColumn(
        "hours_to_close",
        F.when(F.col("status") == "Closed",
               hours_between("create_timestamp", "last_modified_timestamp")))
    specs = []
    for spec in wide_dim_specs(dims, max_broadcast_bytes, on_duplicate):
        used = [c for c in spec.columns if spec.prefix + spec.rename.get(c, c) in need]
        if used:
            specs.append(replace(spec, columns=used))
    out = enrich(base, specs) if specs else base
    if {"overall_feedback", *QUESTION_FEEDBACK.values()} & set(need):
        out = score_feedback(out, dims.questions)
    return out.withColumn("case_create_date", F.col("create_date")).select(*need)
