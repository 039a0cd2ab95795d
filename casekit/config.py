"""Run configuration: table names, question-to-feedback mapping, KPI windows.

One object carries every name, so stages cannot drift apart in naming.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableNames:
    """Warehouse table names (or paths) used by the batch jobs."""
    prefix: str = "cases"
    calendar: str = "dim_calendar"
    call_center: str = "dim_call_center"
    case_category: str = "dim_case_category"
    country: str = "dim_country"
    case_priority: str = "dim_case_priority"
    employee: str = "dim_employee"
    product: str = "dim_product"
    questions: str = "dim_questions"
    case_stg: str = "case_dly_stg"
    survey_stg: str = "survey_dly_stg"
    case_incr: str = "case_dly_incr"
    survey_incr: str = "survey_dly_incr"
    case_dly: str = "case_dly"
    survey_dly: str = "survey_dly"
    fact: str = "fact_case_survey_dly"
    wide: str = "pivot_fact_case_survey_dly"

    def name(self, key: str) -> str:
        return f"{self.prefix}_{getattr(self, key)}"


# Which survey answer feeds which feedback column, and the three
# answer bands with their scores.  Q4 is free text and is never scored.
QUESTION_FEEDBACK = {
    "Q1": "support_process_feedback",
    "Q2": "employee_conversation_feedback",
    "Q3": "employee_technical_feedback",
    "Q5": "referral_feedback",
}
BANDS = (("negative_response_range", -1), ("neutral_response_range", 0),
         ("positive_response_range", 1))
SCORE_LABELS = {-1: "Negative", 0: "Neutral", 1: "Positive"}


@dataclass(frozen=True)
class KpiWindow:
    """A rolling window ending at ``as_of``; both ends inclusive."""
    label: str      # suffix used in KPI names, e.g. "Last_1HR"
    interval: str   # Spark interval literal body, e.g. "1 HOUR"


# The four windows of the KPI catalogue.
KPI_WINDOWS = (
    KpiWindow("1HR", "1 HOUR"),
    KpiWindow("1Day", "1 DAY"),
    KpiWindow("Week", "7 DAY"),
    KpiWindow("1Month", "1 MONTH"),
)
