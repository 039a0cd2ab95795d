"""KPI catalogue over the wide case table, and live per-batch counts.

Every KPI counts ``case_no`` under a predicate and, for most, a rolling window
ending at ``as_of`` on ``last_modified_timestamp`` (also for surveys and
responses).  ``kpi_report`` computes the whole catalogue in one scan with
conditional aggregates instead of one scan per statement.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casekit.config import KPI_WINDOWS, KpiWindow
from casekit.functions.timewin import in_last, in_last_sql

LM = "last_modified_timestamp"

# Output names of the KPI catalogue, in catalogue order, as
# (family, window label, name); a window label of None means all rows.
KPI_NAMES = [
    ("total", None, "Total_Numbers_of_Cases"),
    ("open", "1HR", "Total_Open_Cases_Last_1HR"),
    ("closed", "1HR", "Total_Closed_Cases_Last_1HR"),
    ("p1", None, "Total_Piority_1_Cases"),
    ("high", None, "Total_High_Piority_Cases"),
    ("response", "1HR", "Total_Response_Count"),
    ("surveys", "1HR", "Total_Surveys_Last_1HR"),
    ("open", "1Day", "Total_Open_Cases_Last_1Day"),
    ("open", "Week", "Total_Open_Cases_Last_Week"),
    ("open", "1Month", "Total_Open_Cases_Last_1Month"),
    ("closed", "1Day", "Total_Closed_Cases_Last_1Day"),
    ("closed", "Week", "Total_Closed_Cases_Last_Week"),
    ("closed", "1Month", "Total_Closed_Cases_Last_1Month"),
    ("response", "1Day", "Total_Response_Count_Last_1Day"),
    ("response", "Week", "Total_Response_Count_Last_1Week"),
    ("response", "1Month", "Total_Response_Count_Last_1Month"),
    ("surveys", "1Day", "Total_Surveys_Last_1Day"),
    ("surveys", "Week", "Total_Surveys_Last_1Week"),
    ("surveys", "1Month", "Total_Surveys_Last_1Month"),
]
_NAME = {(fam, win): name for fam, win, name in KPI_NAMES}


#: Columns of the wide table that the KPIs read.
KPI_COLUMNS = ["case_no", "status", "Priority_key", "priority", LM, "survey_timestamp",
               "overall_feedback"]


def kpi_name(family: str, window: str | None = None) -> str:
    """Output name of a KPI; windows outside the catalogue get a derived name."""
    return _NAME.get((family, window)) or f"Total_{family}_Last_{window}"


def _count_where(cond: str) -> Column:
    return F.expr(f"count(CASE WHEN {cond} THEN case_no END)")


def scalar_kpi_predicates(as_of: _dt.datetime | str | None,
                          windows: Sequence[KpiWindow] = KPI_WINDOWS) -> dict[str, str | None]:
    """The 15 scalar KPIs as SQL predicates over the wide table (None = all rows)."""
    k: dict[str, str | None] = {kpi_name("total"): None}
    for status in ("Open", "Closed"):
        for w in windows:
            k[kpi_name(status.lower(), w.label)] = \
                f"status = '{status}' AND {in_last_sql(LM, w.interval, as_of)}"
    k[kpi_name("p1")] = "Priority_key = 'P1'"
    k[kpi_name("high")] = "priority IN ('High', 'Highest')"
    for w in windows:
        k[kpi_name("surveys", w.label)] = \
            f"survey_timestamp IS NOT NULL AND {in_last_sql(LM, w.interval, as_of)}"
    return k


def scalar_kpis(as_of: _dt.datetime | str | None,
                windows: Sequence[KpiWindow] = KPI_WINDOWS) -> dict[str, Column]:
    """The 15 scalar KPIs as aggregate expressions, keyed by output name."""
    return {n: (F.count("case_no") if p is None else _count_where(p))
            for n, p in scalar_kpi_predicates(as_of, windows).items()}


def response_kpis(as_of, windows: Sequence[KpiWindow] = KPI_WINDOWS) -> dict[str, Column]:
    """Positive / negative response counts per window as aggregate expressions."""
    k = {}
    for label in ("Positive", "Negative"):
        for w in windows:
            cond = f"overall_feedback = '{label}' AND {in_last_sql(LM, w.interval, as_of)}"
            k[f"{label}_{kpi_name('response', w.label)}"] = \
                F.expr(f"count(CASE WHEN {cond} THEN 1 END)")
    return k


def kpi_counts(wide: DataFrame, as_of=None, windows: Sequence[KpiWindow] = KPI_WINDOWS,
               names: Sequence[str] | None = None) -> DataFrame:
    """One row of scalar KPIs (all 15, or those in ``names``), one scan."""
    k = scalar_kpis(as_of, windows)
    if names is not None:
        k = {n: k[n] for n in names}
    return wide.agg(*[c.alias(n) for n, c in k.items()])


def kpi_feedback(wide: DataFrame, as_of=None,
                 windows: Sequence[KpiWindow] = KPI_WINDOWS) -> DataFrame:
    """Positive and negative response counts per window.

    Columns ``Response``, ``window``, ``Total_Response_Count``.  As in the
    per-window GROUP BY, a class without rows in a window gives no row.  One
    scan: the rows are first cut to the union of the windows (a filter that
    reaches the scan), then counted per class with one conditional count per
    window.
    """
    any_window = " OR ".join(in_last_sql(LM, w.interval, as_of) for w in windows)
    base = wide.where(f"overall_feedback IS NOT NULL AND overall_feedback <> 'Neutral' "
                      f"AND ({any_window})")
    counts = base.groupBy(F.col("overall_feedback").alias("Response")).agg(
        *[F.expr(f"count(CASE WHEN {in_last_sql(LM, w.interval, as_of)} THEN 1 END) "
                 f"AS `{w.label}`") for w in windows])
    long = counts.unpivot("Response", [w.label for w in windows], "window",
                          "Total_Response_Count")
    return long.where(F.col("Total_Response_Count") > 0)


def kpi_report(wide: DataFrame, as_of=None,
               windows: Sequence[KpiWindow] = KPI_WINDOWS) -> DataFrame:
    """The whole catalogue in one scan, as rows ``(kpi, value)``.

    Response counts appear as ``Positive_<name>`` / ``Negative_<name>`` and are
    0 (not absent) when there is nothing to count.
    """
    k = scalar_kpis(as_of, windows)
    k.update(response_kpis(as_of, windows))
    one = wide.agg(*[c.alias(n) for n, c in k.items()])
    return one.unpivot([], list(k), "kpi", "value")


def kpi_statements(wide: DataFrame, as_of=None,
                   windows: Sequence[KpiWindow] = KPI_WINDOWS) -> dict[str, DataFrame]:
    """The catalogue as separate queries (one scan each), keyed by KPI name.

    Kept for parity checks against ``kpi_report``; prefer ``kpi_report``.
    """
    out = {n: (wide if p is None else wide.where(p)).agg(F.count("case_no").alias(n))
           for n, p in scalar_kpi_predicates(as_of, windows).items()}
    for w in windows:
        name = kpi_name("response", w.label)
        out[name] = (wide.where(F.col("overall_feedback").isNotNull()
                                & (F.col("overall_feedback") != "Neutral")
                                & in_last(LM, w.interval, as_of))
                     .groupBy(F.col("overall_feedback").alias("Response"))
                     .agg(F.count(F.lit(1)).alias(name)))
    return out


# ---------------------------------------------------------------- live KPIs

def live_status_counts(batch: DataFrame) -> DataFrame:
    """Distinct cases in total, Open and Closed: rows ``(Case_Type, Cases_numbers)``.

    Two aggregation levels instead of three DISTINCT aggregates: first one row
    per case (flags: seen Open, seen Closed; map-side combined, so a hot case
    costs nothing extra), then a global sum.  A case seen both Open and Closed
    counts in both rows and once in the total.
    """
    per_case = (batch.where(F.col("case_no").isNotNull()).groupBy("case_no")
                .agg(F.max(F.when(F.col("status") == "Open", 1).otherwise(0)).alias("o"),
                     F.max(F.when(F.col("status") == "Closed", 1).otherwise(0)).alias("c")))
    one = per_case.agg(F.count(F.lit(1)).alias("Total Cases"),
                       F.coalesce(F.sum("o"), F.lit(0)).alias("Open Cases"),
                       F.coalesce(F.sum("c"), F.lit(0)).alias("Closed Cases"))
    return one.unpivot([], ["Total Cases", "Open Cases", "Closed Cases"], "Case_Type",
                       "Cases_numbers")


def live_priority_counts(batch: DataFrame) -> DataFrame:
    """Distinct cases per (priority, severity); unmatched cases form (NULL, NULL)."""
    return batch.groupBy("priority", "severity").agg(
        F.count_distinct("case_no").alias("Cases_numbers"))


def show_kpis(df: DataFrame, n: int) -> None:
    """Print ``n`` rows in full width (only those rows reach the driver)."""
    df.show(n, truncate=False)
