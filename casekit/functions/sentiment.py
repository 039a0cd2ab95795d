"""Answer bands and feedback labels.

A band is written ``"lo-hi"`` (``"0-4"``, ``"8-10"``, ``"10-10"``); anything
else (``"n/a"``, NULL, a missing bound) is a band that matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casekit.config import SCORE_LABELS


def parse_range(c: Column | str) -> Column:
    """``"lo-hi"`` -> struct<lo:int, hi:int>; both NULL when it does not parse."""
    c = F.col(c) if isinstance(c, str) else c
    parts = F.split(F.trim(c), "-")
    ok = F.size(parts) == 2
    lo = F.when(ok, F.get(parts, 0).try_cast("int"))
    hi = F.when(ok, F.get(parts, 1).try_cast("int"))
    return F.struct(lo.alias("lo"), hi.alias("hi"))


def score_label(score: Column | str) -> Column:
    """-1 / 0 / 1 -> Negative / Neutral / Positive; anything else NULL."""
    if isinstance(score, str):
        whens = " ".join(f"WHEN `{score}` = {v} THEN '{lab}'" for v, lab in SCORE_LABELS.items())
        return F.expr(f"CASE {whens} END")
    out = F.lit(None).cast("string")
    for value, label in SCORE_LABELS.items():
        out = F.when(score == value, label).otherwise(out)
    return out


def overall_label(*scores: Column | str) -> Column:
    """Sign of the sum of the scores; NULL when any score is NULL."""
    if all(isinstance(s, str) for s in scores):
        t = " + ".join(f"`{s}`" for s in scores)
        return F.expr(f"CASE WHEN {t} > 0 THEN 'Positive' WHEN {t} = 0 THEN 'Neutral' "
                      f"WHEN {t} < 0 THEN 'Negative' END")
    total = None
    for s in scores:
        c = F.col(s) if isinstance(s, str) else s
        total = c if total is None else total + c
    return (F.when(total > 0, "Positive").when(total == 0, "Neutral")
            .when(total < 0, "Negative"))
