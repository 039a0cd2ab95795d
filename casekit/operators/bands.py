"""Band scoring: an answer inside a question's negative / neutral / positive
range scores -1 / 0 / 1.

The question table is reduced to one row of thresholds (two bounds per band
per question) and read by the scoring expression as a scalar subquery, so the
survey side is neither shuffled nor joined: each answer is compared with
constants.  A question listed twice makes the subquery raise at run time, as
an ambiguous definition must.  The first matching band wins; an answer in no
band, or a band that does not parse, scores NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.config import BANDS, QUESTION_FEEDBACK
from casekit.functions.sentiment import parse_range


def band_thresholds(questions: DataFrame, question_ids: Sequence[str],
                    bands: Sequence[tuple[str, int]] = BANDS) -> DataFrame:
    """One row: ``<qid>_<i>_lo`` / ``<qid>_<i>_hi`` for band ``i`` of each question.

    A question listed more than once raises when the row is computed.
    """
    parsed = questions.select("question_id", *[parse_range(c).alias(c) for c, _ in bands])
    aggs, out = [], []
    for q in question_ids:
        is_q = f"question_id = '{q}'"
        aggs.append(f"count(CASE WHEN {is_q} THEN 1 END) AS `{q}_n`")
        for i, (c, _) in enumerate(bands):
            for end in ("lo", "hi"):
                name = f"{q}_{i}_{end}"
                aggs.append(f"max(CASE WHEN {is_q} THEN {c}.{end} END) AS `{name}`")
                out.append(f"CAST(CASE WHEN `{q}_n` > 1 THEN raise_error("
                           f"'survey question {q} is defined more than once') "
                           f"ELSE `{name}` END AS INT) AS `{name}`")
    return parsed.selectExpr(*aggs).selectExpr(*out)


def score_bands(df: DataFrame, questions: DataFrame,
                mapping: Mapping[str, str] | None = None,
                answer_cols: Mapping[str, str] | None = None,
                bands: Sequence[tuple[str, int]] = BANDS) -> DataFrame:
    """Add one score column per question.

    ``mapping``      question id -> output column (default: the four feedbacks)
    ``answer_cols``  question id -> answer column (default: the id itself)
    """
    mapping = dict(mapping or QUESTION_FEEDBACK)
    answer_cols = dict(answer_cols or {q: q for q in mapping})
    qids = list(mapping)
    thresholds = band_thresholds(questions, qids, bands)
    row = thresholds.select(F.struct(*thresholds.columns).alias("t")).scalar()
    df = df.withColumn("__bands", row)
    scores = {}
    for q, out_name in mapping.items():
        ans = f"`{answer_cols[q]}`"
        whens = " ".join(
            f"WHEN {ans} BETWEEN __bands.`{q}_{i}_lo` AND __bands.`{q}_{i}_hi` THEN {score}"
            for i, (_, score) in enumerate(bands))
        scores[out_name] = F.expr(f"CAST(CASE {whens} END AS INT)")
    return df.withColumns(scores).drop("__bands")
