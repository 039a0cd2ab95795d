"""Column-level helpers built only from ``pyspark.sql.functions``."""

from casekit.functions.casting import (answer_to_int, conform, conform_checked, now_seconds,
                                       split_rejects, trunc_seconds, with_event_date,
                                       with_load_stamp)
from casekit.functions.sentiment import overall_label, parse_range, score_label
from casekit.functions.timewin import as_of_literal, hours_between, in_last

__all__ = ["answer_to_int", "conform", "conform_checked", "split_rejects", "now_seconds", "trunc_seconds",
           "with_event_date", "with_load_stamp", "overall_label", "parse_range",
           "score_label", "as_of_literal", "hours_between", "in_last"]
