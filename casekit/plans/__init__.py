"""Composite jobs."""

from casekit.plans.fact import (WideDims, build_fact, build_wide, latest_cases,
                                latest_surveys, score_feedback)

__all__ = ["WideDims", "build_fact", "build_wide", "latest_cases", "latest_surveys",
           "score_feedback"]
