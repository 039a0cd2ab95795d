"""DataFrame operators."""

from casekit.operators.bands import band_thresholds, score_bands
from casekit.operators.enrich import (DimSpec, enrich, prepare, priority_lookup,
                                      regional_lookup)
from casekit.operators.intervals import interval_index, score_answers
from casekit.operators.kpi import (kpi_counts, kpi_feedback, kpi_report, kpi_statements,
                                   live_priority_counts, live_status_counts)
from casekit.operators.merge import latest_per_key, merge_distinct

__all__ = ["band_thresholds", "score_bands", "DimSpec", "enrich", "prepare", "priority_lookup",
           "regional_lookup", "interval_index", "score_answers", "kpi_counts", "kpi_feedback",
           "kpi_report", "kpi_statements", "live_priority_counts", "live_status_counts",
           "latest_per_key", "merge_distinct"]
