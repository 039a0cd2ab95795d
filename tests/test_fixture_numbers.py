"""The expected numbers of FIXTURES.md (part B) at sf0.01."""

from pyspark.sql import functions as F

from casekit.operators import kpi_report
from casekit.plans.fact import WideDims, build_fact, build_wide
from casekit.sources import driver_views as dv

SF = "/root/testdata/sf0.01"


def test_fixture_numbers(spark):
    fact = build_fact(dv.cases(spark, SF), dv.surveys(spark, SF), dv.AS_OF).cache()
    assert fact.count() == 14743
    assert fact.where("survey_id IS NOT NULL").count() == 4902
    wide = build_wide(fact, WideDims(
        dv.calendar(spark, SF), dv.call_center(spark, SF), dv.case_category(spark),
        dv.case_priority(spark), dv.employee(spark, SF), dv.product(spark, SF),
        dv.survey_questions(spark))).cache()
    count_by = lambda c: {r[0]: r[1] for r in wide.groupBy(c).count().collect()}
    assert count_by("priority") == {"Highest": 2074, "High": 4169, "Medium": 4284, None: 4216}
    assert count_by("status") == {"Open": 7400, "Closed": 7343}
    assert count_by("overall_feedback") == {"Positive": 912, "Neutral": 843, "Negative": 2386,
                                            None: 10602}
    k = {r.kpi: r.value for r in kpi_report(wide, dv.AS_OF).collect()}
    expected = {  # window: (open, closed, with survey)
        "1HR": (8, 19, 13), "1Day": (19, 34, 21), "Week": (85, 92, 75),
        "1Month": (371, 365, 249)}
    names = {"1HR": ("Last_1HR", "Last_1HR"), "1Day": ("Last_1Day", "Last_1Day"),
             "Week": ("Last_Week", "Last_1Week"), "1Month": ("Last_1Month", "Last_1Month")}
    for w, (o, c, s) in expected.items():
        case_w, survey_w = names[w]
        assert (k[f"Total_Open_Cases_{case_w}"], k[f"Total_Closed_Cases_{case_w}"],
                k[f"Total_Surveys_{survey_w}"]) == (o, c, s), w
    assert dv.calendar(spark, SF).count() == 2399
    assert dv.call_center(spark, SF).count() == 100
    assert wide.select(F.max("last_modified_timestamp")).first()[0] == dv.AS_OF
    fact.unpersist()
    wide.unpersist()
