"""SURVEY §5 layer 4: properties of the operators."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from casekit import schemas
from casekit.operators import kpi_report, kpi_statements, latest_per_key, merge_distinct
from casekit.operators.kpi import kpi_name
from casekit.plans.fact import WideDims, build_fact, build_wide
from casekit.sources import driver_views as dv

SF = "/root/testdata/sf0.001"


def _wide(spark):
    return build_wide(build_fact(dv.cases(spark, SF), dv.surveys(spark, SF), dv.AS_OF),
                      WideDims(dv.calendar(spark, SF), dv.call_center(spark, SF),
                               dv.case_category(spark), dv.case_priority(spark),
                               dv.employee(spark, SF), dv.product(spark, SF),
                               dv.survey_questions(spark)))


def test_one_pass_equals_separate_statements(spark):
    wide = _wide(spark).cache()
    one = {r.kpi: r.value for r in kpi_report(wide, dv.AS_OF).collect()}
    for name, df in kpi_statements(wide, dv.AS_OF).items():
        rows = df.collect()
        if "Response_Count" in name:
            for r in rows:
                assert one[f"{r.Response}_{name}"] == r[name]
            for label in ("Positive", "Negative"):
                if label not in {r.Response for r in rows}:
                    assert one[f"{label}_{name}"] == 0
        else:
            assert one[name] == rows[0][0], name
    assert kpi_name("total") in one
    wide.unpersist()


def test_merge_commutative_and_idempotent(spark):
    h, i = dv.case_history(spark, SF), dv.case_increment(spark, SF)
    ab = merge_distinct([h, i], schemas.CASE_DLY_MERGE, as_of=dv.AS_OF)
    ba = merge_distinct([i, h], schemas.CASE_DLY_MERGE, as_of=dv.AS_OF)
    aab = merge_distinct([ab, h, i], schemas.CASE_DLY_MERGE, as_of=dv.AS_OF)
    key = sorted(map(tuple, ab.collect()))
    assert key == sorted(map(tuple, ba.collect())) == sorted(map(tuple, aab.collect()))


rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                             st.integers(0, 3) | st.none(),
                             st.sampled_from(["x", "y"])), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st, parts=st.integers(1, 4))
def test_latest_per_key_one_row_per_key_any_order(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, t int, v string").repartition(parts)
    out = latest_per_key(df, ["k"], [("t", "desc")]).collect()
    keys = [r.k for r in out]
    assert len(keys) == len(set(keys)) == len({r[0] for r in rows})
    for r in out:
        group = [x for x in rows if x[0] == r.k]
        ts = [x[1] for x in group if x[1] is not None]
        best_t = max(ts) if ts else None
        assert r.t == best_t
        # ties broken by v ascending
        assert r.v == min(x[2] for x in group if x[1] == best_t)


fact_keys = st.lists(st.sampled_from(["1", "2", "3", "x", None]), min_size=1, max_size=20)
dim_keys = st.sets(st.integers(1, 4), max_size=4)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=fact_keys, dkeys=dim_keys)
def test_enrich_keeps_rows_matches_brute_force(spark, keys, dkeys):
    from casekit.operators import DimSpec, enrich
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k string")
    dim = spark.createDataFrame([(d, f"v{d}") for d in sorted(dkeys)] or [(0, "v0")],
                                "dk int, v string")
    out = {r.id: r.v for r in enrich(fact, [DimSpec(dim, ["k"], ["dk"], ["v"])]).collect()}
    want = {i: (f"v{int(k)}" if k is not None and k.isdigit() and int(k) in dkeys else None)
            for i, k in enumerate(keys)}
    assert out == want
