"""Interval lookup, checked conversion, regional lookup, probe of dimension sizes."""

import random

import pytest
from pyspark.sql import functions as F

from casekit import schemas
from casekit.functions import conform, conform_checked, split_rejects
from casekit.operators import DimSpec, enrich, interval_index, regional_lookup, score_answers
from casekit.operators.enrich import probe_bytes

BANDS = "question string, lo int, hi int, score int, rank int"
ANSWERS = "id long, question string, answer int, score string"


def first_match(bands, question, answer):
    hits = [(rank, score) for q, lo, hi, score, rank in bands
            if None not in (q, lo, hi, answer) and q == question and lo <= answer <= hi]
    return min(hits)[1] if hits else None


@pytest.mark.parametrize("forced", [64 << 20, 0])
def test_first_band_wins_against_brute_force(spark, forced):
    rng = random.Random(8)
    bands = []
    for rank in range(300):                                  # hundreds of overlapping bands
        lo = rng.randint(-500, 500)
        bands.append((rng.choice("ab"), lo, lo + rng.choice([0, 1, 5, 40, 900]), rng.randint(-9, 9), rank))
    bands += [("a", 5, 4, 99, -1), ("a", None, 9, 99, -1), ("b", 3, None, 99, -1), (None, 0, 9, 99, -1),
              ("one", 7, 7, 1, 0), ("tie", 0, 9, 5, 3), ("tie", 4, 20, 2, 3)]
    asked = [(k, rng.choice(["a", "a", "a", "b", "one", "tie", "none", None]), rng.choice([None, *range(-600, 1500)]), "x")
             for k in range(4000)] + [(9000 + k, q, v, "x") for k, (q, v) in enumerate(
                 [("one", 6), ("one", 7), ("one", 8), ("tie", 3), ("tie", 4), ("tie", 9), ("tie", 10), ("tie", 21)])]
    got = score_answers(spark.createDataFrame(asked, ANSWERS), spark.createDataFrame(bands, BANDS),
                        out="found", max_broadcast_bytes=forced)
    assert got.columns == ["id", "question", "answer", "score", "found"]
    assert {r.id: r.found for r in got.collect()} == {k: first_match(bands, q, v) for k, q, v, _ in asked}


def test_index_is_sorted_and_joined_by_equality(spark):
    bands = spark.createDataFrame([("q", 0, 9, 1, 0), ("q", 5, 20, 2, 1), ("q", 30, 30, 3, 2)], BANDS)
    (row,) = interval_index(bands).collect()
    assert row.bounds == [0, 5, 10, 21, 30, 31] and row.scores == [1, 1, 2, None, 3, None]
    plan = score_answers(spark.createDataFrame([], ANSWERS), bands, out="s")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = score_answers(spark.createDataFrame([(1, "q", 5, "x")], ANSWERS), bands.limit(0), out="s")
    assert [r.s for r in none.collect()] == [None]


def test_checked_conversion(spark):
    text = schemas.struct(*[(n, schemas.S) for n in ("b", "a", "t", "extra")])
    given = spark.createDataFrame([("5.0", "x", "2020-01-01 00:00:00", "k1"), ("5.5", None, "later", "k2"),
                                   (None, "", None, "k3"), ("n/a", "y", "2020-13-01", "k4")], text)
    target = schemas.struct(("a", schemas.S), ("b", schemas.I), ("t", schemas.TS))
    checked = conform_checked(given, target, keep=("extra",))
    assert [tuple(r)[:3] for r in checked.collect()] == [tuple(r) for r in conform(given, target).collect()]
    good, bad = split_rejects(checked, "extra")
    assert sorted(r.extra for r in good.collect()) == ["k1", "k3"] and "rejected" not in good.columns
    assert sorted(map(tuple, bad.collect())) == [("k2", "b", "5.5"), ("k2", "t", "later"),
                                                 ("k4", "b", "n/a"), ("k4", "t", "2020-13-01")]
    typed, none = split_rejects(conform_checked(given, text), ["extra"])
    assert typed.count() == 4 and none.count() == 0
    with pytest.raises(ValueError):
        conform_checked(given, schemas.struct(("missing", schemas.I)))


def test_regional_lookup(spark):
    cal = spark.createDataFrame([("2020-01-01", "US", "us1"), ("2020-01-01", "EU", None), ("2020-01-02", "US", "us2"),
                                 ("2020-01-03", "EU", "eu3"), (None, "US", "n")], "d string, r string, name string")
    fact = spark.createDataFrame([(1, "2020-01-01", "EU"), (2, "2020-01-01", "US"), (3, "2020-01-01", None),
                                  (4, "2020-01-02", "EU"), (5, "2020-01-03", "EU"), (6, "2020-01-03", "US"),
                                  (7, None, "US"), (1, "2020-01-01", "EU")], "id int, d string, r string")
    got = regional_lookup(fact, cal, "d", "r", "d", "r", ["name"], "US", prefix="p_")
    assert got.columns == ["id", "d", "r", "p_name"]
    assert sorted((r.id, r.p_name or "") for r in got.collect()) == [
        (1, ""), (1, ""), (2, "us1"), (3, "us1"), (4, "us2"), (5, "eu3"), (6, ""), (7, "")]
    twice = cal.unionByName(cal.where("name = 'us2'"))
    with pytest.raises(Exception, match="more than once"):
        regional_lookup(fact, twice, "d", "r", "d", "r", ["name"], "US").collect()


def test_probe_gathers_nothing(spark):
    big = spark.range(0, 500_000, numPartitions=16).select("id", F.col("id").cast("string").alias("s"))
    row = "16 + 8 + 8 + coalesce(octet_length(s), 0)"
    size = big.selectExpr(f"sum({row})").first()[0]
    assert probe_bytes([(big, size), (big, size - 1), (big.limit(0), 0)]) == [True, False, True]
    import inspect
    assert ".limit(" not in inspect.getsource(probe_bytes)
    joined = enrich(spark.range(5).select(F.col("id").alias("k")),
                    [DimSpec(big, left=["k"], right=["id"], columns=["s"], max_broadcast_bytes=1000)])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan and sorted(r.s for r in joined.collect()) == list("01234")
