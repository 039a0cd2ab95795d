"""Atomic refresh, landing compaction, incremental merge and incremental latest rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casekit import schemas
from casekit.functions import with_event_date
from casekit.operators import merge_distinct
from casekit.plans import incremental as inc
from casekit.plans.fact import build_fact, latest_cases, latest_surveys
from casekit.plans.jobs import Warehouse, merge_history, refresh_history
from casekit.sources import driver_views as dv
from casekit.sources import landing
from casekit.sources.versions import BucketedTable, VersionedTable
from casekit.streaming.live import replace_batch

SF = "/root/testdata/sf0.001"
AS_OF = dv.AS_OF
LO, HI = dt.datetime(1996, 1, 1), dt.datetime(1996, 2, 15)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------- atomic refresh

def test_a_failed_write_leaves_the_old_table(spark, tmp_dir):
    table = VersionedTable(spark, f"{tmp_dir}/t")
    assert table.current() is None
    table.replace(spark.range(5), [])
    broken = spark.range(100).withColumn("id", F.when(F.col("id") < 60, F.col("id")).otherwise(
        F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert rows(table.read()) == [(k,) for k in range(5)]
    held = table.read()                                   # a reader that started before
    table.replace(spark.range(7, 9))
    assert rows(table.read()) == [(7,), (8,)] and rows(held) == [(k,) for k in range(5)]
    table.replace(spark.range(1))
    assert table.vacuum(keep=1) == 2 and rows(table.read()) == [(0,)]


def test_a_failed_job_leaves_the_merged_table(spark, tmp_dir, monkeypatch):
    wh = Warehouse(f"{tmp_dir}/wh", by_date=False)
    good = dv.case_history(spark, SF).limit(50)
    refresh_history(with_event_date(good, "create_timestamp", "create_date"), wh, "case_stg", AS_OF)
    refresh_history(with_event_date(dv.survey_history(spark, SF).limit(9), "survey_timestamp", "survey_date"),
                    wh, "survey_stg", AS_OF)
    merge_history(spark, wh, AS_OF, increments=False)
    before = rows(wh.read(spark, "case_dly"))

    def die(self, number, folder, buckets=None):
        raise RuntimeError("killed before the switch")
    monkeypatch.setattr(VersionedTable, "switch", die)
    with pytest.raises(RuntimeError):
        merge_history(spark, wh, AS_OF, increments=False)
    assert rows(wh.read(spark, "case_dly")) == before


def test_catalog_table_is_replaced_by_a_second_one(spark, tmp_dir):
    from casekit.sources.tables import replace_catalog_table
    name = "t_swap_" + tmp_dir[-12:]
    schema = schemas.struct(("id", schemas.I), ("day", schemas.D), ("note", schemas.S))
    df = spark.range(4).select(F.col("id").cast("int").alias("id"), F.lit(None).cast("string").alias("note"),
                               F.lit("2020-01-02").cast("date").alias("day"))
    replace_catalog_table(df, name, schema, ["day"])
    broken = df.withColumn("id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        replace_catalog_table(broken, name, schema, ["day"])
    assert spark.table(name).columns == ["id", "note", "day"] and spark.table(name).count() == 4
    replace_catalog_table(df.where("id < 2"), name, schema, ["day"])
    assert spark.table(name).count() == 2


# ---------------------------------------------------------- landing compaction

def _landed(spark, path, batches=5):
    cases = dv.cases(spark, SF)
    for b in range(batches):
        replace_batch(cases.where(F.col("case_no").cast("long") % batches == b).repartition(4), path, b)
    return cases


def test_compaction_changes_files_not_rows(spark, tmp_dir):
    path = f"{tmp_dir}/live/cases"
    cases = _landed(spark, path)
    want, files = rows(cases), len(spark.read.parquet(path).inputFiles())
    assert landing.compact_landing(spark, path) == 3
    read = landing.read_landed(spark, path, schemas.CASE)
    read_from = landing.landed_rows(spark, path).select(F.input_file_name()).distinct().count()
    assert rows(read) == want and files == 20 and read_from <= 6       # one batch loose, three packed
    assert landing.newest_batch(spark, path) == 4
    for after in (None, 0, 2, 3, 4):
        got = landing.read_landed(spark, path, schemas.CASE, after_batch=after)
        assert got.count() == cases.where(F.col("case_no").cast("long") % 5 > (-1 if after is None else after)).count()
    assert landing.compact_landing(spark, path) is None           # nothing new
    replace_batch(cases.limit(10), path, 5)
    replace_batch(cases.limit(3), path, 6)
    assert landing.compact_landing(spark, path, remove=True) == 5
    left = landing.landed_rows(spark, path).groupBy("batch_id").count().collect()
    assert {r.batch_id for r in left} == set(range(7)) and sum(r["count"] for r in left) == len(want) + 13
    assert {r.batch_id for r in spark.read.parquet(path).select("batch_id").distinct().collect()} == {6}
    assert landing.read_landed(spark, f"{tmp_dir}/none", schemas.CASE).count() == 0


def test_a_killed_compaction_loses_nothing(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/live/cases"
    want = rows(_landed(spark, path))

    def die(*args):
        raise RuntimeError("killed before the manifest")
    monkeypatch.setattr(landing, "append_small", die)
    with pytest.raises(RuntimeError):
        landing.compact_landing(spark, path)
    monkeypatch.undo()
    assert rows(landing.read_landed(spark, path, schemas.CASE)) == want
    assert landing.compact_landing(spark, path, remove=True) == 3
    assert rows(landing.read_landed(spark, path, schemas.CASE)) == want


# ------------------------------------------------------------ incremental merge

def _quarter(df, col):
    return df.where((F.col(col) >= F.lit(LO)) & (F.col(col) < F.lit(HI)))


def _warehouse(spark, tmp_dir):
    wh = Warehouse(f"{tmp_dir}/wh")
    cases = _quarter(dv.cases(spark, SF), "create_timestamp")
    surveys = dv.surveys(spark, SF).where(F.col("survey_timestamp") < F.lit(dt.datetime(2024, 1, 9)))
    c_hist = cases.where(F.col("product_code").cast("long") % 4 < 3)
    s_hist = surveys.where(F.col("survey_id").cast("long") % 4 < 3)
    refresh_history(with_event_date(c_hist, "create_timestamp", "create_date"), wh, "case_stg", AS_OF)
    refresh_history(with_event_date(s_hist, "survey_timestamp", "survey_date"), wh, "survey_stg", AS_OF)
    merge_history(spark, wh, AS_OF, increments=False)
    return wh, cases, surveys, c_hist, s_hist


def test_two_increments_equal_the_full_rebuild(spark, tmp_dir, monkeypatch):
    wh, cases, surveys, c_hist, s_hist = _warehouse(spark, tmp_dir)
    sinks = wh.landing()
    # rows that are there already come again; rows come twice; a null date; then new ones
    one = cases.where(F.col("product_code").cast("long") % 4 >= 2)
    null = cases.limit(2).withColumn("create_timestamp", F.lit(None).cast("timestamp_ntz"))
    two = cases.where(F.col("product_code").cast("long") % 3 == 0).unionByName(null).unionByName(null)
    replace_batch(one, sinks.cases, 0)
    replace_batch(surveys.where(F.col("survey_id").cast("long") % 2 == 1), sinks.surveys, 0)
    assert inc.merge_increment(spark, wh, AS_OF) == {"cases": 0, "surveys": 0}
    replace_batch(two, sinks.cases, 1)
    # killed after the append and before the ledger: the next run adds nothing twice
    with monkeypatch.context() as m:
        m.setattr(inc.Ledger, "consumed", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            inc.merge_increment(spark, wh, AS_OF)
    assert inc.merge_increment(spark, wh, AS_OF) == {"cases": 1}
    assert inc.merge_increment(spark, wh, AS_OF) == {}
    want = merge_distinct([c_hist, one, two], schemas.CASE_DLY_MERGE, as_of=AS_OF)
    columns = schemas.CASE_DLY_MERGE.fieldNames()
    assert rows(wh.read(spark, "case_dly").select(*columns)) == rows(want.select(*columns))
    want = merge_distinct([s_hist, surveys.where(F.col("survey_id").cast("long") % 2 == 1)],
                          schemas.SURVEY_DLY_MERGE, as_of=AS_OF)
    columns = schemas.SURVEY_DLY_MERGE.fieldNames()
    assert rows(wh.read(spark, "survey_dly").select(*columns)) == rows(want.select(*columns))


def test_untouched_partitions_are_not_read(spark, tmp_dir):
    wh, cases, *_ = _warehouse(spark, tmp_dir)
    day = cases.select(F.min(F.col("create_timestamp").cast("date"))).first()[0]
    new = with_event_date(cases.where(F.col("create_timestamp").cast("date") == F.lit(day)),
                          "create_timestamp", "create_date")
    read = wh.read(spark, "case_dly").where(inc.touched_partitions(new, "create_date"))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and str(day) in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert read.count() and {r[0] for r in read.select("create_date").distinct().collect()} == {day}


# -------------------------------------------------------------- latest versions

def _versions(spark, seed, n=400):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        at = rng.choice([None, *(dt.datetime(2020, 1, 1, 0, 0, s, us) for s in range(3) for us in (0, 1, 500_000))])
        made = rng.choice([None, dt.datetime(2019, 1, 1), dt.datetime(2019, 1, 1, 0, 0, 0, 7)])
        out.append((rng.choice(["Open", "Closed", None]), rng.choice(["A", "AB", None]), "s", at,
                    rng.choice([None, *map(str, range(30))]), made, "e", rng.choice(["1", "10", None]), "p", "US", "m"))
    return spark.createDataFrame(out, schemas.CASE)


def _surveys(spark, seed, n=300):
    rng = random.Random(seed)
    return spark.createDataFrame([
        (rng.choice([None, 1, 2]), rng.choice([None, 3]), 4, 5, rng.choice([None, "x", "y"]),
         rng.choice([None, *map(str, range(40))]),
         rng.choice([None, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 0, 0, 9)]),
         rng.choice([None, "7", "8", "70"])) for _ in range(n)], schemas.SURVEY)


def test_latest_tables_equal_the_full_build_after_every_increment(spark, tmp_dir):
    wh = Warehouse(f"{tmp_dir}/wh")
    cases = surveys = None
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for k in range(3):
            spark.conf.set("spark.sql.shuffle.partitions", str(4 + k))        # buckets stay
            c, s = _versions(spark, k), _surveys(spark, 10 + k)
            cases = c if cases is None else cases.unionByName(c)
            surveys = s if surveys is None else surveys.unionByName(s)
            inc.update_latest_tables(spark, wh, c, s, buckets=3 if k == 0 else None)
            got = inc.fact_from_latest(spark, wh, AS_OF)
            want = build_fact(cases, surveys, AS_OF)
            assert rows(got) == rows(want)
        assert [t.buckets for t in inc.latest_tables(spark, wh)] == [3, 3]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert latest_cases(cases).count() == inc.latest_tables(spark, wh)[0].read().count()
    assert latest_surveys(surveys).count() == inc.latest_tables(spark, wh)[1].read().count()


def test_state_side_has_no_exchange(spark, tmp_dir):
    wh = Warehouse(f"{tmp_dir}/wh")
    inc.update_latest_tables(spark, wh, _versions(spark, 1), _surveys(spark, 2), buckets=4)
    plan = inc.fact_from_latest(spark, wh, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    state = inc.latest_tables(spark, wh)[0]
    new = inc.newest_versions(_versions(spark, 3), schemas.CASE, "last_modified_timestamp", inc.CASE_TIES)
    joined = state.read().where("case_no IS NOT NULL").alias("o").join(
        new.repartition(state.buckets, "case_no").alias("n").hint("merge"), F.col("o.case_no") == F.col("n.case_no"), "full_outer")
    text = joined._jdf.queryExecution().executedPlan().toString()
    left = text[text.index("SortMergeJoin"):]
    scan = [line for line in left.splitlines() if "Exchange" in line or "Bucketed: true" in line]
    # the state comes first and is scanned bucketed, without an exchange above it
    assert "Bucketed: true" in scan[0] and text.count("Bucketed: true") == 1


def test_bucketed_table_in_a_fresh_catalog(spark, tmp_dir):
    schema = schemas.struct(("k", schemas.S), ("v", schemas.I))
    df = spark.range(100).select((F.col("id") % 40).cast("string").alias("k"), F.col("id").cast("int").alias("v"))
    BucketedTable(spark, f"{tmp_dir}/b", "k", schema, 5).replace(df)
    name = spark.sql("SHOW TABLES").where("tableName LIKE 'casekit_%'").collect()[-1].tableName
    opened = BucketedTable(spark, f"{tmp_dir}/b", "k", schema)
    own = opened._name(opened.current().folder)
    spark.sql(f"DROP TABLE {own}")                           # external: the files stay
    assert name and rows(opened.read()) == rows(df.select("k", "v")) and opened.buckets == 5


def test_new_rows_are_dealt_once(spark):
    new = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "n int, t string")
    old = spark.createDataFrame([(2, None), (3, "d")], "n int, t string")
    fresh = inc.rows_not_in(new, old.hint("merge"), ["n", "t"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert sorted(map(tuple, fresh.collect())) == [(1, "a"), (3, "c")]


def test_only_the_range_of_the_new_rows_is_compared(spark):
    t = lambda *days: spark.createDataFrame(
        [(d and dt.datetime(2001, 1, d, 0, 0, 0, 5),) for d in days], "t timestamp_ntz")
    old = t(1, 2, 3, 4, None)
    assert [r.t.day for r in old.where(inc.within_range(t(2, 3), "t")).collect()] == [2, 3]
    assert old.where(inc.within_range(t(None, 4), "t")).count() == 2
    assert old.where(inc.within_range(t(None), "t")).count() == 1
    assert old.where(inc.within_range(t(1).where("false"), "t")).count() == 0
