"""Stream operators with state: the same result however the input is cut into batches."""

import datetime as dt
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from casekit import schemas
from casekit.functions.jsonio import encode_arrays, text_fields
from casekit.operators import live_status_counts
from casekit.plans.fact import latest_cases
from casekit.plans.jobs import Warehouse, following_priority, refresh_dimension
from casekit.sources import driver_views as dv
from casekit.streaming import (count_first_seen, counted_kinds, cumulative_counts, decode_cases,
                               decode_surveys, join_streams, land_newest, land_stream, merged_sketches,
                               newest_landed, newest_versions_stream, rocksdb_state, sketch_counts, stream_messages)
from casekit.streaming.live import replace_batch

SF = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}
TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def feed(spark, path, frame, ts=TS):
    encode_arrays(text_fields(frame, ts), 20).write.mode("append").text(path)


def empty(spark, path):
    spark.createDataFrame([], "value string").write.text(path)
    return stream_messages(spark, "text", path)


def cases_of(spark, n=60, seed=1):
    rng = random.Random(seed)
    hot = "7"                                            # a third of all records are one case
    at = lambda: dt.datetime(2020, 1, 1, 0, 0, rng.randint(0, 3), rng.choice([0, 250_000]))
    return spark.createDataFrame([
        (rng.choice(["Open", "Closed"]), rng.choice(["A", "N"]), f"A{rng.randint(0, 3)}", at(),
         hot if k % 3 == 0 else str(rng.randint(0, 20)), dt.datetime(2019, 1, 1, 0, 0, 0, rng.choice([0, 9])), "e", "c",
         str(k), "US", "m") for k in range(n)], schemas.CASE)


def surveys_of(spark, n=50):
    rng = random.Random(2)
    return spark.createDataFrame([
        (rng.randint(0, 10), 1, 2, 3, "t", "7" if k % 3 == 0 else str(rng.randint(0, 25)),
         dt.datetime(2020, 2, 1, 0, 0, k % 60), str(k)) for k in range(n)], schemas.SURVEY)


@pytest.mark.parametrize("cuts, salts", [([(1, 1)], 1), ([(0, 3), (1, 0), (2, 1), (3, 2)], 3)])
def test_no_pair_is_lost_in_any_cut(spark, tmp_dir, cuts, salts):
    cases, surveys = cases_of(spark), surveys_of(spark)
    cm, sm = empty(spark, f"{tmp_dir}/c"), empty(spark, f"{tmp_dir}/s")
    out = join_streams(decode_cases(cm, keep=("ingest_ts",)), decode_surveys(sm, keep=("ingest_ts",)), salts=salts)
    n = len(cuts)
    with rocksdb_state(spark, 2):
        for a, b in cuts:                                # cut a of the cases comes with cut b of the surveys
            feed(spark, f"{tmp_dir}/c", cases.where(F.col("product_code").cast("long") % n == a % n))
            feed(spark, f"{tmp_dir}/s", surveys.where(F.col("survey_id").cast("long") % n == b % n))
            land_stream(out, f"{tmp_dir}/land", f"{tmp_dir}/ck", trigger=ONCE).awaitTermination(120)
    want = cases.join(surveys, "case_no").select(*schemas.CASE_SURVEY.fieldNames())
    assert rows(spark.read.parquet(f"{tmp_dir}/land").select(*want.columns)) == rows(want)


def test_join_state_ends(spark, tmp_dir):
    """Records whose arrivals are further apart than ``within`` don't meet, and leave the state."""
    cases, surveys = (spark.readStream.schema(s).json(f"{tmp_dir}/{n}") for n, s in (
        ("c", schemas.struct(*[(f.name, f.dataType) for f in schemas.CASE.fields], ("ingest_ts", schemas.T.TimestampType()))),
        ("s", schemas.struct(*[(f.name, f.dataType) for f in schemas.SURVEY.fields], ("ingest_ts", schemas.T.TimestampType())))))\
        if _folders(spark, tmp_dir) else None
    out = join_streams(cases, surveys, within="1 hour", delay="1 minute")
    case, survey = cases_of(spark, 1), surveys_of(spark, 1)
    with rocksdb_state(spark, 2):
        for c_at, s_at in ((0, None), (2, 2), (2, 2), (3, None), (None, 4)):       # hours
            for folder, frame, at in (("c", case, c_at), ("s", survey, s_at)):
                if at is not None:
                    (frame.withColumn("ingest_ts", F.lit(f"2020-01-01 0{at}:00:00").cast("timestamp"))
                     .write.mode("append").json(f"{tmp_dir}/{folder}"))
            q = land_stream(out, f"{tmp_dir}/land", f"{tmp_dir}/ck", trigger=ONCE)
            q.awaitTermination(120)
    # 2x2 pairs at two o'clock; two surveys meet the case of three; the case of three that of four
    assert spark.read.parquet(f"{tmp_dir}/land").count() == 4 + 2 + 1
    state = spark.read.format("statestore").option("operatorId", 0).option("joinSide", "left").load(f"{tmp_dir}/ck")
    assert state.count() < 4


def _folders(spark, base):
    for n in "cs":
        spark.createDataFrame([], "value string").write.text(f"{base}/{n}")
    return True


@pytest.mark.parametrize("seed", [1, 2])
def test_newest_version_in_any_cut(spark, tmp_dir, seed):
    cases = cases_of(spark, 150, seed).unionByName(cases_of(spark, 5).withColumn("case_no", F.lit(None).cast("string")))
    rng = random.Random(seed)
    parts = rng.randint(2, 3)
    messages = empty(spark, f"{tmp_dir}/in")
    with rocksdb_state(spark, 2):
        for k in rng.sample(range(parts), parts):        # late versions come after newer ones
            feed(spark, f"{tmp_dir}/in", cases.where(F.col("product_code").cast("long") % parts == k))
            land_newest(decode_cases(messages, keep=("ingest_ts",)), f"{tmp_dir}/out", f"{tmp_dir}/ck", ONCE,
                        expire_after="30 days" if seed == 1 else None, salts=3).awaitTermination(120)
    landed = spark.read.parquet(f"{tmp_dir}/out")
    assert rows(newest_landed(landed)) == rows(latest_cases(cases))
    assert landed.count() < cases.count()                # versions that are not newer come out nowhere


def test_rank_without_times_and_fields(spark):
    """Records without a time or another field rank last, as in the newest version of a case."""
    null = F.lit(None)
    k = F.col("product_code").cast("int")
    cases = cases_of(spark, 300, 3).select(*[
        F.when(F.pmod(F.xxhash64(k, F.lit(n)), F.lit(3)) == 0, null).otherwise(
            F.when(k % 7 == 0, "").otherwise(F.col(c)) if c in ("category", "status") else F.col(c)).alias(c)
        if c not in ("case_no", "product_code") else F.col(c)
        for n, c in enumerate(schemas.CASE_COLUMNS)])
    untimed = cases.where("case_no = '7'").withColumn("case_no", F.lit("x")).withColumn(
        "last_modified_timestamp", null.cast("timestamp_ntz"))
    cases = cases.unionByName(untimed)
    assert rows(newest_landed(newest_versions_stream(cases))) == rows(latest_cases(cases))


def test_newest_version_is_held_once(spark, tmp_dir):
    """The state of a case is its newest record, without a text of its rank beside it."""
    messages = empty(spark, f"{tmp_dir}/in")
    with rocksdb_state(spark, 2):
        feed(spark, f"{tmp_dir}/in", cases_of(spark, 30))
        land_newest(decode_cases(messages), f"{tmp_dir}/out", f"{tmp_dir}/ck", ONCE).awaitTermination(120)
    held = spark.read.format("statestore").load(f"{tmp_dir}/ck").schema["value"].dataType
    assert [f.dataType.typeName() for f in held.fields if f.dataType.typeName() == "string"] == []


def test_cumulative_counts_exact_and_sketched(spark, tmp_dir):
    cases = dv.cases(spark, SF)
    messages = empty(spark, f"{tmp_dir}/in")
    kinds = counted_kinds(decode_cases(messages))
    seen = None
    with rocksdb_state(spark, 2):
        for b in range(3):
            part = cases.where(F.col("product_code").cast("long") % 3 == b)
            feed(spark, f"{tmp_dir}/in", part, "yyyy-MM-dd HH:mm:ss")
            count_first_seen(kinds, ["Case_Type"], f"{tmp_dir}/n", f"{tmp_dir}/ck1", ONCE).awaitTermination(120)
            sketch_counts(kinds, ["Case_Type"], f"{tmp_dir}/sk", f"{tmp_dir}/ck2", ONCE).awaitTermination(120)
            seen = part if seen is None else seen.unionByName(part)
            want = {r.Case_Type: r.Cases_numbers for r in live_status_counts(seen).collect()}
            got = cumulative_counts(spark, f"{tmp_dir}/n", ["Case_Type"]).where(F.col("batch_id") == b)
            assert {r.Case_Type: r.Cases_numbers for r in got.collect()} == want
            close = merged_sketches(spark, f"{tmp_dir}/sk", ["Case_Type"], through_batch=b)
            for r in close.collect():
                assert abs(r.Cases_numbers - want[r.Case_Type]) <= 0.05 * want[r.Case_Type]


def test_sketch_error_over_many_cases(spark, tmp_dir):
    for b in range(3):                                   # batches share half of their cases
        replace_batch(spark.range(b * 20_000, b * 20_000 + 40_000).selectExpr("'g' AS g", "CAST(id AS string) AS case_no")
                      .groupBy("g").agg(F.hll_sketch_agg("case_no", 12).alias("sketch")), f"{tmp_dir}/s", b)
    (r,) = merged_sketches(spark, f"{tmp_dir}/s", ["g"]).collect()
    assert abs(r.Cases_numbers - 80_000) <= 0.05 * 80_000


def test_lookup_is_loaded_again_only_when_replaced(spark, tmp_dir):
    wh = Warehouse(f"{tmp_dir}/wh")
    refresh_dimension(dv.case_category(spark), wh, "case_category", dv.AS_OF)
    refresh_dimension(dv.case_priority(spark), wh, "case_priority", dv.AS_OF)
    lookup = following_priority(spark, wh)
    cases = dv.cases(spark, SF).limit(200)
    first = {r.severity for r in lookup(cases).collect()}
    lookup(cases)
    assert lookup.loads == 1
    refresh_dimension(dv.case_priority(spark).withColumn("severity", F.upper("severity")), wh, "case_priority", dv.AS_OF)
    assert {r.severity for r in lookup(cases).collect()} == {s and s.upper() for s in first} and lookup.loads == 2


def test_processing_time_trigger(spark, tmp_dir):
    """A query that keeps running takes in what arrives while it runs."""
    messages = empty(spark, f"{tmp_dir}/in")
    q = land_stream(decode_cases(messages), f"{tmp_dir}/land", f"{tmp_dir}/ck", trigger={"processingTime": "1 second"})
    try:
        for k in (0, 1):
            feed(spark, f"{tmp_dir}/in", cases_of(spark, 10, k))
            q.processAllAvailable()
            assert spark.read.parquet(f"{tmp_dir}/land").count() == 10 * (k + 1)
    finally:
        q.stop()


def test_settings_of_the_state_end_with_it(spark):
    idle, counted = ("spark.sql.streaming.noDataMicroBatches.enabled",
                     "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows")
    before = spark.conf.get(idle), spark.conf.get(counted, None)
    with rocksdb_state(spark, 2, idle_batches=False):
        assert (spark.conf.get(idle), spark.conf.get(counted)) == ("false", "false")
    assert (spark.conf.get(idle), spark.conf.get(counted, None)) == before


def test_a_lean_state_is_small_and_whole(spark, tmp_dir):
    """Zstd files in blocks of 16 KB, a case's texts in one; odd texts come out as they were."""
    odd = ["", "|", "\\", "\\n", "\\p|\\b", "a|b", None]
    cases = cases_of(spark, 40).withColumn("country_cd", F.element_at(
        F.array(*map(F.lit, odd)), (F.col("product_code").cast("int") % len(odd) + 1)))
    surveys = surveys_of(spark)
    cm, sm = empty(spark, f"{tmp_dir}/c"), empty(spark, f"{tmp_dir}/s")
    out = join_streams(decode_cases(cm, keep=("ingest_ts",)), decode_surveys(sm, keep=("ingest_ts",)))
    freed = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(freed)
    with rocksdb_state(spark, 2, idle_batches=False, lean=True):
        for b in (0, 1):
            feed(spark, f"{tmp_dir}/c", cases.where(F.col("product_code").cast("long") % 2 == b))
            feed(spark, f"{tmp_dir}/s", surveys.where(F.col("survey_id").cast("long") % 2 == b))
            land_stream(out, f"{tmp_dir}/land", f"{tmp_dir}/ck", trigger=ONCE).awaitTermination(120)
    assert spark.conf.get(freed) == before
    want = cases.join(surveys, "case_no").select(*schemas.CASE_SURVEY.fieldNames())
    assert rows(spark.read.parquet(f"{tmp_dir}/land").select(*want.columns)) == rows(want)
    held = spark.read.format("statestore").option("joinSide", "left").load(f"{tmp_dir}/ck")
    kinds = [f.dataType.simpleString() for f in held.schema["value"].dataType.fields]
    assert kinds.count("string") == 2 and held.count() == cases.count()          # the number and the other texts
    folder = f"{tmp_dir}/ck/state/0/0/left-keyWithIndexToValue/2.zip"
    with zipfile.ZipFile(io.BytesIO(spark.read.format("binaryFile").load(folder).first().content)) as z:
        options = "".join(z.read(n).decode() for n in z.namelist() if "OPTIONS" in n)
    for chosen in ("compression=kZSTD", "block_size=16384", "allow_fallocate=false"):
        assert chosen in options
