import datetime as dt
import json

from pyspark.sql import functions as F

from casekit import schemas
from casekit.functions.jsonio import decode_json, encode_arrays, encode_rows, text_fields
from casekit.operators.enrich import priority_lookup
from casekit.sources import driver_views as dv
from casekit.sources.tables import read_landing
from casekit.streaming import (LiveSinks, decode_cases, decode_surveys, dedup_stream, land_stream,
                               publish_json, published_rows, start_live)
from casekit.streaming.sources import stream_files, stream_messages

ONCE = {"availableNow": True}


def _survey(**kw):
    base = {"Q1": 5, "Q3": 4, "Q2": 3, "Q5": 2, "Q4": "ok", "case_no": "1",
            "survey_timestamp": "2001-01-01 10:00:00", "survey_id": "s"}
    base.update(kw)
    return base


def test_decode_shapes(spark):
    msgs = [json.dumps([_survey(survey_id="a"), _survey(survey_id="b")]),
            json.dumps(_survey(survey_id="c")),
            "{not json",
            "[]",
            json.dumps({k: v for k, v in _survey(survey_id="d").items() if k != "Q4"}),
            json.dumps([_survey(survey_id="e", Q4="text with [ ] }, inside")]),
            json.dumps([_survey(survey_id="f", Q1=5.0, Q2="5")])]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    good, bad = decode_json(df, schemas.SURVEY, bad="quarantine")
    got = {r.survey_id: r for r in good.collect()}
    assert sorted(got) == ["a", "b", "c", "d", "e", "f"]
    assert got["d"].Q4 is None
    assert got["e"].Q4 == "text with [ ] }, inside"
    assert got["f"].Q1 == 5 and got["f"].Q2 == 5
    assert got["a"].survey_timestamp == dt.datetime(2001, 1, 1, 10)
    assert [r.raw for r in bad.collect()] == ["{not json"]


def test_a_damaged_record_costs_only_itself(spark):
    rec = lambda i: json.dumps(_survey(survey_id=str(i)))
    msgs = [f"[{rec(1)},{rec(2)[:30]}]", f"[{rec(3)}, {{bad}}, {rec(4)}]", f"[{rec(5)}, 7, {rec(6)}]",
            f"[null,{rec(7)}]", f"[{rec(8)[:50]}", "", None]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    good, bad = decode_json(df, schemas.SURVEY, bad="quarantine")
    assert sorted(r.survey_id for r in good.collect()) == ["1", "3", "4", "5", "6", "7"]
    assert sorted(r.raw for r in bad.collect()) == sorted(
        [rec(2)[:30], "{bad}", "7", "null", rec(8)[:50]])
    assert sorted(r.survey_id for r in decode_surveys(df).collect()) == ["1", "3", "4", "5", "6", "7"]


def test_encode_round_trip(spark):
    cases = dv.cases(spark, "/root/testdata/sf0.001")
    ref = sorted(map(tuple, cases.collect()))
    arrays = encode_arrays(text_fields(cases), 7)
    assert arrays.select(F.max(F.size(F.from_json("value", "array<string>")))).first()[0] <= 7
    assert sorted(map(tuple, decode_cases(arrays).collect())) == ref
    assert sorted(map(tuple, decode_cases(encode_rows(cases)).collect())) == ref


def _write_messages(frame, path):
    frame.write.mode("overwrite").text(path)


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    cases = dv.cases(spark, "/root/testdata/sf0.001")
    _write_messages(encode_arrays(text_fields(cases), 20), f"{tmp_dir}/in")

    def run():
        s = decode_cases(stream_messages(spark, "text", f"{tmp_dir}/in"))
        land_stream(s, f"{tmp_dir}/land", f"{tmp_dir}/ckpt", trigger=ONCE).awaitTermination()
        return read_landing(spark, f"{tmp_dir}/land", schemas.CASE)

    first = sorted(map(tuple, run().collect()))
    assert first == sorted(map(tuple, cases.collect()))
    assert sorted(map(tuple, run().collect())) == first


def _messages_in_files(frame, path, files, ts="yyyy-MM-dd HH:mm:ss.SSSSSS"):
    """The rows in ``files`` files, one after the other by time."""
    rows = frame.collect()
    spark = frame.sparkSession
    for k in range(files):
        part = spark.createDataFrame(rows[k::files], frame.schema)
        encode_arrays(text_fields(part, ts), 20).coalesce(1).write.mode("append").text(path)


def _lookup(spark):
    return priority_lookup(dv.case_category(spark), dv.case_priority(spark), how="inner")


def _live(spark, base, cases, surveys, files, **more):
    _messages_in_files(cases, f"{base}/c", files)
    _messages_in_files(surveys, f"{base}/s", files)
    sinks = LiveSinks.under(f"{base}/out", published=f"{base}/joined")
    start_live(stream_messages(spark, "text", f"{base}/c", max_files=1),
               stream_messages(spark, "text", f"{base}/s", max_files=1), sinks, _lookup(spark),
               f"{base}/ck", trigger=ONCE, **more).awaitTermination()
    return sinks


def test_landing_does_not_depend_on_how_the_input_is_cut(spark, tmp_dir):
    d = "/root/testdata/sf0.001"
    cases, surveys = dv.cases(spark, d).limit(400), dv.surveys(spark, d).limit(300)
    want = [sorted(map(tuple, f.collect()), key=str) for f in (cases, surveys)]
    for files in (1, 4):
        sinks = _live(spark, f"{tmp_dir}/{files}", cases, surveys, files)
        got = [read_landing(spark, p, t) for p, t in ((sinks.cases, schemas.CASE), (sinks.surveys, schemas.SURVEY))]
        assert [sorted(map(tuple, f.collect()), key=str) for f in got] == want
        assert spark.read.parquet(sinks.cases).select("batch_id").distinct().count() == files
        assert read_landing(spark, sinks.cases, schemas.CASE, after_batch=0).count() == \
            spark.read.parquet(sinks.cases).where("batch_id > 0").count()


def test_live_outputs_per_batch(spark, tmp_dir, capsys):
    d = "/root/testdata/sf0.001"
    cases, surveys = dv.cases(spark, d), dv.surveys(spark, d)
    _messages_in_files(cases, f"{tmp_dir}/c", 1)
    spark.createDataFrame([('[{"status":"Open",',)], "value string").write.mode("append").text(f"{tmp_dir}/c")
    _messages_in_files(surveys, f"{tmp_dir}/s", 1)
    sinks = LiveSinks.under(f"{tmp_dir}/out", published=f"{tmp_dir}/joined")
    start_live(stream_messages(spark, "text", f"{tmp_dir}/c"), stream_messages(spark, "text", f"{tmp_dir}/s"),
               sinks, _lookup(spark), f"{tmp_dir}/ck", trigger=ONCE, show=20).awaitTermination()
    got = {r.Case_Type: r.Cases_numbers for r in spark.read.parquet(sinks.status).collect()}
    assert got["Total Cases"] == cases.select(F.count_distinct("case_no")).first()[0]
    pr = spark.read.parquet(sinks.priority)
    assert pr.where(F.col("priority").isNull()).count() == 1   # unmatched (R3 / P4) group
    assert [tuple(r) for r in spark.read.parquet(sinks.rejects).select("kind", "raw").collect()] == \
        [("case", '{"status":"Open",')]
    assert "Total Cases" in capsys.readouterr().out
    joined = decode_json(spark.read.text(sinks.published), schemas.CASE_SURVEY)
    want = cases.join(surveys, "case_no").select(*schemas.CASE_SURVEY.fieldNames())
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_join_needs_the_same_batch_not_near_times(spark, tmp_dir):
    case = lambda no, ts: ("Open", "A", "A0", ts, no, "2001-01-01 00:00:00", "1", "2", "3", "US", "mail")
    answer = lambda no, i: ("5", "4", "3", "2", "x", no, "2024-05-05 10:00:00", i)
    for k, (no, other) in enumerate((("0", "0"), ("1", "2"), ("2", "1"))):
        encode_rows(spark.createDataFrame([case(no, "2001-01-02 00:00:00"), case(no, "2002-01-02 00:00:00")],
                                          schemas.CASE_MESSAGE)).coalesce(1).write.mode("append").text(f"{tmp_dir}/c")
        encode_rows(spark.createDataFrame([answer(other, f"s{k}")], schemas.SURVEY_MESSAGE)) \
            .coalesce(1).write.mode("append").text(f"{tmp_dir}/s")
    sinks = LiveSinks.under(f"{tmp_dir}/out", published=f"{tmp_dir}/joined")
    start_live(stream_messages(spark, "text", f"{tmp_dir}/c", max_files=1),
               stream_messages(spark, "text", f"{tmp_dir}/s", max_files=1), sinks, _lookup(spark),
               f"{tmp_dir}/ck", trigger=ONCE).awaitTermination()
    out = decode_json(spark.read.text(sinks.published), schemas.CASE_SURVEY).collect()
    # years apart, same batch: joined; cases 1 and 2 arrive in other batches than their surveys
    assert sorted((r.case_no, r.survey_id, r.last_modified_timestamp.year) for r in out) == \
        [("0", "s0", 2001), ("0", "s0", 2002)]


def test_publish_json_counts_and_replaces_batches(spark, tmp_dir):
    cases = dv.cases(spark, "/root/testdata/sf0.001")
    _write_messages(encode_arrays(text_fields(cases), 20), f"{tmp_dir}/in")
    q = publish_json(decode_cases(stream_messages(spark, "text", f"{tmp_dir}/in")), f"{tmp_dir}/ck",
                     path=f"{tmp_dir}/out", envelope="array", trigger=ONCE)
    q.awaitTermination()
    assert sum(rows for _, rows in published_rows(q)) == cases.count()
    assert decode_cases(spark.read.text(f"{tmp_dir}/out")).count() == cases.count()


def test_dedup_keeps_old_event_times_in_any_cut(spark, tmp_dir):
    """Event times far apart and out of order: nothing is late, in one batch or many."""
    rows = [("5", "4", "3", "2", "x", str(i), f"{2000 + (i * 7) % 24}-01-01 00:00:00", f"s{i % 90}")
            for i in range(120)]
    frame = spark.createDataFrame(rows, schemas.SURVEY_MESSAGE)
    for files in (1, 5):
        base = f"{tmp_dir}/{files}"
        _messages_in_files(frame, f"{base}/in", files)
        s = decode_surveys(stream_messages(spark, "text", f"{base}/in", max_files=1), keep=("ingest_ts",))
        land_stream(dedup_stream(s, ["survey_id"]), f"{base}/land", f"{base}/ck", trigger=ONCE).awaitTermination()
        got = read_landing(spark, f"{base}/land", schemas.SURVEY)
        assert got.count() == 90 and got.select("survey_id").distinct().count() == 90


def test_dedup_stream(spark, tmp_dir):
    d = "/root/testdata/sf0.001"
    for frame, mode in ((dv.survey_history(spark, d), "overwrite"),
                        (dv.survey_increment(spark, d), "append")):
        encode_arrays(text_fields(frame, "yyyy-MM-dd HH:mm:ss.SSSSSS"), 20) \
            .write.mode(mode).text(f"{tmp_dir}/in")
    s = dedup_stream(decode_surveys(stream_messages(spark, "text", f"{tmp_dir}/in"),
                                    keep=("ingest_ts",)), ["survey_id"])
    land_stream(s, f"{tmp_dir}/land", f"{tmp_dir}/ck", trigger=ONCE).awaitTermination()
    got = read_landing(spark, f"{tmp_dir}/land", schemas.SURVEY)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, dv.surveys(spark, d).collect()))


def test_stream_files_archive(spark, tmp_dir):
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(f"{tmp_dir}/in")
    q = (stream_files(spark, f"{tmp_dir}/in", archive_dir=f"{tmp_dir}/done")
         .writeStream.format("memory").queryName("fwd_test").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.value for r in spark.table("fwd_test").collect()) == ["a", "b"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_messages_are_packed_without_a_shuffle(spark):
    from casekit.functions.jsonio import pack_arrays
    rows = spark.range(0, 25_003, numPartitions=3).selectExpr("CAST(id AS string) AS a", "id AS b")
    messages = encode_arrays(rows, 7)
    assert "Exchange" not in _plan(messages)
    sizes = messages.selectExpr("size(from_json(value, 'array<struct<a string, b long>>')) AS n").groupBy("n").count()
    sizes = {r["n"]: r["count"] for r in sizes.collect()}
    assert max(sizes) == 7 and sum(n * k for n, k in sizes.items()) == 25_003
    assert sum(k for n, k in sizes.items() if n < 7) <= 3                 # one short message a partition
    assert pack_arrays(spark.createDataFrame([], "value string")).count() == 0


def test_a_message_is_parsed_once(spark):
    from casekit import schemas
    from casekit.functions.jsonio import decode_marked
    messages = spark.createDataFrame([('[{"case_no":"1"},{"case_no":"2"}]',), ('[{"case_no":"3"},{"case_',),
                                      ("[]",), (None,), ("[null]",)], "value string")
    for df in (decode_json(messages, schemas.CASE), decode_marked(messages, schemas.CASE)):
        assert _plan(df).count("from_json(ArrayType") == 1                # not again in a filter
    marked = decode_marked(messages, schemas.CASE).select("case_no", "raw").collect()
    assert sorted((tuple(r) for r in marked), key=str) == sorted(
        [("1", None), ("2", None), ("3", None), (None, '{"case_'), (None, "null")], key=str)


def test_message_files_are_compressed_and_bounded(spark, tmp_path):
    import glob
    import __spark_entry__ as entry
    frame = spark.range(0, 45_000, numPartitions=1).selectExpr("concat('message ', id) AS value")
    entry._write_text(frame, f"{tmp_path}/m")
    files = glob.glob(f"{tmp_path}/m/part-*")
    assert len(files) == 3 and all(f.endswith(".lz4") for f in files)
    assert spark.read.text(f"{tmp_path}/m").exceptAll(frame).count() == 0


def test_the_live_job_caches_nothing(spark, tmp_dir, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: kept.append(df) or df)
    case = {"case_no": "1", "status": "Open", "create_timestamp": "2001-01-01 10:00:00"}
    spark.createDataFrame([(json.dumps([case]) + "\n",)], "value string").write.text(f"{tmp_dir}/c")
    spark.createDataFrame([(json.dumps([_survey()])[:-1] + ",{bad}]",)], "value string").write.text(f"{tmp_dir}/s")
    sinks = LiveSinks.under(f"{tmp_dir}/out", published=f"{tmp_dir}/joined")
    start_live(stream_messages(spark, "text", f"{tmp_dir}/c"), stream_messages(spark, "text", f"{tmp_dir}/s"),
               sinks, _lookup(spark), f"{tmp_dir}/ck", trigger=ONCE).awaitTermination()
    assert kept == []
    assert [r.survey_id for r in decode_json(spark.read.text(sinks.published), schemas.CASE_SURVEY).collect()] == ["s"]
    assert [(r.kind, r.raw) for r in spark.read.parquet(sinks.rejects).collect()] == [("survey", "{bad}")]


def test_damaged_messages(spark):
    from casekit.functions.jsonio import damaged_messages
    msgs = [json.dumps([_survey()]), json.dumps(_survey()), "[]", "[{}, 7]", "[null]", '[{"Q1": 1}', "{bad}"]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    assert sorted(r.value for r in damaged_messages(df, schemas.SURVEY).collect()) == sorted(msgs[3:])


def test_published_files_are_bounded(spark, tmp_dir, monkeypatch):
    """A published file cannot be split by its readers: many records make several files."""
    import glob

    from casekit.streaming import join
    monkeypatch.setattr(join, "FILE_RECORDS", 100)
    frame = spark.range(500).selectExpr("CAST(id AS string) AS case_no").coalesce(1)
    join.publish_batch(frame, 0, path=f"{tmp_dir}/out", envelope="array", max_rows=50)
    assert len(glob.glob(f"{tmp_dir}/out/batch_id=0/part-*")) == 5
    assert sorted(r.value.count("{") for r in spark.read.text(f"{tmp_dir}/out").collect()) == [50] * 10


def test_a_cut_of_many_files_is_one_batch(spark, tmp_dir):
    import __spark_entry__ as E
    from casekit.streaming import decode_cases, publish_json, published_rows
    messages, _ = E._case_stream(spark, "/root/testdata/sf0.001", tmp_dir)
    (spark.range(0, 1001, 1, 1).selectExpr("""concat('[{"case_no":"', id, '"}]') AS value""")
     .write.mode("append").option("maxRecordsPerFile", 1).text(f"{tmp_dir}/in"))
    q = publish_json(decode_cases(messages), f"{tmp_dir}/ck", path=f"{tmp_dir}/out", trigger={"availableNow": True})
    q.awaitTermination(120)
    assert published_rows(q) == [(0, 1001)]
