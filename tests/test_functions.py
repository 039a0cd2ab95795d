import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from casekit import schemas
from casekit.functions import (answer_to_int, conform, hours_between, in_last, overall_label,
                               parse_range, score_label, trunc_seconds, with_event_date,
                               with_load_stamp)


def test_conform_by_name_with_bad_values(spark):
    df = spark.createDataFrame([("x", "2001-01-01 10:00:00", "7"), ("y", "not a time", "n/a")],
                               "b string, ts string, a string")
    target = schemas.struct(("a", T.IntegerType()), ("b", T.StringType()),
                            ("ts", T.TimestampNTZType()))
    rows = sorted(conform(df, target).collect(), key=lambda r: r.b)
    assert [tuple(r) for r in rows] == [(7, "x", dt.datetime(2001, 1, 1, 10)), (None, "y", None)]


def test_conform_missing_column(spark):
    df = spark.createDataFrame([("x",)], "b string")
    target = schemas.struct(("a", T.IntegerType()), ("b", T.StringType()))
    try:
        conform(df, target)
        raise AssertionError("expected an error")
    except ValueError:
        pass
    assert conform(df, target, strict=False).collect()[0].a is None


def test_answer_to_int(spark):
    df = spark.createDataFrame([("5",), ("5.0",), (" -7 ",), ("5.7",), ("1e3",), ("x",), ("",), (None,),
                                ("99999999999",)], "v string")
    assert [r[0] for r in df.select(answer_to_int("v")).collect()] == [5, 5, -7] + [None] * 6
    big = conform(spark.createDataFrame([("9007199254740993",), ("2.5",)], "v string"),
                  schemas.struct(("v", T.LongType())))
    assert [r.v for r in big.collect()] == [9007199254740993, None]


def test_parse_range(spark):
    df = spark.createDataFrame([("9-10",), ("10-10",), ("n/a",), (None,), ("0-4",)], "r string")
    got = [tuple(r[0]) for r in df.select(parse_range("r")).collect()]
    assert got == [(9, 10), (10, 10), (None, None), (None, None), (0, 4)]


def test_labels_and_overall(spark):
    df = spark.createDataFrame([(1, -1, 0, 0), (1, 1, None, 0), (-1, -1, 0, 1), (1, 0, 0, 0)],
                               "a int, b int, c int, d int")
    got = df.select(overall_label("a", "b", "c", "d"), score_label("b")).collect()
    assert [tuple(r) for r in got] == [("Neutral", "Negative"), (None, "Positive"),
                                       ("Negative", "Negative"), ("Positive", "Neutral")]
    assert df.select(score_label(F.lit(5))).first()[0] is None


def test_in_last_inclusive_and_calendar_month(spark):
    as_of = dt.datetime(2024, 3, 31, 0, 0, 0)
    rows = [(dt.datetime(2024, 3, 31, 0, 0, 0),), (dt.datetime(2024, 3, 30, 23, 0, 0),),
            (dt.datetime(2024, 3, 30, 22, 59, 59),), (dt.datetime(2024, 2, 29, 0, 0, 0),),
            (dt.datetime(2024, 2, 28, 23, 59, 59),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    hour = [r[0] for r in df.select(in_last("ts", "1 HOUR", as_of)).collect()]
    month = [r[0] for r in df.select(in_last("ts", "1 MONTH", as_of)).collect()]
    assert hour == [True, True, False, False, False]
    assert month == [True, True, True, True, False]


def test_hours_between_negative_kept(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 2, 12), dt.datetime(2001, 1, 1, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(hours_between("a", "b")).first()[0] == -36.0


def test_trunc_seconds_ties(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 1, 0, 0, 1, 100000),),
                                (dt.datetime(2001, 1, 1, 0, 0, 1, 900000),)], "ts timestamp_ntz")
    got = {r[0] for r in df.select(trunc_seconds("ts")).collect()}
    assert got == {dt.datetime(2001, 1, 1, 0, 0, 1)}
    assert df.select(trunc_seconds("ts")).schema[0].dataType == T.TimestampNTZType()


def test_event_date_and_stamp(spark):
    df = spark.createDataFrame([("2001-02-03 04:05:06",), ("bad",)], "ts string")
    out = with_event_date(df, "ts", "d").collect()
    assert out[0].d == dt.date(2001, 2, 3) and out[1].d is None
    st = with_load_stamp(df, as_of="2001-11-04 00:00:00", date_col="load_date").first()
    assert st.row_insertion_dttm == dt.datetime(2001, 11, 4) and st.load_date == dt.date(2001, 11, 4)
    now = with_load_stamp(df).first().row_insertion_dttm
    assert now.microsecond == 0


def test_trunc_seconds_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 on 10 March 2024 does not exist in New York (clocks jump 02:00 -> 03:00)
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 5, 700000),)],
                                   "ts timestamp_ntz")
        assert df.select(trunc_seconds("ts")).first()[0] == dt.datetime(2024, 3, 10, 2, 30, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
