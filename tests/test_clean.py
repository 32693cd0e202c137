import datetime as dt
import decimal

from pyspark.sql import functions as F

from stellate.functions import clean as C
from stellate.operators import metrics as A


def test_malformed_text_becomes_null(spark):
    df = spark.createDataFrame([("2024-02-30", "2024-01-01 25:00:00", "12.5", "7"),
                                ("2024-02-29", "2024-01-01 10:00:00", "abc", "x")], "d string, t string, n string, i string")
    r = df.select(C.to_date("d").alias("d"), C.to_timestamp("t").alias("t"), C.to_money("n").alias("n"),
                  C.to_int("i").alias("i")).collect()
    assert (r[0].d, r[0].t, r[0].n, r[0].i) == (None, None, decimal.Decimal("12.5000"), 7)
    assert r[1].d == dt.date(2024, 2, 29) and r[1].n is None and r[1].i is None


def test_defaults_by_null_band_warns(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 2.0, None), (None, None, 3)], "a string, b double, c int")
    out, warnings = C.defaults_by_null_band(df, {"a": 100.0, "b": 66.67, "c": 33.33})
    rows = out.collect()
    assert [r.a for r in rows] == ["Unknown"] * 3
    assert sorted(r.b for r in rows) == [0.0, 0.0, 2.0]
    assert dict(warnings) == {"a": "all null: constant default", "b": "more than half null: default applied"}


def test_url_parts(spark):
    df = spark.createDataFrame([("https://shop.example.com:8443/a/b/c?x=1#f",), ("http://example.org",)], "u string")
    r = df.select(C.url_host("u").alias("h"), *C.url_path_levels("u", 3)).collect()
    assert (r[0].h, r[0].page_location_1, r[0].page_location_2, r[0].page_location_3) == \
        ("shop.example.com", "a", "b", "c")
    assert (r[1].h, r[1].page_location_1) == ("example.org", None)


def test_split_datetime_and_date_key(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 7, 5, 3),)], "ts timestamp_ntz")
    r = df.select(*C.split_datetime("ts", "e"), C.date_key("ts").alias("k")).first()
    assert (r.e_date, r.e_time, r.k) == (dt.date(2024, 3, 9), "07:05:03", 20240309)


def test_rolling_window_uses_calendar_days(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 5), 2.0),
                                (dt.date(2024, 1, 9), 4.0)], "d date, v double")
    r = {x.day: float(x.rolling_7d) for x in A.rolling(A.daily(df, "d", "v"), 7).collect()}
    assert r == {dt.date(2024, 1, 1): 1.0, dt.date(2024, 1, 5): 3.0, dt.date(2024, 1, 9): 6.0}


def test_cast_to_schema_missing_and_bad_values(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("12", "x")], "a string, b string")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                           T.StructField("c", T.DateType())])
    r = C.cast_to_schema(df, schema).first()
    assert (r.a, r.b, r.c) == (12, None, None)
