import datetime as dt

from pyspark.sql import functions as F

from qualis.functions.keys import id_key, id_string, joined_key, rounded_id, whole_id
from qualis.functions.times import date_key, epoch_day, safe_date, safe_ts


def test_id_string_of_float_ids(spark):
    df = spark.createDataFrame([(12.0,), (12345678.0,), (None,), (2.5,)], "x double")
    got = [r[0] for r in df.select(id_string("x", df.schema["x"].dataType)).collect()]
    assert got == ["12", "12345678", None, "2.5"]


def test_whole_id_only_for_integral_floats(spark):
    df = spark.createDataFrame([(12.0,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(whole_id("x", df.schema["x"].dataType)).collect()]
    assert got == [12, None, None]


def test_user_id_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.4,)], "x double")
    assert [r[0] for r in df.select(rounded_id("x")).collect()] == [3, -3, 1]


def test_md5_keys_match_text_form(spark):
    df = spark.createDataFrame([(12, None)], "a bigint, b string")
    r = df.select(id_key("a").alias("k"), joined_key("a", "b").alias("j"),
                  joined_key("a", F.lit("x")).alias("j2")).first()
    assert r.k == "c20ad4d76fe97759aa27a0c99bff6710"  # md5('12')
    assert r.j is None  # NULL part -> NULL key
    assert r.j2 is not None


def test_safe_timestamp(spark):
    df = spark.createDataFrame([("2024-1-2 3:4:5",), ("2024-01-02 03:04:05 UTC",), ("bad",),
                                ("2024-02-30 00:00:00",), (None,)], "s string")
    got = [r[0] for r in df.select(safe_ts("s")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None, None]


def test_safe_date(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024",), ("",), ("2024-02-30",)], "s string")
    got = [r[0] for r in df.select(safe_date("s")).collect()]
    assert got == [dt.date(2024, 1, 2), None, None, None]


def test_date_key_and_epoch_day(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7), 1700000000)], "d date, e bigint")
    r = df.select(date_key("d").alias("k"), epoch_day("e").alias("e")).first()
    assert r.k == 20240107 and r.e == dt.date(2023, 11, 14)
