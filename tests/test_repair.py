"""Type repair corner cases (T1-T7), one row per case."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.functions import repair as R


def narrow(spark, values, ddl):
    df = spark.createDataFrame([(v,) for v in values], f"c {ddl}")
    out = R.narrow_numeric(df)
    return out.schema["c"].dataType.simpleString(), [r[0] for r in out.collect()]


def test_whole_text_becomes_bigint_with_zero_fill(spark):
    assert narrow(spark, ["1", None, " 7 ", ""], "string") == ("bigint", [1, 0, 7, 0])


def test_scientific_and_inf(spark):
    assert narrow(spark, ["1e3", "inf", "-Infinity", "4"], "string") == ("bigint", [1000, 0, 0, 4])


def test_fraction_keeps_double_and_nulls(spark):
    assert narrow(spark, ["1.5", None, "2"], "string") == ("double", [1.5, None, 2.0])


def test_hex_and_words_stay_text(spark):
    assert narrow(spark, ["0x1A", "3"], "string") == ("string", ["0x1A", "3"])
    assert narrow(spark, ["1d", "3"], "string") == ("string", ["1d", "3"])


def test_boolean_becomes_zero_one(spark):
    assert narrow(spark, [True, False, None], "boolean") == ("bigint", [1, 0, 0])


def test_all_null_column_becomes_zero(spark):
    assert narrow(spark, [None, None], "string") == ("bigint", [0, 0])


def test_whole_doubles_become_bigint(spark):
    assert narrow(spark, [1.0, None, float("inf")], "double") == ("bigint", [1, 0, 0])


def test_struct_untouched(spark):
    df = spark.createDataFrame([((1, "a"),)], "s struct<x: bigint, y: string>")
    assert R.narrow_numeric(df).schema == df.schema


def test_fill_null_off(spark):
    df = spark.createDataFrame([("1",), (None,)], "c string")
    assert [r[0] for r in R.narrow_numeric(df, fill_null=None).collect()] == [1, None]


@pytest.mark.parametrize("text,expected", [
    ("Thu, 17 Apr 2025, 10:30 AM", dt.datetime(2025, 4, 17, 10, 30)),
    ("thu, 7 apr 2025, 1:05 pm", dt.datetime(2025, 4, 7, 13, 5)),
    ("Mon, 17 Apr 2025, 12:00 AM", dt.datetime(2025, 4, 17, 0, 0)),   # weekday not checked
    ("17 Apr 2025, 10:30 AM", None),                                  # no weekday
    ("Xyz, 17 Apr 2025, 10:30 AM", None),
    ("Mon, 31 Feb 2025, 10:30 AM", None),
    ("soon", None),
    (None, None),
])
def test_fixed_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(R.parse_fixed_ts(F.col("s"))).first()[0] == expected


@pytest.mark.parametrize("text,minutes", [
    ("01:30:30", 90.5), ("25:00:00", 1500.0), ("00:00:01.5", 0.025),
    ("-00:30:00", -30.0), ("", None), ("nan", None), (None, None),
])
def test_duration(spark, text, minutes):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(R.duration_minutes(F.col("s"))).first()[0] == minutes


@pytest.mark.parametrize("text", ["01:30", "90", "abc"])
def test_duration_rejects_other_text(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    with pytest.raises(PySparkException):
        df.select(R.duration_minutes(F.col("s"))).collect()


def test_creation_time(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00+02:00",), ("1704103200000",), (None,),
                                ("2024-01-01T10:00:00Z",)], "s string")
    got = [r[0] for r in df.select(R.parse_creation_ts(F.col("s"))).collect()]
    assert got == [dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 10), None,
                   dt.datetime(2024, 1, 1, 10)]


def test_creation_time_without_zone_fails(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",)], "s string")
    with pytest.raises(PySparkException):
        df.select(R.parse_creation_ts(F.col("s"))).collect()


def test_stringify_keeps_null(spark):
    df = spark.createDataFrame([(" 5", 1.5, None)], "id string, x double, y string")
    row = R.stringify_then_ids(df, ["id"]).first()
    assert (row.id, row.x, row.y) == (5, "1.5", None)
