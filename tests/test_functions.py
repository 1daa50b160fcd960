"""Scalar expressions on hand-made values, above all nulls and odd text."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.functions import calendar, numeric, text, values


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(1, None), (2, "plain"), (3, "a/b/c"), (4, ""), (5, "12345678.0")]
    return spark.createDataFrame(rows, "id bigint, s string")


def _column(df, expression):
    return [r[0] for r in df.orderBy("id").select(expression).collect()]


def test_part_beyond_the_end_is_null(texts):
    assert _column(texts, text.part(F.col("s"), "/", 1)) == [None, None, "b", None, None]
    assert _column(texts, text.part(F.col("s"), "/", 0)) == [None, "plain", "a", "", "12345678.0"]
    assert _column(texts, text.part(F.col("s"), "/", -1)) == [None, "plain", "c", "", "12345678.0"]


def test_separator_is_not_a_pattern(texts):
    assert _column(texts, text.part(F.col("s"), ".", 1)) == [None, None, None, None, "0"]


@pytest.mark.parametrize("value", [
    None, 0.0, 1.0, -3.0, 12345678.0, 0.5, -68.51, 1234567.891, 12345678.25, 0.0001, 0.00012345, 1e-05, 2.5e-07, 1e16, 2e20, -4e-9,
])
def test_number_text_is_python_text(spark, value):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(text.as_text("x", T.DoubleType())).first()[0] == ("nan" if value is None else str(value))


def test_nan_integer_and_boolean_text(spark):
    df = spark.createDataFrame([(float("nan"), 7, True)], "x double, i int, b boolean")
    texts = [text.as_text(f.name, f.dataType) for f in df.schema.fields]
    assert list(df.select(*texts).first()) == ["nan", "7", "True"]


def test_joined_text_keeps_nulls(spark):
    df = spark.createDataFrame([(None, "x"), (12345678.0, None)], "a double, b string")
    assert [r[0] for r in df.select(text.joined_text(df.schema, ["a", "b"])).collect()] == ["nan_x", "12345678.0_nan"]


def test_device_rules(spark):
    names = ["SM-G610M", "SAMSUNG", "GT-I9", "Moto G (4)", "moto e5", "LG-K10", "rv:57.0", "ALE-L23", "HTC Desire", "XT1", "Other", None]
    expected = ["Samsung", "Samsung", "Samsung", "Motorola", "Motorola", "LG", "RV", "Huawei", "HTC", "Sony", "Other", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, s string")
    assert _column(df, text.classify(F.col("s"), text.DEVICE_RULES)) == expected


def test_mail_suffix_and_screen_and_level(spark):
    df = spark.createDataFrame([(1, "gmail", "2220x1080", "match_status:2"), (2, "yahoo.com.mx", None, "match_status:0"),
                                (3, None, "bad", None)], "id int, mail string, screen string, level string")
    width, height = text.screen_size(F.col("screen"))
    assert _column(df, text.suffix_group(F.col("mail"))) == ["us", "mx", "nan"]
    assert _column(df, width) == [2220, 0, 0]
    assert _column(df, height) == [1080, 0, 0]
    assert _column(df, text.trailing_number(F.col("level"))) == [2, None, None]


def test_latest_browser_flag_is_set(spark):
    df = spark.createDataFrame([(1, "chrome 65.0"), (2, "chrome 12.0"), (3, None)], "id int, id_31 string")
    assert _column(df, values.known_value_flag(F.col("id_31"), values.LATEST_BROWSERS)) == [1, 0, 0]


def test_unlisted_level_is_null(spark):
    df = spark.createDataFrame([(1, "T"), (2, "F"), (3, "?"), (4, None)], "id int, m string")
    assert _column(df, values.constant_map(F.col("m"), values.TRUE_FALSE)) == [1, 0, None, None]


def test_amount_digits_truncate(spark):
    df = spark.createDataFrame([(1, 68.51), (2, 29.0), (3, None), (4, 117.999)], "id int, x double")
    assert _column(df, numeric.amount_decimals("x")) == [int((v - int(v)) * 1000) if v else None for v in (68.51, 29.0, None, 117.999)]
    assert _column(df.withColumn("x", F.col("x") * 0), numeric.natural_log("x")) == [None] * 4


def test_offsets(spark):
    seconds = [0, 86400, 86399, 15811131, 3600 * 24 * 9 + 5]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seconds)], "id int, s bigint")
    assert _column(df, calendar.offset_weekday(F.col("s"))) == [int((s / 86400 - 1) % 7) for s in seconds]
    assert _column(df, calendar.offset_hour(F.col("s"))) == [s // 3600 % 24 for s in seconds]
    moments = _column(df, calendar.offset_timestamp(F.col("s")))
    assert moments[0] == datetime(2017, 12, 1)
    assert [int((m - datetime(2017, 12, 1)).total_seconds()) for m in moments] == seconds
    assert _column(df.where("id = 0"), calendar.month_number(calendar.offset_timestamp(F.col("s")))) == [12]


def test_row_shares(spark):
    df = spark.createDataFrame([(1, 0.0, None, "a"), (2, None, None, None), (3, 0.0, 0.0, "0")], "id int, a double, b double, c string")
    cells = ["a", "b", "c"]
    assert _column(df, numeric.null_share(cells)) == [1 / 3, 1.0, 0.0]
    assert _column(df, numeric.zero_share(cells, ["a", "b"])) == [0.5, None, 2 / 3]
