import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from millwright.functions import expressions as X


def one(spark, column, **values):
    df = spark.range(1)
    for name, (value, kind) in values.items():
        df = df.withColumn(name, F.lit(value).cast(kind))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("n", "d", "expected"),
    [
        (1.0, 0.0, 0.0),
        (0.0, 0.0, 0.0),
        (None, 2.0, 0.0),
        (2.0, None, 0.0),
        (math.nan, 2.0, 0.0),
        (math.inf, 2.0, 0.0),
        (1e308, 1e-10, 0.0),
        (-3.0, 2.0, -1.5),
    ],
)
def test_safe_div(spark, n, d, expected):
    assert one(spark, X.safe_div("n", "d"), n=(n, "double"), d=(d, "double")) == expected


def test_safe_div_of_whole_numbers(spark):
    assert one(spark, X.safe_div("n", "d"), n=(1, "bigint"), d=(4, "bigint")) == 0.25
    assert one(spark, X.safe_div("n", "d"), n=(1, "bigint"), d=(0, "bigint")) == 0.0


def test_clamps_keep_null_and_nan(spark):
    assert one(spark, X.clamp_min("v", 0), v=(None, "double")) is None
    assert one(spark, X.clamp_max("v", 1.5), v=(None, "double")) is None
    assert math.isnan(one(spark, X.clamp_max("v", 1.5), v=(math.nan, "double")))
    assert math.isnan(one(spark, X.clamp_min("v", 0), v=(math.nan, "double")))
    assert one(spark, X.clamp_min("v", 0), v=(-5, "bigint")) == 0
    assert one(spark, X.clamp_max("v", 1.5), v=(2.0, "double")) == 1.5


def weighted(spark, rows):
    df = spark.createDataFrame(rows, "v double, w double")
    return df.agg(X.weighted_avg("v", "w").alias("x")).first()["x"]


def test_weighted_avg_counts_the_weight_of_missing_values(spark):
    assert weighted(spark, [(1.0, 2.0), (None, 2.0)]) == 0.5
    assert weighted(spark, [(1.0, 2.0), (5.0, None)]) == 1.0


def test_weighted_avg_without_weight_is_null(spark):
    assert weighted(spark, [(1.0, 0.0)]) is None
    assert weighted(spark, [(1.0, None)]) is None
    assert weighted(spark, [(None, 3.0)]) == 0.0


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (" 10 ", 10.0),
        ("1e3", 1000.0),
        ("-2.5", -2.5),
        ("1d", None),
        ("2.5f", None),
        ("3.D", None),
        ("not_a_number", None),
        ("nan", None),
        ("", None),
        (None, None),
    ],
)
def test_to_number(spark, text, expected):
    assert one(spark, X.to_number("t"), t=(text, "string")) == expected


def test_to_timestamp(spark):
    day = dt.datetime(2024, 3, 31, 2, 30)
    assert one(spark, X.to_timestamp("t"), t=("2024-03-31T02:30:00", "string")) == day
    assert one(spark, X.to_timestamp("t"), t=("31 March", "string")) is None
    parsed = X.to_timestamp("t", "dd/MM/yyyy HH:mm")
    assert one(spark, parsed, t=("31/03/2024 02:30", "string")) == day
    assert one(spark, parsed, t=("2024-03-31", "string")) is None


@pytest.mark.parametrize(
    ("start", "end", "hours"),
    [("06:00", "14:00", 8.0), ("22:00", "06:00", 8.0), ("07:00", "07:00", 24.0), ("23:45", "00:15", 0.5)],
)
def test_shift_hours(spark, start, end, hours):
    got = one(spark, X.shift_hours("s", "e"), s=(start, "string"), e=(end, "string"))
    assert got == hours


def test_add_months_caps_the_day(spark):
    moved = X.add_months_capped("d", 1)
    assert one(spark, moved, d=("2024-01-31", "date")) == dt.date(2024, 2, 28)
    assert one(spark, moved, d=("2024-12-05", "date")) == dt.date(2025, 1, 5)
    assert one(spark, X.add_months_capped("d", 2), d=("2024-01-30", "date")) == dt.date(2024, 3, 28)


def test_padded_key_keeps_wide_numbers(spark):
    key = X.padded_key("PR", "n")
    assert one(spark, key, n=(42, "bigint")) == "PR0000042"
    assert one(spark, key, n=(123456789, "bigint")) == "PR123456789"


def test_text_forms(spark):
    assert one(spark, X.percent_text("v"), v=(0.8125, "double")) == "81.2%"
    assert one(spark, X.percent_text("v"), v=(0.8135, "double")) == "81.4%"
    assert one(spark, X.month_key("d"), d=("2024-07-09", "date")) == "2024-07"
    assert one(spark, X.month_key("d"), d=(None, "date")) is None
    assert one(spark, X.is_weekend("d"), d=("2024-01-06", "date")) is True
    assert one(spark, X.is_weekend("d"), d=("2024-01-05", "date")) is False


def test_hour_of_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = one(spark, X.hour_of("t"), t=("2024-01-01 05:59:59.5", "timestamp_ntz"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(2024, 1, 1, 5)


def test_map_lookup(spark):
    assert one(spark, X.map_lookup("k", {"a": 1, "b": 2}), k=("b", "string")) == 2
    assert one(spark, X.map_lookup("k", {"a": 1}), k=("z", "string")) is None
    assert one(spark, X.map_lookup("k", {"a": 1}), k=(None, "string")) is None
