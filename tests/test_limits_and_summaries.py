import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.operators import limits, reshape, summaries


def test_control_chart_masks_itself(spark):
    values = [10.0, 11.0, 9.0, 10.0, 11.0, 10.0, 100.0, 9.0, 10.0, 11.0]
    df = spark.createDataFrame(list(enumerate(values)), "x bigint, y double")
    row = limits.control_chart(df, "x", "y").first()
    assert (row["center"], row["ucl"], row["lcl"]) == pytest.approx((19.1, 104.404748, -66.204748))
    assert limits.out_of_control(limits.control_chart(df, "x", "y")).count() == 0
    assert limits.out_of_control(limits.control_chart(df, "x", "y", sigmas=2.0)).count() == 1


def test_control_chart_of_one_point(spark):
    df = spark.createDataFrame([(1, 5.0)], "x bigint, y double")
    row = limits.control_chart(df, "x", "y").first()
    assert (row["ucl"], row["out_of_control"]) == (None, False)


def test_status(spark):
    rows = [
        ("oee", 0.90, "Green"), ("oee", 0.75, "Green"), ("oee", 0.70, "Amber"), ("oee", 0.10, "Red"),
        ("not_a_kpi", 0.5, "N/A"), ("oee", None, "N/A"), ("oee", float("nan"), "N/A"),
        ("scrap_rate", 0.03, "Green"), ("scrap_rate", 0.035, "Amber"), ("scrap_rate", 0.04, "Red"),
        (None, 0.5, "N/A"),
    ]
    df = spark.createDataFrame(rows, "kpi string, value double, expected string")
    got = df.withColumn("status", limits.classify_status("value", "kpi"))
    assert [r["status"] for r in got.collect()] == [r[2] for r in rows]


def test_gauge(spark):
    df = spark.createDataFrame([(0.5,), (0.7,), (0.8,), (None,)], "oee double")
    rows = limits.gauge_bands(df, "oee", target=0.75).collect()
    assert [r["band"] for r in rows] == ["low", "middle", "high", "N/A"]
    assert rows[1]["delta_pct"] == pytest.approx(-5.0)


def test_histogram_closes_the_top_edge(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    rows = summaries.histogram(df, "x", bins=10).orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(np.histogram(np.arange(101), bins=10)[0])
    assert (rows[0]["bin_start"], rows[-1]["bin_end"]) == (0.0, 100.0)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    rows = summaries.histogram(df, "x", bins=4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 0, 0, 0]


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0), (None, 1.0)], "g string, y double")
    rows = {r["g"]: r for r in summaries.box_stats(df, ["g"], "y").collect()}
    a = rows["a"]
    assert (a["n"], a["q1"], a["median"], a["q3"]) == (5, 2.0, 3.0, 4.0)
    assert (a["whisker_low"], a["whisker_high"], a["outliers"]) == (1.0, 4.0, 1)
    assert (rows["b"]["q1"], rows["b"]["outliers"]) == (7.0, 0)
    assert set(rows) == {"a", "b"}


def test_trendline(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"))
    row = summaries.trendline(df, "x", "y").first()
    assert tuple(row) == pytest.approx((10, 2.0, 1.0, 1.0))


def test_slots(spark):
    machines = spark.createDataFrame([("m1",), ("m2",)], "id string")
    production = spark.createDataFrame(
        [("m1", dt.date(2024, 1, 1), "S1"), ("m1", dt.date(2024, 1, 3), "S2"), ("m1", dt.date(2024, 1, 3), "S2")],
        "machine_id string, date date, shift_id string",
    )
    grid = reshape.slot_grid(machines, "id", production, ["S1", "S2"])
    assert grid.count() == 2 * 3 * 2
    missing = reshape.missing_slots(grid, production)
    assert missing.count() == 10
    assert missing.filter("machine_id = 'm1'").count() == 4


def test_unpivot_and_union(spark):
    wide = spark.createDataFrame([(1, 2.0, 3), (2, None, 4)], "id bigint, temp double, rpm bigint")
    long = reshape.unpivot_sensors(wide, ["id"], ["temp", "rpm"])
    assert {tuple(r) for r in long.collect()} == {
        (1, "temp", 2.0), (1, "rpm", 3.0), (2, "temp", None), (2, "rpm", 4.0),
    }
    assert reshape.union_all([wide, wide.select("rpm", "id", "temp")]).count() == 4


def test_sensor_hourly(spark):
    rows = [("m1", "2024-01-01 10:05:00", 1.0), ("m1", "2024-01-01 10:55:00", 3.0), ("m1", "2024-01-01 11:00:00", None)]
    df = spark.createDataFrame(rows, "machine_id string, timestamp string, reading_value double").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )
    got = [tuple(r) for r in reshape.sensor_hourly(df, ["machine_id"]).collect()]
    assert got == [
        ("m1", dt.datetime(2024, 1, 1, 10), 2.0, 1.0, 3.0, 2),
        ("m1", dt.datetime(2024, 1, 1, 11), None, None, None, 0),
    ]
