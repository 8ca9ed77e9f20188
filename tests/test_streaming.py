"""The streamed rollup against the batch one, with late, repeated and replayed readings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millwright.operators.reshape import sensor_hourly
from millwright.streaming import hourly

DDL = "event_id bigint, machine_id string, timestamp timestamp_ntz, reading_value double, part int"
START = dt.datetime(2024, 3, 30, 22, 0)
KEYS = ["machine_id"]


def readings(n=400, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        value = rng.choice([None, float("nan"), *[rng.random() * 50] * 8])
        machine = rng.choice(["hot", "hot", "m1", "m2", None])
        rows.append((i, machine, START + dt.timedelta(minutes=rng.randrange(600)), value))
    return sorted(rows, key=lambda r: r[2])


class Feed:
    """A folder that gets files one after the other, and a stream that has read some of them."""

    def __init__(self, spark, folder, lateness):
        self.spark, self.folder, self.lateness = spark, folder, lateness

    def add(self, rows):
        df = self.spark.createDataFrame([(*r, 0) for r in rows], DDL)
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/feed")

    def run(self, checkpoint="progress"):
        schema = self.spark.createDataFrame([], DDL).schema
        stream = (
            self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/feed")
        )
        updates = hourly.hourly_updates(stream, KEYS, identity=["event_id"], lateness=self.lateness)
        query = hourly.write_updates(updates, f"{self.folder}/out", f"{self.folder}/{checkpoint}")
        query.awaitTermination()
        return query

    def result(self):
        return rows_of(hourly.read_updates(self.spark, f"{self.folder}/out", KEYS))


def rows_of(df):
    out = []
    for r in df.collect():
        out.append((r.machine_id, r.hour, *(x if x is None else round(x, 9) for x in r[2:])))
    return sorted(out, key=repr)


def batch(spark, rows):
    return rows_of(sensor_hourly(spark.createDataFrame([(*r, 0) for r in rows], DDL), KEYS))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path, "20 hours")


def test_late_and_repeated_readings_count_once(spark, feed):
    rows = readings()
    rng = random.Random(1)
    files = [[] for _ in range(6)]
    for i, row in enumerate(rows):
        k = i * 4 // len(rows)
        files[k + rng.choice([0, 0, 1])].append(row)
        if i % 6 == 0:
            files[k + rng.choice([0, 1, 2])].append(row)
    for part in files[:3]:
        feed.add(part)
    feed.run()
    # The stream goes on from its checkpoint, in another run.
    for part in files[3:]:
        feed.add(part)
    query = feed.run()
    assert hourly.dropped_rows(query) == 0
    assert feed.result() == batch(spark, rows)


def test_readings_behind_the_watermark_are_dropped_and_counted(spark, tmp_path):
    feed = Feed(spark, tmp_path, "1 hour")
    early = [(1, "m", START, 5.0), (2, "m", START + dt.timedelta(hours=9), 7.0)]
    feed.add(early)
    feed.run()
    feed.add([(3, "m", START + dt.timedelta(minutes=5), 99.0), (4, "m", START + dt.timedelta(hours=9), 9.0)])
    query = feed.run()
    assert hourly.dropped_rows(query) >= 1
    assert feed.result() == batch(spark, [*early, (4, "m", START + dt.timedelta(hours=9), 9.0)])


def test_a_batch_that_is_run_again_replaces_what_it_wrote(spark, feed):
    rows = readings(120, 3)
    for low in range(0, 120, 40):
        feed.add(rows[low : low + 40])
    feed.run()
    once = feed.result()
    # All progress is lost, the sink is not: every batch is written again, in the same place.
    feed.run(checkpoint="progress-2")
    assert feed.result() == once == batch(spark, rows)
    written = spark.read.parquet(f"{feed.folder}/out")
    assert written.select(hourly.BATCH).distinct().count() == 3


def test_state_is_given_up_behind_the_watermark(spark, tmp_path):
    feed = Feed(spark, tmp_path, "1 hour")
    for day in range(3):
        feed.add([(100 * day + i, "m", START + dt.timedelta(days=day, minutes=i), 1.0) for i in range(50)])
    query = feed.run()
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    assert max(o["numRowsTotal"] for o in operators) <= 100


def test_hours_do_not_depend_on_the_time_zone(spark, feed):
    """The night in which clocks change has all its hours, also in a zone where they do."""
    rows = [(i, "m", START + dt.timedelta(minutes=30 * i), float(i)) for i in range(20)]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        feed.add(rows)
        feed.run()
        got = feed.result()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == batch(spark, rows)
    assert len(got) == 10


def test_updates_read_the_columns_they_need(spark):
    stream = spark.readStream.format("rate").load().select(
        F.col("value").alias("event_id"), F.lit("m").alias("machine_id"), "timestamp",
        F.col("value").cast("double").alias("reading_value"), F.lit("x").alias("extra"),
    )
    updates = hourly.hourly_updates(stream, KEYS, identity=["event_id"])
    assert updates.isStreaming
    assert updates.columns == ["machine_id", "hour", *hourly.MEASURES]
    assert dict(updates.dtypes)["hour"] == "timestamp_ntz"
