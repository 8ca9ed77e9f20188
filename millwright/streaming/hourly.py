"""The hourly sensor rollup over readings that keep arriving.

Readings are deduplicated and rolled up in state; each micro-batch puts out the hours it changed, as
they are now. The sink writes what a batch put out into a folder named after the batch, replacing
what an earlier attempt at the same batch may have left, so a batch that is run again after a
failure leaves the same rows. Reading the sink takes the newest row of each key and hour.

A watermark bounds the state: a reading later than ``lateness`` behind the newest one seen is
dropped (and counted in the progress of the query), and a repeated reading is known for as long.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwright.functions.expressions import nan_to_null
from millwright.operators.kpi import with_known_keys

BATCH = "_batch"
# Microseconds.
DAY = 86_400_000_000
MEASURES = ("mean_value", "min_value", "max_value", "n_readings")


def _as_instant(time: str) -> Column:
    """The clock's time as an instant of a zone without shifts: watermarks know instants only."""
    clock = F.col(time).cast("timestamp_ntz")
    day = F.unix_date(clock.cast("date")).cast("bigint") * DAY
    minutes = (F.hour(clock) * 60 + F.minute(clock)).cast("bigint")
    seconds = (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("bigint")
    return F.timestamp_micros(day + minutes * 60_000_000 + seconds)


def _hour_on_clock(instant: Column) -> Column:
    """The full hour that :func:`_as_instant` made an instant of."""
    micros = F.unix_micros(instant)
    day = F.date_from_unix_date(F.floor(micros / DAY).cast("int"))
    hour = F.floor(F.pmod(micros, F.lit(DAY)) / 3_600_000_000).cast("int")
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), hour, zero, zero)


def hourly_updates(
    readings: DataFrame,
    keys: Sequence[str],
    *,
    identity: Sequence[str],
    lateness: str = "1 day",
    time: str = "timestamp",
    value: str = "reading_value",
) -> DataFrame:
    """Mean, minimum, maximum and count per key and hour of a stream, deduplicated by ``identity``.

    Rows without a key or a time belong to no hour. A missing value (null or NaN) counts towards
    no measure, but its hour is there. Hours are those of the clock on the wall.
    """
    known = with_known_keys(readings, [*keys, time]).withColumns(
        {"_value": nan_to_null(value), "_event": _as_instant(time)}
    )
    once = known.withWatermark("_event", lateness).dropDuplicatesWithinWatermark(list(identity))
    hourly = once.groupBy(*keys, F.window("_event", "1 hour").alias("_hour")).agg(
        F.avg("_value").alias("mean_value"),
        F.min("_value").alias("min_value"),
        F.max("_value").alias("max_value"),
        F.count("_value").alias("n_readings"),
    )
    return hourly.select(*keys, _hour_on_clock(F.col("_hour.start")).alias("hour"), *MEASURES)


def write_updates(
    updates: DataFrame, directory: str, checkpoint: str, *, available_now: bool = True
) -> StreamingQuery:
    """Start writing a stream's updates, one folder per batch.

    With ``available_now`` the query ends by itself once it has read what is there; it goes on from
    the checkpoint when started again.
    """
    base = directory.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/{BATCH}={number}")

    writer = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write).start()


def read_updates(spark: SparkSession, directory: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key and hour; one shuffle, of at most a row per task, key and hour."""
    written = spark.read.parquet(directory)
    newest = F.max_by(F.struct(*MEASURES), BATCH).alias("_newest")
    return written.groupBy(*keys, "hour").agg(newest).select(*keys, "hour", "_newest.*")


def dropped_rows(query: StreamingQuery) -> int:
    """Readings that came too late, as far back as the query's recent progress goes."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
