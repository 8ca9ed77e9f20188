"""Queries over tables that arrive in several loads, or that are replaced while they are read."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.catalog.queries import GRAINS, RECORD, Query, rounded
from millwright.functions.expressions import month_key
from millwright.operators import kpi, membership, profiles, registry, reshape
from millwright.operators.cleaning import dedupe
from millwright.plans import refresh
from millwright.plans.plant import compute_kpis
from millwright.sources import clustered
from millwright.sources import proxies as P
from millwright.sources.staging import scratch_folder, stage
from millwright.sources.tables import load_tables, publish_set, write_kpis
from millwright.streaming import hourly

QUERIES: dict[str, Query] = {}

# The measure of each KPI table that a test of the whole set sums up.
KPI_MEASURES = {
    "production_with_kpis": "total_units_produced",
    "monthly_kpis": "total_units_produced",
    "factory_kpis": "good_units",
    "machine_kpis": "scrap_units",
    "shift_kpis": "total_units_produced",
    "mtbf_mttr_machine": "failure_count",
    "defect_rate_factory": "defective_units",
    "pareto": "count",
}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _facts(spark, sf) -> dict[str, DataFrame]:
    return {
        "production_records": P.production(spark, sf),
        "downtime_events": P.downtime(spark, sf),
        "quality_inspections": P.inspections(spark, sf),
        "defects": P.defects(spark, sf),
    }


# --- published sets -------------------------------------------------------------------------


@query
def kpi_set_published(spark, sf):
    """The KPI result set, published as CSV and read back through its manifest."""
    folder = scratch_folder(spark, "kpis")
    write_kpis(compute_kpis(_facts(spark, sf)), folder)
    back = load_tables(spark, folder)
    rows = [
        back[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(measure).cast("bigint").alias("total"),
        )
        for name, measure in KPI_MEASURES.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def table_set_after_failure(spark, sf):
    """A second publication fails in its last table: readers keep the whole first set."""
    folder = scratch_folder(spark, "set")
    first = {"readings": P.sensors(spark, sf), "machines": P.machines(spark, sf)}
    publish_set(first, folder, fmt="parquet")
    lost = F.when(F.col("machine_id") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("machine_name"))
    second = {
        "readings": first["readings"].filter("event_id % 2 = 0"),
        "machines": first["machines"].withColumn("machine_name", lost.cast("string")),
    }
    try:
        publish_set(second, folder, fmt="parquet")
    except PySparkException:
        tables = load_tables(spark, folder)
        return tables["readings"].join(tables["machines"], "machine_id", "left").select(
            "event_id", "machine_id", "reading_value", "factory_id"
        )
    raise AssertionError("the second set was published")


# --- KPIs refreshed load by load ------------------------------------------------------------


def _stored_loads(spark, sf) -> str:
    """A store with three loads: one merged into the base, one added twice, one by itself."""
    facts = _facts(spark, sf)
    days = F.dayofyear("date") % 3
    by_event, by_record = F.col("event_id") % 3, F.col("inspection_id") % 3
    parts = {
        i: {
            "production_records": facts["production_records"].filter(days == i),
            "downtime_events": facts["downtime_events"].filter(by_event == i),
            "quality_inspections": facts["quality_inspections"].filter(by_record == i),
            "defects": facts["defects"].filter(F.col("defect_id") % 3 == i),
        }
        for i in range(3)
    }
    folder = scratch_folder(spark, "sums")
    refresh.add_load(folder, "first", parts[0])
    refresh.merge_loads(spark, folder)
    # Only half of the second load at first: adding it again replaces it.
    refresh.add_load(folder, "second", {n: df.limit(10) for n, df in parts[1].items()})
    refresh.add_load(folder, "second", parts[1])
    refresh.add_load(folder, "third", parts[2])
    return folder


@query
def kpi_refreshed(spark, sf):
    """All grains from the stored sums of three loads."""
    sums = refresh.stored_sums(spark, _stored_loads(spark, sf))["production_sums"]
    merged = kpi.merge_sums_by_grain(sums.withColumn("month", month_key("date")), GRAINS)
    return rounded(kpi.finish_grains(merged, GRAINS))


@query
def mtbf_refreshed(spark, sf):
    return rounded(refresh.refreshed_kpis(spark, _stored_loads(spark, sf))["mtbf_mttr_machine"])


# --- keys across loads ----------------------------------------------------------------------


@query
def dedupe_two_loads(spark, sf):
    """Order lines in two loads; a key of the first load is not taken from the second."""
    lines = P.table(spark, sf, "lineitem")
    early = F.col("l_partkey") % 4 != 0
    kept = stage(dedupe(lines.filter(early), RECORD))
    words = membership.words_for(kept.count())
    filled = stage(membership.key_filter(kept, RECORD, words))
    return kept.unionByName(
        membership.dedupe_load(kept, lines.filter(~early), RECORD, filled, words)
    )


@query
def surrogate_keys_two_loads(spark, sf):
    """Defects in two loads, the first one sent twice: its keys are not changed by the second."""
    defects = P.defects(spark, sf)
    folder = scratch_folder(spark, "registry")
    first = defects.filter("defect_id % 3 = 0")
    for load in (first, first, defects):
        registry.register(load, ["defect_id", "defect_type"], folder)
    return registry.with_registered_keys(
        defects, ["defect_id", "defect_type"], folder, "DF", out="defect_key"
    )


# --- profiles and file pruning --------------------------------------------------------------


def _profiled(spark, sf) -> DataFrame:
    """The profile of the stoppages, from those of three loads, two of them merged."""
    folder = scratch_folder(spark, "profiles")
    stoppages = P.downtime(spark, sf)
    for k in range(3):
        profiles.add_profile(folder, f"load-{k}", stoppages.filter(F.col("event_id") % 3 == k))
        if k == 1:
            profiles.merge_stored(spark, folder)
    return profiles.stored_profile(spark, folder)


@query
def null_profile_merged(spark, sf):
    return rounded(
        profiles.null_report(_profiled(spark, sf), "downtime", max_null_pct=1.5, min_rows=50_000)
    )


@query
def column_profile_merged(spark, sf):
    """Exact counts and bounds; the estimates as whether they are within the stated error."""
    read = profiles.read_profile(_profiled(spark, sf), [0.5])
    exact = P.downtime(spark, sf)
    # Taken from all rows, to hold the estimates against.
    counts = exact.agg(*[F.count_distinct(c).alias(c) for c in exact.columns]).unpivot(
        [], exact.columns, "column_name", "distinct"
    )
    numbers = ["event_id", "machine_id", "duration_minutes"]
    ranks = read.filter(F.col("column_name").isin(numbers)).select("column_name", "q50")
    below = exact.select(*[F.col(c).cast("double") for c in numbers]).unpivot([], numbers, "column_name", "v")
    share = (
        below.join(F.broadcast(ranks), "column_name")
        .groupBy("column_name")
        .agg(
            F.avg((F.col("v") < F.col("q50")).cast("double")).alias("under"),
            F.avg((F.col("v") <= F.col("q50")).cast("double")).alias("upto"),
        )
    )
    close = F.abs(F.col("distinct_estimate") - F.col("distinct")) <= 0.08 * F.col("distinct")
    middle = (F.col("under") <= 0.54) & (F.col("upto") >= 0.46)
    return (
        read.join(counts, "column_name")
        .join(share, "column_name", "left")
        .select(
            "column_name", "row_count", "null_count", "min_value", "max_value",
            close.alias("distinct_close"), F.coalesce(middle, F.lit(True)).alias("median_close"),
        )
    )


def _clustered(spark, sf) -> str:
    folder = scratch_folder(spark, "clustered")
    clustered.write_clustered(
        P.sensors(spark, sf), folder, ["timestamp", "event_id"], files=16, bloom=["machine_id"]
    )
    return folder


@query
def tail_extract_clustered(spark, sf):
    """The last rows from the last files alone."""
    last = clustered.read_last(spark, _clustered(spark, sf), 100)
    return reshape.tail_extract(last, ["timestamp", "event_id"], 100)


@query
def sensor_hourly_period(spark, sf):
    """The hourly rollup of the last quarter of the time, from the files that hold it."""
    folder = _clustered(spark, sf)
    first, last = clustered.file_index(spark, folder).agg(F.min("low"), F.max("high")).first()
    readings = clustered.read_range(spark, folder, "timestamp", low=first + (last - first) * 0.75)
    return rounded(reshape.sensor_hourly(readings, ["machine_id", "sensor_type"]))


# --- the hourly rollup of a stream ----------------------------------------------------------

SLICES = 4


@query
def sensor_hourly_stream(spark, sf):
    """Readings delivered in slices of time: every fifth one a slice late, every seventh twice."""
    readings = stage(P.sensors(spark, sf))
    first, last = readings.agg(F.min("timestamp"), F.max("timestamp")).first()
    width = (last - first).total_seconds() / SLICES + 1
    passed = F.unix_timestamp("timestamp") - F.lit(int(first.timestamp()))
    due = F.floor(F.greatest(passed, F.lit(0)) / width).cast("int")
    late = F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    again = F.when(F.col("event_id") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    delivered = readings.withColumn("_repeat", F.explode(again)).withColumn(
        "_slice", due + late + F.col("_repeat")
    )
    feed = scratch_folder(spark, "feed")
    for k in range(SLICES + 2):
        part = delivered.filter(F.col("_slice") == k).select(*readings.columns)
        part.coalesce(2).write.mode("append").parquet(feed)
    stream = (
        spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 2).parquet(feed)
    )
    keys = ["machine_id", "sensor_type"]
    updates = hourly.hourly_updates(
        stream, keys, identity=["event_id"], lateness=f"{int(3 * width)} seconds"
    )
    sink = scratch_folder(spark, "hourly")
    hourly.write_updates(updates, sink, scratch_folder(spark, "progress")).awaitTermination()
    return rounded(hourly.read_updates(spark, sink, keys))
