"""One query per operator, each over whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from millwright.functions import expressions as X
from millwright.operators import checks, cleaning, kpi, limits, ordered, reshape, summaries
from millwright.operators.ordered import fill_gaps
from millwright.plans.plant import clean_tables, compute_kpis, kpi_summary
from millwright.settings import Settings
from millwright.sources import proxies as P
from millwright.sources.staging import scratch_folder
from millwright.sources.tables import load_tables, table_overview, write_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SAMPLE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
SENSOR_UNITS = {"click": "count", "view": "s", "purchase": "eur"}  # signup and error have none
RECORD = ["l_orderkey", "l_linenumber"]
GRAINS = ("month", "factory_id", "machine_id", "shift_id")
# Sums of minutes are exact to a few decimals only, because their order of addition varies.
COARSE = 3
COARSE_COLUMNS = (
    "planned_production_time_minutes",
    "run_time_minutes",
    "downtime_minutes",
    "total_run_time_minutes",
    "total_downtime_minutes",
    "recorded_minutes",
    "event_minutes",
    "difference_minutes",
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the doubles of a result, so that results of two engines can be compared."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns(
        {c: F.round(c, COARSE if c in COARSE_COLUMNS else digits) for c in doubles}
    )


def with_oee(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.with_month(kpi.add_oee_components(P.production(spark, sf)))


# --- sources --------------------------------------------------------------------------------


@query
def scan_tables(spark, sf):
    return table_overview(load_tables(spark, sf, fmt="parquet", names=SAMPLE_TABLES))


@query
def csv_round_trip(spark, sf):
    """Texts with quotes, commas and line breaks, written as CSV and read back."""
    folder = scratch_folder(spark, "csv")
    texts = P.table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit('say "so", \\'), "text").alias("text"), "lang"
    )
    tables = {"nation": P.table(spark, sf, "nation"), "notes": texts}
    write_tables(tables, folder)
    back = load_tables(spark, folder, {}, multi_line=True, infer=True)
    notes = back["notes"].select(F.col("doc_id").alias("id"), F.md5("text").alias("body"), "lang")
    nations = back["nation"].select(
        F.col("n_nationkey").alias("id"), F.md5("n_name").alias("body"), F.lit("nation").alias("lang")
    )
    return notes.unionByName(nations)


# --- row expressions ------------------------------------------------------------------------


@query
def safe_divide(spark, sf):
    return P.production(spark, sf).select(
        *RECORD,
        X.safe_div("run_time_minutes", "planned_production_time_minutes").alias("run_share"),
        X.safe_div("total_units_produced", "downtime_minutes").alias("units_per_stop_minute"),
    )


@query
def oee_components(spark, sf):
    measures = [
        "availability",
        "performance",
        "quality",
        "oee",
        "scrap_rate",
        "cycle_time_actual_seconds",
        "utilization",
        "throughput_units_per_hour",
    ]
    df = kpi.add_oee_components(P.production(spark, sf))
    return df.select(*RECORD, "machine_id", *measures)


@query
def date_functions(spark, sf):
    lines = P.table(spark, sf, "lineitem")
    day = F.col("l_shipdate").cast("date")
    later = X.add_minutes("l_shipdate", F.col("l_quantity") * 17)
    return lines.select(
        *RECORD,
        X.add_months_capped(day, 7).alias("seven_months_on"),
        X.is_weekend(day).alias("weekend"),
        F.dayofyear(day).alias("day_of_year"),
        X.month_key(day).alias("month"),
        later.alias("later"),
        X.hour_of(later).alias("hour"),
    )


@query
def shift_hours(spark, sf):
    end = X.add_minutes("ts", F.floor("value"))
    clocks = P.table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "HH:mm").alias("start_time"),
        F.date_format(end, "HH:mm").alias("end_time"),
    )
    return rounded(clocks.withColumn("duration_hours", X.shift_hours("start_time", "end_time")))


@query
def material_downtime(spark, sf):
    kept = kpi.material_downtime(P.production(spark, sf), threshold=5.0)
    return kept.select(*RECORD, "machine_id", F.round("downtime_minutes", 6).alias("minutes"))


# --- KPI rollups ----------------------------------------------------------------------------


@query
def weighted_avg(spark, sf):
    df = P.production(spark, sf)
    return rounded(
        df.groupBy("machine_id").agg(
            X.weighted_avg("downtime_minutes", "planned_production_time_minutes").alias("by_plan"),
            X.weighted_avg("ideal_cycle_time_seconds", "downtime_minutes").alias("by_downtime"),
        )
    )


@query
def kpi_by_factory(spark, sf):
    return rounded(kpi.aggregate_kpis(with_oee(spark, sf), ["factory_id"]))


@query
def kpi_by_machine(spark, sf):
    return rounded(kpi.aggregate_kpis(with_oee(spark, sf), ["machine_id"]))


@query
def kpi_by_shift(spark, sf):
    return rounded(kpi.aggregate_kpis(with_oee(spark, sf), ["shift_id"]))


@query
def kpi_monthly(spark, sf):
    return rounded(kpi.aggregate_kpis(with_oee(spark, sf), ["month"])).orderBy("month")


@query
def kpi_factory_month(spark, sf):
    return rounded(kpi.aggregate_kpis(with_oee(spark, sf), ["factory_id", "month"]))


@query
def kpi_all_grains(spark, sf):
    return rounded(kpi.aggregate_kpis_by_grain(with_oee(spark, sf), GRAINS))


@query
def kpi_trend_series(spark, sf):
    monthly = kpi.aggregate_kpis(with_oee(spark, sf), ["month"])
    return rounded(kpi.series(monthly, "month", "oee"))


@query
def kpi_percent_table(spark, sf):
    return kpi.percent_table(kpi.aggregate_kpis(with_oee(spark, sf), ["factory_id"]), ["factory_id"])


@query
def kpi_heatmap(spark, sf):
    matrix = kpi.weighted_matrix(
        with_oee(spark, sf),
        "factory_id",
        "shift_id",
        [0, 1, 2],
        "oee",
        "planned_production_time_minutes",
    )
    named = matrix.select("factory_id", *[F.col(str(s)).alias(f"shift_{s}") for s in (0, 1, 2)])
    return rounded(named)


@query
def headline_kpis(spark, sf):
    return rounded(kpi.headline_kpis(with_oee(spark, sf)))


# --- reliability and quality ----------------------------------------------------------------


def _mtbf(spark, sf):
    return kpi.calculate_mtbf_mttr(P.downtime(spark, sf), P.production(spark, sf), ["machine_id"])


@query
def mtbf_mttr(spark, sf):
    return rounded(_mtbf(spark, sf))


@query
def worst_mtbf_topk(spark, sf):
    return rounded(kpi.least_reliable(_mtbf(spark, sf), 10))


@query
def worst_mtbf_failing_topk(spark, sf):
    return rounded(kpi.least_reliable(_mtbf(spark, sf), 10, failing_only=True))


@query
def defect_rate(spark, sf):
    return rounded(kpi.calculate_defect_rate(P.inspections(spark, sf), ["factory_id"]))


@query
def pareto(spark, sf):
    return rounded(kpi.pareto_analysis(P.defects(spark, sf)))


@query
def pareto_vital_few(spark, sf):
    return rounded(kpi.vital_few(kpi.pareto_analysis(P.defects(spark, sf))))


# --- joins and reshaping --------------------------------------------------------------------


@query
def lookup_join(spark, sf):
    readings = P.sensors(spark, sf)
    with_unit = reshape.lookup(readings, "sensor_type", SENSOR_UNITS, "unit")
    located = reshape.lookup_dimension(
        with_unit, P.machines(spark, sf), "machine_id", ["factory_id"]
    )
    return located.select("event_id", "machine_id", "sensor_type", "unit", "factory_id")


@query
def fk_orphans(spark, sf):
    return checks.orphans(P.downtime(spark, sf), P.machines(spark, sf), "machine_id")


@query
def slot_coverage(spark, sf):
    gaps = reshape.missing_intervals(
        P.machines(spark, sf), "machine_id", P.production(spark, sf), [0, 1, 2]
    )
    return gaps.groupBy("machine_id", "shift_id").agg(
        F.sum("days").alias("missing_slots"),
        F.min("first").alias("first_missing"),
        F.max("last").alias("last_missing"),
    )


@query
def slot_gaps(spark, sf):
    """Each stretch of days that a machine's shift does not report."""
    return reshape.missing_intervals(
        P.machines(spark, sf), "machine_id", P.production(spark, sf), [0, 1, 2]
    )


@query
def slot_grid(spark, sf):
    """The slots one by one, for a few machines' worth of checks by hand."""
    production = P.production(spark, sf)
    grid = reshape.slot_grid(P.machines(spark, sf), "machine_id", production, [0, 1, 2])
    return reshape.missing_slots(grid, production).groupBy("date").agg(
        F.count(F.lit(1)).alias("missing_slots")
    )


@query
def union_all(spark, sf):
    recorded = P.production(spark, sf).select(
        "machine_id", F.col("downtime_minutes").alias("minutes"), F.lit("record").alias("origin")
    )
    logged = P.downtime(spark, sf).select(
        "machine_id", F.col("duration_minutes").alias("minutes"), F.lit("event").alias("origin")
    )
    return rounded(reshape.union_all([recorded, logged]))


@query
def unpivot_sensors(spark, sf):
    wide = P.table(spark, sf, "lineitem")
    return reshape.unpivot_sensors(wide, RECORD, ["l_quantity", "l_extendedprice", "l_discount"])


@query
def expand_units(spark, sf):
    units = reshape.expand_units(P.inspections(spark, sf), "defective_units")
    return units.select("inspection_id", "factory_id", "unit_no")


@query
def roster_by_factory(spark, sf):
    return reshape.roster(P.machines(spark, sf), "factory_id", "machine_id")


@query
def surrogate_keys(spark, sf):
    return reshape.surrogate_keys(
        P.defects(spark, sf), "DF", ["defect_id", "defect_type"], out="defect_key"
    )


@query
def tail_extract(spark, sf):
    return reshape.tail_extract(P.sensors(spark, sf), ["timestamp", "event_id"], 100)


@query
def tail_extract_large(spark, sf):
    """The spreadsheet row limit: at larger scale factors it does cut the table."""
    ids = P.table(spark, sf, "lineitem").select(*RECORD, "l_partkey", "l_suppkey", "l_quantity")
    return reshape.tail_extract(ids, ids.columns, 20_000)


@query
def sensor_hourly(spark, sf):
    return rounded(reshape.sensor_hourly(P.sensors(spark, sf), ["machine_id", "sensor_type"]))


@query
def sensor_hourly_nan(spark, sf):
    """Readings of NaN are missing ones."""
    readings = P.sensors(spark, sf).withColumn(
        "reading_value",
        F.when(F.col("event_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("reading_value")),
    )
    return rounded(reshape.sensor_hourly(readings, ["machine_id", "sensor_type"]))


@query
def running_sum(spark, sf):
    """Running sums with gaps; a third of the rows are under one key."""
    readings = P.sensors(spark, sf).select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("machine_id")).alias("k"),
        F.when(F.col("event_id") % 10 == 0, F.lit(1).cast("bigint")).alias("v"),
    )
    return ordered.running_sum(readings, "v", ["event_id"], partition_by=["k"])


# --- cleaning -------------------------------------------------------------------------------

PRODUCTION_SPEC = replace(cleaning.FACT_SPECS["production_records"], order_by=RECORD)
DOWNTIME_SPEC = cleaning.FACT_SPECS["downtime_events"]
QUALITY_SPEC = cleaning.FACT_SPECS["quality_inspections"]
DEFECTS_SPEC = cleaning.FACT_SPECS["defects"]
SENSOR_SPEC = replace(cleaning.FACT_SPECS["sensor_readings"], order_by=["timestamp", "event_id"])


def _clean(df, spec, **settings):
    return cleaning.clean(df, spec, Settings(**settings))


@query
def clean_coerce(spark, sf):
    coerced = cleaning.coerce_types(
        P.raw_events(spark, sf), date_cols=["time_text"], numeric_cols=["reading_text"]
    )
    return coerced.select("event_id", "reading_text", "time_text")


@query
def clean_dedupe(spark, sf):
    return cleaning.dedupe(P.table(spark, sf, "lineitem"), RECORD)


@query
def clean_dedupe_gaps(spark, sf):
    """Of several readings under one key the one with a value stays."""
    return cleaning.dedupe(P.repeated_sensors(spark, sf), ["machine_id", "sensor_type", "timestamp"])


@query
def clean_missing_median(spark, sf):
    filled = cleaning.fill_median(P.production(spark, sf), ["downtime_minutes", "run_time_minutes"])
    return filled.select(*RECORD, "machine_id", F.round("downtime_minutes", 6).alias("minutes"))


@query
def clean_missing_mean(spark, sf):
    filled = cleaning.fill_mean(P.production(spark, sf), ["downtime_minutes", "run_time_minutes"])
    return filled.select(*RECORD, "machine_id", F.round("downtime_minutes", 6).alias("minutes"))


@query
def clean_missing_ffill(spark, sf):
    return fill_gaps(P.sensors(spark, sf), ["reading_value"], ["timestamp", "event_id"])


@query
def clean_missing_ffill_by_machine(spark, sf):
    return fill_gaps(
        P.sensors(spark, sf),
        ["reading_value"],
        ["timestamp", "event_id"],
        partition_by=["machine_id"],
    )


@query
def clean_missing_drop(spark, sf):
    spec = cleaning.CleanSpec("production", numeric_cols=("downtime_minutes",))
    kept, _ = cleaning.impute(P.production(spark, sf), spec, "drop")
    return kept.select(*RECORD, "machine_id", F.round("downtime_minutes", 6).alias("minutes"))


@query
def clean_sentinel(spark, sf):
    readings = P.raw_events(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 50 != 0, F.col("event_type")).alias("reason_code"),
        "operator_id",
    )
    return cleaning.fill_sentinel(readings, category_cols=["reason_code"])


@query
def clean_outliers(spark, sf):
    return cleaning.flag_outliers(P.sensors(spark, sf), ["reading_value"])


@query
def clean_non_negative(spark, sf):
    clamped = cleaning.enforce_non_negative(P.production(spark, sf), ["downtime_minutes"])
    return clamped.select(*RECORD, "machine_id", F.round("downtime_minutes", 6).alias("minutes"))


@query
def clean_production(spark, sf):
    return rounded(_clean(P.production(spark, sf), PRODUCTION_SPEC)[0])


@query
def clean_kpi_by_factory(spark, sf):
    """The way from raw records to a KPI table: clean, rate each record, roll up."""
    cleaned = _clean(P.production(spark, sf), PRODUCTION_SPEC)[0]
    return rounded(kpi.aggregate_kpis(kpi.add_oee_components(cleaned), ["factory_id"]))


def _plant_kpis(spark, sf):
    """The whole way from raw tables to KPI tables."""
    tables = {
        "production_records": P.production(spark, sf),
        "downtime_events": P.downtime(spark, sf),
        "quality_inspections": P.inspections(spark, sf),
        "defects": P.defects(spark, sf),
        "factories": P.table(spark, sf, "nation"),
    }
    specs = {**cleaning.FACT_SPECS, "production_records": PRODUCTION_SPEC}
    return compute_kpis(clean_tables(tables, Settings(), specs)[0])


@query
def plant_factory_kpis(spark, sf):
    return rounded(_plant_kpis(spark, sf)["factory_kpis"])


@query
def plant_pareto(spark, sf):
    return rounded(_plant_kpis(spark, sf)["pareto"])


@query
def plant_defect_rate(spark, sf):
    return rounded(_plant_kpis(spark, sf)["defect_rate_factory"])


@query
def clean_downtime(spark, sf):
    return rounded(_clean(P.downtime(spark, sf), DOWNTIME_SPEC)[0])


@query
def clean_quality(spark, sf):
    return rounded(_clean(P.inspections(spark, sf), QUALITY_SPEC)[0])


@query
def clean_defects(spark, sf):
    return _clean(P.defects(spark, sf), DEFECTS_SPEC)[0]


@query
def clean_sensor(spark, sf):
    return rounded(_clean(P.sensors(spark, sf), SENSOR_SPEC)[0])


@query
def cleaning_report(spark, sf):
    plans = (
        (P.production(spark, sf), PRODUCTION_SPEC),
        (P.downtime(spark, sf), DOWNTIME_SPEC),
        (P.inspections(spark, sf), QUALITY_SPEC),
        (P.defects(spark, sf), DEFECTS_SPEC),
        (P.sensors(spark, sf), SENSOR_SPEC),
    )
    return cleaning.cleaning_metrics([_clean(df, spec)[1] for df, spec in plans])


# --- checks ---------------------------------------------------------------------------------


@query
def schema_report(spark, sf):
    return checks.schema_report(
        P.raw_events(spark, sf),
        "events",
        required=["event_id", "reading_text", "inspector_id"],
        dtypes={"event_id": "int", "reading_text": "float"},
        castable={"reading_text": "double", "time_text": "timestamp_ntz"},
    )


@query
def null_profile(spark, sf):
    return rounded(
        checks.null_profile(P.downtime(spark, sf), "downtime", max_null_pct=1.5, min_rows=50_000)
    )


@query
def rule_violations(spark, sf):
    production_rules = {
        "good_within_total": F.col("good_units") <= F.col("total_units_produced") + 1,
        "downtime_not_negative": F.col("downtime_minutes") >= 0,
        "some_planned_time": F.col("planned_production_time_minutes") > 0,
    }
    inspection_rules = {"defective_within_sample": F.col("defective_units") <= F.col("sample_size")}
    defect_rules = {"brand_prefix": F.col("defect_type").startswith("Brand#1")}
    return reshape.union_all(
        [
            checks.rule_violations(P.production(spark, sf), production_rules),
            checks.rule_violations(P.inspections(spark, sf), inspection_rules),
            checks.rule_violations(P.defects(spark, sf), defect_rules),
        ]
    )


@query
def downtime_reconcile(spark, sf):
    production = P.production(spark, sf).withColumnRenamed("l_orderkey", "record_id")
    events = P.downtime(spark, sf).withColumn("record_id", F.floor(F.col("event_id") / 2))
    return rounded(checks.reconcile_downtime(production, events))


# --- status, limits and chart tables --------------------------------------------------------


@query
def rag_status(spark, sf):
    machine_kpis = kpi.aggregate_kpis(with_oee(spark, sf), ["machine_id"])
    columns = [
        "oee", "availability", "performance", "quality", "scrap_rate", "throughput_units_per_hour",
    ]
    return rounded(limits.status_table(machine_kpis, ["machine_id"], columns))


@query
def rag_summary(spark, sf):
    return rounded(kpi_summary(with_oee(spark, sf)))


@query
def gauge_bands(spark, sf):
    oee = kpi.aggregate_kpis(with_oee(spark, sf), ["machine_id"]).select("machine_id", "oee")
    return rounded(limits.gauge_bands(oee, "oee", target=0.75))


@query
def control_chart(spark, sf):
    return rounded(limits.control_chart(P.sensors(spark, sf), "event_id", "reading_value"))


@query
def control_chart_monthly(spark, sf):
    monthly = kpi.aggregate_kpis(with_oee(spark, sf), ["month"])
    return rounded(limits.control_chart(monthly, "month", "oee"))


@query
def out_of_control(spark, sf):
    chart = limits.control_chart(P.sensors(spark, sf), "event_id", "reading_value")
    return limits.out_of_control(chart).select("event_id", "reading_value")


@query
def histogram(spark, sf):
    return rounded(summaries.histogram(with_oee(spark, sf), "cycle_time_actual_seconds"))


@query
def histogram_by_factory(spark, sf):
    return rounded(
        summaries.histogram(
            with_oee(spark, sf), "cycle_time_actual_seconds", 10, by=["factory_id"]
        )
    )


@query
def box_stats(spark, sf):
    # OEE values end after a few decimals; at six, rounding would often meet an exact half.
    return rounded(summaries.box_stats(with_oee(spark, sf), ["factory_id"], "oee"), digits=9)


@query
def kpi_trendline(spark, sf):
    return rounded(
        summaries.trendline(
            with_oee(spark, sf), "cycle_time_actual_seconds", "oee", by=["factory_id"]
        )
    )
