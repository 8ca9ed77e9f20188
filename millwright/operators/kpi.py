"""Plant KPIs: OEE at row level and at any grain, reliability, quality and Pareto tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions.expressions import (
    ColumnOrName,
    as_column,
    day_text,
    map_lookup,
    month_key,
    percent_text,
    ratio_of_sums,
    safe_div,
    sum_or_zero,
    weighted_avg,
    without_nan,
)
from millwright.operators.ordered import running_sum_of_staged
from millwright.operators.quantiles import staged_counts

# The cap on performance, the Pareto line, and the measures of a KPI table.
PERFORMANCE_CAP = 1.5
PARETO_LINE = 80.0

ADDITIVE_MEASURES = (
    "total_units_produced",
    "good_units",
    "scrap_units",
    "planned_production_time_minutes",
    "run_time_minutes",
    "downtime_minutes",
)
# Each rate is averaged with the weight of its own denominator.
RATE_WEIGHTS = {
    "availability": "planned_production_time_minutes",
    "performance": "run_time_minutes",
    "quality": "total_units_produced",
    "oee": "planned_production_time_minutes",
    "throughput_units_per_hour": "run_time_minutes",
}
HEADLINE_KPIS = ("oee", "availability", "performance", "quality", "scrap_rate")


def add_oee_components(production: DataFrame) -> DataFrame:
    """Append availability, performance, quality, OEE and the rate columns to each record."""
    run, planned = F.col("run_time_minutes"), F.col("planned_production_time_minutes")
    total = F.col("total_units_produced")
    ideal_minutes = F.col("ideal_cycle_time_seconds") * total / 60.0
    return (
        without_nan(production)
        .withColumns(
            {
                "availability": safe_div(run, planned),
                "performance": F.least(safe_div(ideal_minutes, run), F.lit(PERFORMANCE_CAP)),
                "quality": safe_div("good_units", total),
                "scrap_rate": safe_div("scrap_units", total),
                "cycle_time_actual_seconds": safe_div(run * 60.0, total),
                "utilization": safe_div(run, planned),
                "throughput_units_per_hour": safe_div(total, run / 60.0),
            }
        )
        .withColumn("oee", F.col("availability") * F.col("performance") * F.col("quality"))
    )


def with_known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows where a grouping key is null: they belong to no group."""
    return df.dropna(how="any", subset=list(keys))


def _sum_inputs(production_with_oee: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The columns every KPI is summed up from: measures, and rates times their weights."""
    df = without_nan(production_with_oee, (*ADDITIVE_MEASURES, *RATE_WEIGHTS))
    products = {
        f"{rate}_weighted": F.col(rate).cast("double") * F.col(weight).cast("double")
        for rate, weight in RATE_WEIGHTS.items()
    }
    return df.select(
        *keys, *ADDITIVE_MEASURES, *[product.alias(name) for name, product in products.items()]
    )


def _sums() -> list[Column]:
    weighted = [f"{rate}_weighted" for rate in RATE_WEIGHTS]
    return [F.sum(c).alias(c) for c in (*ADDITIVE_MEASURES, *weighted)]


def kpi_sums_by_grain(production_with_oee: DataFrame, grains: Sequence[str]) -> DataFrame:
    """KPI sums for several single-column grains: ``(grain, grain columns..., sums...)``.

    One pass over the records: row-level KPIs are computed once, then each row counts towards
    every grain, and what is shuffled are the groups of the grains, not their combinations.
    """
    return merge_sums_by_grain(_sum_inputs(production_with_oee, grains), grains)


def kpi_sums(production_with_oee: DataFrame, keys: Sequence[str]) -> DataFrame:
    """KPI sums per key, null keys included: they can be merged into those of any coarser grain."""
    return _sum_inputs(production_with_oee, keys).groupBy(*keys).agg(*_sums())


def merge_sums_by_grain(sums: DataFrame, grains: Sequence[str]) -> DataFrame:
    """The sums of :func:`kpi_sums_by_grain` from rows or from finer sums."""
    sets = sums.groupingSets([[g] for g in grains], *grains).agg(
        F.grouping_id().alias("_grouping"), *_sums()
    )
    # The grouping id has a zero bit for the column that is grouped by, first column highest.
    full = (1 << len(grains)) - 1
    ids = {str(full - (1 << (len(grains) - 1 - i))): grain for i, grain in enumerate(grains)}
    return sets.withColumn("grain", map_lookup(F.col("_grouping").cast("string"), ids)).drop(
        "_grouping"
    )


def kpis_of_grain(grain_sums: DataFrame, grain: str) -> DataFrame:
    """The KPI table of one grain out of :func:`kpi_sums_by_grain`."""
    own = grain_sums.filter(F.col("grain") == grain)
    return finish_kpis(with_known_keys(own, [grain]), [grain])


def finish_kpis(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Turn KPI sums into the twelve KPI measures."""
    rates = {
        rate: ratio_of_sums(F.col(f"{rate}_weighted"), F.col(weight))
        for rate, weight in RATE_WEIGHTS.items()
    }
    return sums.select(
        *keys,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ADDITIVE_MEASURES],
        *[rates[c].alias(c) for c in ("availability", "performance", "quality", "oee")],
        safe_div("scrap_units", "total_units_produced").alias("scrap_rate"),
        rates["throughput_units_per_hour"].alias("throughput_units_per_hour"),
    )


def aggregate_kpis(production_with_oee: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """KPIs at an arbitrary grain, rates weighted rather than averaged row by row."""
    inputs = _sum_inputs(with_known_keys(production_with_oee, group_by), group_by)
    return finish_kpis(inputs.groupBy(*group_by).agg(*_sums()), group_by)


def aggregate_kpis_by_grain(production_with_oee: DataFrame, grains: Sequence[str]) -> DataFrame:
    """KPIs for several single-column grains at once: ``(grain, grain_value, measures...)``."""
    return finish_grains(kpi_sums_by_grain(production_with_oee, grains), grains)


def finish_grains(sums: DataFrame, grains: Sequence[str]) -> DataFrame:
    """The KPI tables of :func:`kpi_sums_by_grain`, one below the other."""
    # Of the grain columns only the one grouped by is set in a row.
    value = F.coalesce(*[F.col(g).cast("string") for g in grains])
    named = with_known_keys(sums.withColumn("grain_value", value), ["grain_value"])
    return finish_kpis(named, ["grain", "grain_value"])


def weighted_matrix(
    df: DataFrame, rows: str, columns: str, values: Sequence, rate: str, weight: str
) -> DataFrame:
    """Heatmap input: one row per ``rows`` value, one column per listed ``columns`` value.

    Records whose ``columns`` value is not listed are left out.
    """
    return (
        with_known_keys(without_nan(df, [rate, weight]), [rows, columns])
        .groupBy(rows)
        .pivot(columns, list(values))
        .agg(weighted_avg(rate, weight))
    )


def calculate_mtbf_mttr(
    downtime_events: DataFrame, production: DataFrame, group_by: Sequence[str]
) -> DataFrame:
    """Mean time between failures and to repair; only unplanned stoppages are failures.

    Both sides are reduced to a row per group before they are joined.
    """
    keys = list(group_by)
    uptime = (
        with_known_keys(without_nan(production, ["run_time_minutes"]), keys)
        .groupBy(*keys)
        .agg(sum_or_zero("run_time_minutes").alias("total_run_time_minutes"))
    )
    return finish_mtbf_mttr(failure_sums(downtime_events, keys), uptime, keys)


def failure_sums(downtime_events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count and minutes of the unplanned stoppages per group."""
    return (
        with_known_keys(without_nan(downtime_events, ["duration_minutes"]), keys)
        .filter("is_planned = false")
        .groupBy(*keys)
        .agg(
            F.count("event_id").alias("failure_count"),
            sum_or_zero("duration_minutes").alias("total_downtime_minutes"),
        )
    )


def finish_mtbf_mttr(failures: DataFrame, uptime: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Times between failures and to repair from sums per group; groups without uptime are left out."""
    keys = list(keys)
    count, downtime = "failure_count", "total_downtime_minutes"
    return (
        uptime.join(failures, keys, "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in (count, downtime)})
        .withColumns(
            {
                "mtbf_hours": safe_div(F.col("total_run_time_minutes") / 60.0, count),
                "mttr_hours": safe_div(F.col(downtime) / 60.0, count),
            }
        )
    )


def least_reliable(
    mtbf: DataFrame, k: int = 10, key: str = "machine_id", *, failing_only: bool = False
) -> DataFrame:
    """The ``k`` groups with the shortest time between failures.

    Groups without any failure have a time of 0 and come first; ``failing_only`` leaves them out.
    """
    if failing_only:
        mtbf = mtbf.filter("failure_count > 0")
    return mtbf.orderBy("mtbf_hours", key).limit(k)


def calculate_defect_rate(inspections: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Defective units over inspected units and first-pass yield, per group."""
    return finish_defect_rate(inspection_sums(inspections, group_by))


def inspection_sums(inspections: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Units, inspections and passes per group."""
    return (
        with_known_keys(inspections, group_by)
        .groupBy(*group_by)
        .agg(
            sum_or_zero("sample_size").alias("units_inspected"),
            sum_or_zero("defective_units").alias("defective_units"),
            F.count("inspection_id").alias("inspections_count"),
            F.count_if(F.col("result") == "Pass").alias("pass_count"),
        )
    )


def finish_defect_rate(counted: DataFrame) -> DataFrame:
    """Rates from the sums of :func:`inspection_sums`."""
    return counted.withColumns(
        {
            "defect_rate": safe_div("defective_units", "units_inspected"),
            "first_pass_yield": safe_div("pass_count", "inspections_count"),
        }
    )


def pareto_analysis(defects: DataFrame, category_col: str = "defect_type") -> DataFrame:
    """Counts per category, largest first, with share and cumulative share in percent.

    Equal counts are ordered by category; null categories are left out.
    """
    return pareto_of_staged(staged_counts(defects, category_col), category_col)


def pareto_of_staged(counts: DataFrame, category_col: str) -> DataFrame:
    """The Pareto table of staged counts per category, ``(category, count)`` with row ids."""
    running = running_sum_of_staged(
        counts,
        "count",
        [F.col("count").desc(), category_col],
        out="_upto",
        total="_total",
    )
    # Multiplying before dividing keeps whole percentages exact, so the last row is 100.
    return running.select(
        category_col,
        "count",
        (F.col("count") * 100.0 / F.col("_total")).alias("pct_of_total"),
        (F.col("_upto") * 100.0 / F.col("_total")).alias("cumulative_pct"),
    ).orderBy(F.col("count").desc(), category_col)


def vital_few(pareto: DataFrame, *, line: float = PARETO_LINE) -> DataFrame:
    """Flag the categories up to the Pareto line."""
    return pareto.withColumn("is_vital_few", F.col("cumulative_pct") <= F.lit(line))


def headline_kpis(production_with_oee: DataFrame, date_col: str = "date") -> DataFrame:
    """Unweighted row means of the headline KPIs and the reporting period, in one row."""
    return without_nan(production_with_oee, HEADLINE_KPIS).agg(
        *[F.avg(c).alias(c) for c in HEADLINE_KPIS],
        day_text(F.min(date_col)).alias("period_start"),
        day_text(F.max(date_col)).alias("period_end"),
    )


def percent_table(
    kpis: DataFrame, keys: Sequence[str], columns: Sequence[str] = HEADLINE_KPIS
) -> DataFrame:
    """KPI table for print: keys and the given rates as percent text."""
    return kpis.select(*keys, *[percent_text(c).alias(c) for c in columns])


def series(kpis: DataFrame, x: str, y: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Series behind a trend or bar chart, ordered by ``x``; one line per ``by`` group."""
    return kpis.select(*by, x, y).orderBy(*by, x)


def with_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumn("month", month_key(date_col))


def material_downtime(
    df: DataFrame, minutes: ColumnOrName = "downtime_minutes", threshold: float = 5.0
) -> DataFrame:
    """Keep rows whose downtime exceeds ``threshold`` minutes; no downtime counts as zero."""
    return df.filter(F.coalesce(as_column(minutes), F.lit(0.0)) > F.lit(threshold))

