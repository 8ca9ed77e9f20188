"""Control limits, target status and gauge bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions.expressions import ColumnOrName, as_column, map_lookup, without_nan
from millwright.settings import DEFAULT_TARGETS, LOWER_IS_BETTER

# The Amber band around a target and the lower edge of a gauge's middle band.
AMBER_HIGHER = 0.9
AMBER_LOWER = 1.2
GAUGE_LOW = 0.8
NO_STATUS = "N/A"


def control_chart(df: DataFrame, x: str, y: str, *, sigmas: float = 3.0) -> DataFrame:
    """Each point with centre line, control limits and an out-of-control flag.

    The limits are a one-row scalar subquery, so the points stay where they are.
    """
    points = without_nan(df.select(x, y), [y])
    stats = points.agg(
        F.struct(F.avg(y).alias("mean"), F.stddev_samp(y).alias("sd")).alias("stats")
    ).scalar()
    mean, sd = stats.getField("mean"), stats.getField("sd")
    limits = points.withColumns(
        {"center": mean, "ucl": mean + F.lit(sigmas) * sd, "lcl": mean - F.lit(sigmas) * sd}
    )
    outside = (F.col(y) > F.col("ucl")) | (F.col(y) < F.col("lcl"))
    return limits.withColumn("out_of_control", F.coalesce(outside, F.lit(False)))


def out_of_control(chart: DataFrame) -> DataFrame:
    """The points of a control chart beyond its limits."""
    return chart.filter("out_of_control")


def classify_status(
    value: ColumnOrName,
    kpi: ColumnOrName,
    targets: Mapping[str, float] = DEFAULT_TARGETS,
    lower_is_better: Sequence[str] = LOWER_IS_BETTER,
) -> Column:
    """Green, Amber or Red against the KPI's target; ``N/A`` for a null or an unknown KPI."""
    value, kpi = as_column(value), as_column(kpi)
    target = map_lookup(kpi, targets)
    high = (
        F.when(value >= target, "Green")
        .when(value >= target * AMBER_HIGHER, "Amber")
        .otherwise("Red")
    )
    low = (
        F.when(value <= target, "Green")
        .when(value <= target * AMBER_LOWER, "Amber")
        .otherwise("Red")
    )
    status = F.when(kpi.isin(*lower_is_better), low).otherwise(high)
    return F.when(value.isNull() | F.isnan(value) | target.isNull(), NO_STATUS).otherwise(status)


def status_table(
    kpis: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    targets: Mapping[str, float] = DEFAULT_TARGETS,
) -> DataFrame:
    """Long table ``(keys..., kpi, value, target, status)`` of a wide KPI table."""
    wide = kpis.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keys), list(columns), "kpi", "value").withColumns(
        {
            "target": map_lookup("kpi", targets),
            "status": classify_status("value", "kpi", targets),
        }
    )


def gauge_bands(df: DataFrame, value: str, *, target: float = 0.85) -> DataFrame:
    """Value in percent, distance to target and the gauge band it falls in."""
    percent, goal = F.bround(F.col(value) * 100, 1), F.lit(target * 100)
    low = goal * GAUGE_LOW
    band = (
        F.when(percent.isNull(), NO_STATUS)
        .when(percent < low, "low")
        .when(percent < goal, "middle")
        .otherwise("high")
    )
    return df.withColumns(
        {
            "value_pct": percent,
            "delta_pct": percent - goal,
            "band_low_to": low,
            "band_middle_to": goal,
            "band": band,
        }
    )
