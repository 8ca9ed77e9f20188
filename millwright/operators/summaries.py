"""The reduced tables behind histograms, box plots and trend lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions.expressions import without_nan
from millwright.operators.kpi import with_known_keys
from millwright.operators.quantiles import (
    known_values,
    quantiles_of_staged,
    with_group_statistics,
)
from millwright.sources.staging import stage

WHISKER = 1.5


def histogram(df: DataFrame, x: str, bins: int = 30, *, by: Sequence[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal-width bins from minimum to maximum; the top edge is closed.

    With ``by``, one set of counts per group, over bins common to all groups.
    """
    keys = list(by)
    values = without_nan(df.select(*keys, F.col(x).cast("double").alias("_x")), ["_x"])
    values = with_known_keys(values, keys) if keys else values
    edges = values.agg(
        F.struct(F.min("_x").alias("low"), F.max("_x").alias("high")).alias("edges")
    ).scalar()
    low = edges.getField("low")
    width = (edges.getField("high") - low) / F.lit(bins)
    position = F.floor(F.try_divide(F.col("_x") - low, width))
    number = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1))
    # A constant column has bins of no width: all its values are in the first.
    counted = values.groupBy(*keys, number.cast("bigint").alias("bin")).agg(
        F.count("_x").alias("count")
    )
    if keys:
        numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint")))
        every_bin = values.select(*keys).distinct().select(*keys, numbers.alias("bin"))
    else:
        every_bin = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every_bin.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def box_stats(df: DataFrame, group_by: Sequence[str], y: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier count per group; the input is read once."""
    keys = list(group_by)
    values = stage(known_values(with_known_keys(df, keys), y, keys))
    quartiles = quantiles_of_staged(values, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys)
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        with_group_statistics(values, quartiles, keys, "value")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.any_value(c).alias(c) for c in ("q1", "median", "q3")],
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def trendline(df: DataFrame, x: str, y: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line and correlation of two measures, per group."""
    pairs = without_nan(df.select(*by, x, y), [x, y])
    return (
        with_known_keys(pairs, by).groupBy(*by) if by else pairs.groupBy()
    ).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.corr(x, y).alias("correlation"),
    )
