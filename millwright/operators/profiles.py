"""Column profiles that can be merged: of days, files or loads, without reading the rows again.

A profile has one row per column: how many rows and gaps there are, the least and greatest number,
and two sketches, one for the number of distinct values and one for quantiles. All of these merge:
the profile of a whole table is the merger of its parts' profiles, exact in counts and bounds, and
within the sketches' errors for the rest (about 2 % of a distinct count at one standard deviation,
about 1.3 % of the rows in a quantile's rank).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from millwright.functions.expressions import without_nan
from millwright.sources import loads
from millwright.sources.publishing import TableSet

# Sizes of the sketches, as exponents or entries: a few kB a column each.
DISTINCT_BITS = 12
QUANTILE_ENTRIES = 200
PROFILE = "profile"


def _entry(df: DataFrame, column: str) -> Column:
    """What is kept of one column, as a struct."""
    c = F.col(f"`{column}`")
    number = isinstance(df.schema[column].dataType, NumericType)
    value = c.cast("double") if number else F.lit(None).cast("double")
    # Equal values have equal hashes whatever the type; gaps are no value.
    distinct = F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), DISTINCT_BITS)
    return F.struct(
        F.lit(column).alias("column_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(c.isNull()).alias("null_count"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        distinct.alias("distinct_sketch"),
        F.kll_sketch_agg_double(value, QUANTILE_ENTRIES).alias("quantile_sketch"),
    )


def profile_parts(df: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Mergeable profiles of all columns, one per ``by`` group: one pass, one row a column.

    NaN is a gap.
    """
    columns = [c for c in df.columns if c not in by]
    clean = without_nan(df, columns)
    entries = [_entry(clean, c) for c in columns]
    packed = clean.groupBy(*by).agg(*[e.alias(f"_{i}") for i, e in enumerate(entries)])
    return packed.select(*by, F.inline(F.array(*[f"_{i}" for i in range(len(entries))])))


def merge_profiles(parts: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """One profile out of several, per ``by`` group; it can be merged again."""
    return parts.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", QUANTILE_ENTRIES).alias("quantile_sketch"),
    )


def read_profile(profile: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Counts, bounds, estimated distinct values and quantiles ``q<percent>`` per column."""
    some = F.kll_sketch_get_n_double("quantile_sketch") > 0
    quantiles = [
        F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(s)))).alias(
            f"q{round(100 * s):02d}"
        )
        for s in shares
    ]
    kept = [c for c in profile.columns if not c.endswith("_sketch")]
    distinct = F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate")
    return profile.select(*kept, distinct, *quantiles)


def null_report(
    profile: DataFrame, table: str, *, max_null_pct: float = 10.0, min_rows: int = 0
) -> DataFrame:
    """The report of ``checks.null_profile`` from a profile instead of the table."""
    percent = F.try_divide(F.col("null_count") * 100.0, F.col("row_count"))
    columns = profile.agg(F.count(F.lit(1))).scalar()
    return profile.select(
        F.lit(table).alias("table_name"),
        "row_count",
        columns.alias("column_count"),
        "column_name",
        "null_count",
        percent.alias("null_pct"),
        F.coalesce(percent > F.lit(max_null_pct), F.lit(False)).alias("too_many_nulls"),
        (F.col("row_count") < F.lit(min_rows)).alias("too_few_rows"),
    )


# --- a store of profiles, load by load ------------------------------------------------------


def _merge(parts: dict[str, list[DataFrame]]) -> dict[str, DataFrame]:
    return {n: merge_profiles(reduce(DataFrame.unionByName, frames)) for n, frames in parts.items()}


def add_profile(directory: str, load_id: str, df: DataFrame) -> TableSet:
    """Add the profile of a load's rows to a store."""
    return loads.add_load(directory, load_id, {PROFILE: profile_parts(df)})


def stored_profile(spark: SparkSession, directory: str) -> DataFrame | None:
    """The profile of all rows of all loads; None if there is none."""
    return _merge(loads.stored(spark, directory)).get(PROFILE)


def merge_stored(spark: SparkSession, directory: str) -> TableSet | None:
    """Fold the profiles of all loads into one base."""
    return loads.merge_loads(spark, directory, _merge)
