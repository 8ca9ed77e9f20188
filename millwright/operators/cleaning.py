"""Cleaning of raw tables: coerce, deduplicate, impute, flag outliers, clamp."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millwright.functions.expressions import (
    clamp_min,
    to_number,
    to_timestamp,
    without_nan,
)
from millwright.operators.ordered import fill_gaps
from millwright.operators.quantiles import exact_medians
from millwright.settings import Settings
from millwright.sources.staging import stage
from millwright.sources.tables import INGEST_POSITION

SENTINEL = "UNKNOWN"


@dataclass(frozen=True)
class CleanSpec:
    """Column roles of one table.

    ``order_by`` stands for the file order of the rows: it decides which of several duplicates
    is the first one and is required by the ``ffill`` strategy. Tables read with their ingest
    position (see :func:`millwright.sources.tables.load_tables`) are deduplicated by that first.
    ``fill_within`` restricts filling to groups (per machine, say). Columns a table lacks are
    passed over.
    """

    table: str
    date_cols: Sequence[str] = ()
    numeric_cols: Sequence[str] = ()
    category_cols: Sequence[str] = ()
    outlier_cols: Sequence[str] = ()
    non_negative_cols: Sequence[str] = ()
    date_formats: Mapping[str, str] = field(default_factory=dict)
    order_by: Sequence[str] = ()
    fill_within: Sequence[str] = ()


# Column roles of the five fact tables.
FACT_SPECS = {
    "production_records": CleanSpec(
        "production",
        date_cols=("date",),
        numeric_cols=(
            "planned_production_time_minutes",
            "downtime_minutes",
            "run_time_minutes",
            "total_units_produced",
            "good_units",
            "scrap_units",
        ),
        category_cols=("shift_id", "factory_id", "line_id", "machine_id"),
        outlier_cols=("downtime_minutes", "total_units_produced"),
        non_negative_cols=(
            "total_units_produced",
            "good_units",
            "scrap_units",
            "downtime_minutes",
        ),
        order_by=("record_id",),
    ),
    "downtime_events": CleanSpec(
        "downtime",
        date_cols=("date", "start_time"),
        numeric_cols=("duration_minutes",),
        category_cols=("reason_code", "shift_id"),
        outlier_cols=("duration_minutes",),
        non_negative_cols=("duration_minutes",),
        order_by=("event_id",),
    ),
    "quality_inspections": CleanSpec(
        "quality",
        date_cols=("date",),
        numeric_cols=("sample_size", "defective_units"),
        category_cols=("result", "shift_id"),
        non_negative_cols=("sample_size", "defective_units"),
        order_by=("inspection_id",),
    ),
    "defects": CleanSpec(
        "defects",
        date_cols=("date",),
        category_cols=("defect_type", "severity", "disposition"),
        order_by=("defect_id",),
    ),
    "sensor_readings": CleanSpec(
        "sensor",
        date_cols=("timestamp",),
        numeric_cols=("reading_value",),
        category_cols=("sensor_type",),
        outlier_cols=("reading_value",),
        order_by=("timestamp",),
        fill_within=("machine_id", "sensor_type"),
    ),
}


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StringType)


# --- single steps ---------------------------------------------------------------------------


def coerce_types(
    df: DataFrame,
    *,
    date_cols: Sequence[str] = (),
    numeric_cols: Sequence[str] = (),
    date_formats: Mapping[str, str] | None = None,
) -> DataFrame:
    """Text columns to timestamps and numbers, unreadable values to null.

    Columns that already have a date or number type keep it, absent ones are skipped, and
    NaN becomes null everywhere.
    """
    formats = date_formats or {}
    parsed = {
        c: to_timestamp(c, formats.get(c)) for c in _present(df, date_cols) if _is_text(df, c)
    } | {c: to_number(c) for c in _present(df, numeric_cols) if _is_text(df, c)}
    return without_nan(df.withColumns(parsed) if parsed else df)


def dedupe(
    df: DataFrame, keys: Sequence[str] | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row per key; without keys, one of each set of identical rows.

    Null keys equal each other. "First" follows the ingest position, if the table has one, then
    ``order_by`` and then the other columns, so that of two copies the one with a value stays:
    nulls come last. The row limit per key is applied before the shuffle too, so a key repeated
    many times moves only one row per input partition.
    """
    keys = _present(df, keys or ())
    order_by = _present(df, [INGEST_POSITION, *order_by])
    columns = [c for c in df.columns if c != INGEST_POSITION]
    order = [*order_by, *[c for c in columns if c not in keys and c not in order_by]]
    if not keys or not order:
        return df.dropDuplicates(columns)
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        df.withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").drop("_copy")
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Nulls per column, counted in one pass."""
    if not columns:
        return {}
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.first().asDict()


def fill_with(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls; a whole-number column given a fractional value becomes double."""
    known = {c: v for c, v in values.items() if v is not None}
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in known.items()}) if known else df


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    df = without_nan(df, columns)
    medians = {row["column"]: row["median"] for row in exact_medians(df, columns).collect()}
    return fill_with(df, medians)


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    df = without_nan(df, columns)
    return fill_with(df, df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict())


def fill_sentinel(df: DataFrame, category_cols: Sequence[str] = ()) -> DataFrame:
    """Null text becomes ``UNKNOWN``, except in declared category columns, which keep nulls."""
    subset = _text_columns(df, category_cols)
    return df.fillna(SENTINEL, subset=subset) if subset else df


def _text_columns(df: DataFrame, category_cols: Sequence[str]) -> list[str]:
    return [c for c in df.columns if _is_text(df, c) and c not in category_cols]


def flag_outliers(df: DataFrame, columns: Sequence[str], z_threshold: float = 3.0) -> DataFrame:
    """Append ``<column>_is_outlier``: more than ``z_threshold`` population deviations off.

    Mean and deviation of all columns are one scalar subquery. Nulls and constant columns are
    never flagged; the flag column always exists.
    """
    columns = _present(df, columns)
    if not columns:
        return df
    moments = [
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in columns
    ]
    stats = df.agg(F.struct(*moments).alias("stats")).scalar()
    flags = {}
    for c in columns:
        mean, sd = stats.getField(c).getField("mean"), stats.getField(c).getField("sd")
        far = (sd > 0) & (F.abs(F.col(c) - mean) > F.lit(z_threshold) * sd)
        flags[f"{c}_is_outlier"] = F.coalesce(far, F.lit(False))
    return df.withColumns(flags)


def enforce_non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    clamped = {c: clamp_min(c, 0) for c in _present(df, columns)}
    return df.withColumns(clamped) if clamped else df


# --- the whole plan -------------------------------------------------------------------------


@dataclass(frozen=True)
class CleaningReport:
    """What cleaning changed.

    The counts of rows and gaps were observed while the deduplicated rows were written; what
    came out is counted when asked for.
    """

    table: str
    rows_before: int
    rows_deduped: int
    cleaned: DataFrame
    filled: Mapping[str, int]
    flags: Sequence[str]
    conversions: Mapping[str, str]

    def _after(self) -> list[Column]:
        return [
            F.count(F.lit(1)).alias("rows_after"),
            *[F.count_if(F.col(c)).alias(c) for c in self.flags],
        ]

    def metrics(self) -> DataFrame:
        """``(table_name, metric, column_name, value)``: one row per count."""
        counted = self.cleaned.agg(*self._after())

        def metric(name: str, value: Column, column: str = "") -> Column:
            return F.struct(
                F.lit(self.table).alias("table_name"),
                F.lit(name).alias("metric"),
                F.lit(column).alias("column_name"),
                value.cast("bigint").alias("value"),
            )

        entries = [
            metric("rows_before", F.lit(self.rows_before)),
            metric("rows_after", F.col("rows_after")),
            metric("duplicates_removed", F.lit(self.rows_before - self.rows_deduped)),
            *[metric("missing_filled", F.lit(n), c) for c, n in self.filled.items()],
            *[
                metric("outliers_flagged", F.col(c), c.removesuffix("_is_outlier"))
                for c in self.flags
            ],
        ]
        return counted.select(F.inline(F.array(*entries)))

    def observed(self) -> tuple[DataFrame, Observation]:
        """The cleaned table with its row and outlier counts collected while it is written."""
        observation = Observation(f"cleaning of {self.table}")
        return self.cleaned.observe(observation, *self._after()), observation

    def summary(self) -> str:
        """One line for the log."""
        counts: dict[str, dict[str, int]] = {}
        for row in self.metrics().collect():
            counts.setdefault(row["metric"], {})[row["column_name"]] = row["value"]
        before, after = counts["rows_before"][""], counts["rows_after"][""]
        parts = [
            f"{self.table}: {before} rows in, {after} out",
            f"{counts['duplicates_removed']['']} duplicates",
            *[f"{c}: {n} filled" for c, n in counts.get("missing_filled", {}).items()],
            *[f"{c}: {n} outliers" for c, n in counts.get("outliers_flagged", {}).items()],
        ]
        return "; ".join(parts)


def _drop_in_turn(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """Drop rows with a null in a column, column after column, counting each one's share."""
    counts, kept = [], F.lit(True)
    for c in columns:
        counts.append(F.count_if(kept & F.col(c).isNull()).alias(c))
        kept = kept & F.col(c).isNotNull()
    dropped = df.agg(*counts).first().asDict() if counts else {}
    return df.dropna(subset=list(columns)), dropped


def impute(
    df: DataFrame,
    spec: CleanSpec,
    strategy: str = "median",
    missing: Mapping[str, int] | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Fill or drop missing values; returns the count of missing values per changed column.

    ``missing`` gives these counts where they are known already.
    """
    numeric = _present(df, spec.numeric_cols)
    text = _text_columns(df, spec.category_cols)
    if strategy == "drop":
        df, dropped = _drop_in_turn(df, numeric)
        missing = dropped | null_counts(df, text)
    else:
        missing = dict(missing or null_counts(df, [*numeric, *text]))
        gaps = [c for c in numeric if missing[c]]
        if gaps and strategy == "median":
            df = fill_median(df, gaps)
        elif gaps and strategy == "mean":
            df = fill_mean(df, gaps)
        elif gaps and strategy == "ffill":
            order = _present(df, spec.order_by)
            if not order:
                raise ValueError("the ffill strategy needs an order_by in the CleanSpec")
            df = fill_gaps(df, gaps, order, partition_by=_present(df, spec.fill_within))
    return fill_sentinel(df, spec.category_cols), {c: n for c, n in missing.items() if n}


def clean(
    df: DataFrame, spec: CleanSpec, settings: Settings | None = None
) -> tuple[DataFrame, CleaningReport]:
    """Coerce, deduplicate, impute, flag outliers and clamp, in this order.

    The deduplicated rows are staged once, because the fill values, the outlier statistics
    and the result each read them. The rows before and after and the gaps are counted by that
    same write, so the raw input is read once.
    """
    settings = settings or Settings()
    coerced = coerce_types(
        df,
        date_cols=spec.date_cols,
        numeric_cols=spec.numeric_cols,
        date_formats={**settings.date_formats, **spec.date_formats},
    )
    raw, unique = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    gaps = [*_present(coerced, spec.numeric_cols), *_text_columns(coerced, spec.category_cols)]
    first = dedupe(coerced.observe(raw, rows), settings.dedupe_keys.get(spec.table), spec.order_by)
    counted = first.drop(INGEST_POSITION).observe(
        unique, rows, *[F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in gaps]
    )
    deduped = stage(counted)
    nulls = {c: unique.get[f"null {c}"] for c in gaps}
    imputed, filled = impute(deduped, spec, settings.missing_value_strategy, nulls)
    flagged = flag_outliers(imputed, spec.outlier_cols, settings.outlier_z_threshold)
    cleaned = enforce_non_negative(flagged, spec.non_negative_cols)
    kinds = (
        (spec.date_cols, "timestamp"),
        (spec.numeric_cols, "numeric"),
        (spec.category_cols, "category"),
    )
    report = CleaningReport(
        table=spec.table,
        rows_before=raw.get["rows"],
        rows_deduped=unique.get["rows"],
        cleaned=cleaned,
        filled=filled,
        flags=[f"{c}_is_outlier" for c in _present(df, spec.outlier_cols)],
        conversions={c: kind for cols, kind in kinds for c in _present(df, cols)},
    )
    return cleaned, report


def cleaning_metrics(reports: Sequence[CleaningReport]) -> DataFrame:
    """The metrics of several reports in one table."""
    return reduce(lambda a, b: a.unionByName(b), [r.metrics() for r in reports])
