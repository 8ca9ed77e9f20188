"""Reusable column expressions: built-in Spark functions only.

All helpers follow the plant-data conventions rather than the SQL ones: a ratio with a zero
or missing operand is 0, clamping keeps nulls, and NaN is treated as null. They name their
operands as few times as possible: a filter on a computed column repeats its whole expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: ColumnOrName) -> Column:
    return F.nanvl(as_column(c), F.lit(None).cast("double"))


def without_nan(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Turn NaN into null in the float columns among ``columns`` (default: all)."""
    wanted = set(df.columns if columns is None else columns)
    floats = [
        f.name
        for f in df.schema.fields
        if f.name in wanted and isinstance(f.dataType, DoubleType | FloatType)
    ]
    return df.withColumns({name: nan_to_null(name) for name in floats}) if floats else df


def safe_div(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator / denominator``, or 0 where the ratio is null, NaN or infinite."""
    ratio = F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )
    # Spark orders NaN above infinity, so one comparison rejects null, NaN and infinity alike.
    return F.when(F.abs(ratio) < F.lit(float("inf")), ratio).otherwise(F.lit(0.0))


def clamp_min(c: ColumnOrName, low: float) -> Column:
    """Raise values below ``low`` to it; nulls stay null."""
    c = as_column(c)
    return F.when(c < F.lit(low), F.lit(low)).otherwise(c)


def clamp_max(c: ColumnOrName, high: float) -> Column:
    """Lower values above ``high`` to it; nulls and NaN stay as they are."""
    c = as_column(c)
    return F.when((c > F.lit(high)) & ~F.isnan(c), F.lit(high)).otherwise(c)


def sum_or_zero(c: ColumnOrName) -> Column:
    """Sum that is 0 rather than null over a group without values."""
    total = F.sum(as_column(c))
    return F.coalesce(total, F.lit(0))


def ratio_of_sums(weighted: Column, weight: Column) -> Column:
    """Finish a weighted average from its two sums: null where the total weight is 0."""
    total = F.coalesce(weight, F.lit(0)).cast("double")
    return F.when(total != 0, F.coalesce(weighted, F.lit(0.0)) / total)


def weighted_sum(value: ColumnOrName, weight: ColumnOrName) -> Column:
    """``sum(value * weight)``; rows where either side is missing add nothing."""
    return F.sum(as_column(value).cast("double") * as_column(weight).cast("double"))


def weighted_avg(value: ColumnOrName, weight: ColumnOrName) -> Column:
    """Weighted average; a row without a value still counts in the total weight."""
    return ratio_of_sums(weighted_sum(value, weight), F.sum(as_column(weight)))


def month_key(c: ColumnOrName) -> Column:
    """``YYYY-MM`` of a date: how its text starts, which costs less than a date format."""
    c = as_column(c)
    return F.substring(c.cast("date").cast("string"), 1, 7)


def day_text(c: ColumnOrName) -> Column:
    return F.date_format(as_column(c), "yyyy-MM-dd")


def hour_of(c: ColumnOrName) -> Column:
    """A timestamp without zone floored to the hour, whatever the session time zone."""
    c = as_column(c)
    return F.make_timestamp_ntz(
        F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0)
    )


def percent_text(c: ColumnOrName, digits: int = 1) -> Column:
    """A share as percent text, rounded half to even: 0.8128 -> ``81.3%``."""
    return F.concat(F.bround(as_column(c) * 100, digits).cast("string"), F.lit("%"))


def padded_key(prefix: str, number: ColumnOrName, width: int = 7) -> Column:
    """``PR0000001``-style key; numbers wider than ``width`` keep all their digits."""
    return F.format_string(f"{prefix}%0{width}d", as_column(number))


def shift_hours(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Hours between two ``HH:MM`` clock texts; overnight wraps, equal ends make 24."""

    def minutes(clock: Column) -> Column:
        parts = F.split(clock, ":")
        return parts[0].cast("int") * 60 + parts[1].cast("int")

    span = F.pmod(minutes(as_column(end)) - minutes(as_column(start)), F.lit(24 * 60))
    return F.when(span == 0, F.lit(24.0)).otherwise(span / 60.0)


def add_months_capped(c: ColumnOrName, months: int) -> Column:
    """Move a date by calendar months, with the day of month capped at 28."""
    c = as_column(c)
    first = F.add_months(F.trunc(c, "MM"), months)
    return F.date_add(first, F.least(F.dayofmonth(c), F.lit(28)) - 1)


def is_weekend(c: ColumnOrName) -> Column:
    return F.weekday(as_column(c)) >= 5


def add_minutes(timestamp: ColumnOrName, minutes: ColumnOrName) -> Column:
    """Move a timestamp by whole minutes."""
    return as_column(timestamp) + F.make_dt_interval(mins=as_column(minutes).cast("int"))


def to_number(c: ColumnOrName) -> Column:
    """Text to double, null where it is no decimal number."""
    c = as_column(c)
    # Java also reads a type suffix ("1d", "2.5f") as part of the number; data files do not.
    suffixed = F.trim(c).rlike("(?i)^[^a-z]*[0-9.][df]$")
    return F.when(~suffixed, nan_to_null(c.try_cast("double")))


def to_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text to timestamp without zone, null where it does not parse."""
    c = as_column(c)
    parsed = c if fmt is None else F.try_to_timestamp(c, F.lit(fmt))
    return parsed.try_cast("timestamp_ntz")


def map_lookup(key: ColumnOrName, mapping: Mapping[str, object]) -> Column:
    """Look a key up in a fixed mapping carried inside the plan; null where unknown."""
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), as_column(key))
