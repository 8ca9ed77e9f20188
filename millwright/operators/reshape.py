"""Unions, unpivots, expansions, keys, lookups, grids and extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DatetimeType, NumericType

from millwright.functions.expressions import (
    ColumnOrName,
    hour_of,
    map_lookup,
    padded_key,
    without_nan,
)
from millwright.operators.kpi import with_known_keys
from millwright.operators.ordered import number_rows, number_rows_of_staged, running_sum
from millwright.sources.staging import stage

# Rank error of the cut-off search, as a share of the rows.
CUTOFF_ERROR = 1e-4
# Cut-offs that are looked at: those above which 1/2, 1/4, 1/8, ... of the rows lie.
CUTOFFS = 12
EXPAND_BLOCK = 100_000
# Up to so many last rows are kept per task and merged in one.
TAKEN_ROWS = 10_000


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Vertical concatenation by column name; duplicates are kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def unpivot_sensors(
    wide: DataFrame, ids: Sequence[str], sensors: Sequence[str]
) -> DataFrame:
    """Wide sensor columns to ``(ids..., sensor_type, reading_value)``."""
    doubles = wide.select(*ids, *[F.col(c).cast("double").alias(c) for c in sensors])
    return doubles.unpivot(list(ids), list(sensors), "sensor_type", "reading_value")


def expand_units(df: DataFrame, count: str, *, index: str = "unit_no") -> DataFrame:
    """One child row per counted unit: a row with count n becomes n rows numbered 1..n.

    Counts up to a block expand where they are. Larger ones are cut into blocks, which are
    dealt out over the cluster before they expand, so no task expands a whole large count and
    no long array is built.
    """
    n, block = F.col(count).cast("bigint"), F.lit(EXPAND_BLOCK).cast("bigint")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    small = df.filter((n > 0) & (n <= block)).select(
        *df.columns, F.explode(F.sequence(one, n)).alias(index)
    )
    # Blocks of blocks first: the arrays stay short for any count.
    large = df.filter(n > block).withColumn("_row", F.monotonically_increasing_id())
    outer = block * F.lit(EXPAND_BLOCK)
    spans = large.select("*", F.explode(F.sequence(zero, n - 1, outer)).alias("_span"))
    ends = F.least(F.col("_span") + outer, n) - 1
    blocks = spans.select("*", F.explode(F.sequence(F.col("_span"), ends, block)).alias("_from"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(partitions, "_row", "_from")
    last = F.least(F.col("_from") + block, n)
    return small.unionByName(
        dealt.select(*df.columns, F.explode(F.sequence(F.col("_from") + 1, last)).alias(index))
    )


def surrogate_keys(
    df: DataFrame,
    prefix: str,
    order_by: Sequence[ColumnOrName],
    *,
    out: str = "key",
    width: int = 7,
) -> DataFrame:
    """Append gap-free padded keys (``DF0000001``...) in the given order."""
    numbered = number_rows(df, order_by, out="_seq")
    return numbered.select(*df.columns, padded_key(prefix, "_seq", width).alias(out))


def lookup(df: DataFrame, key: str, mapping: Mapping[str, object], out: str) -> DataFrame:
    """Append the value a fixed mapping holds for ``key``; null where it holds none."""
    return df.withColumn(out, map_lookup(key, mapping))


def lookup_dimension(df: DataFrame, dimension: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Append attributes of a dimension with unique keys.

    No broadcast hint: the engine broadcasts the dimension when its measured size allows, and
    otherwise splits skewed keys of a shuffled join.
    """
    return df.join(dimension.select(on, *columns), on, "left")


def roster(
    df: DataFrame, group: str, member: str, *, page_size: int = 1000, separator: str = ","
) -> DataFrame:
    """Members of each group as sorted, joined text, ``page_size`` members to a row.

    A group up to the page size is one row; a larger one continues on further pages instead
    of growing without limit in one task.
    """
    members = with_known_keys(df.select(group, member), [group, member])
    numbered = running_sum(
        members.withColumn("_one", F.lit(1)),
        "_one",
        [member],
        partition_by=[group],
        out="_rank",
    )
    page = F.floor((F.col("_rank") - 1) / F.lit(page_size)).cast("bigint")
    listed = F.array_sort(F.collect_list(F.struct(F.col("_rank"), F.col(member).cast("string").alias("m"))))
    return (
        numbered.groupBy(group, page.alias("page"))
        .agg(listed.alias("_members"), F.count(F.lit(1)).alias("members"))
        .select(
            group,
            "page",
            "members",
            F.array_join(F.transform("_members", lambda s: s["m"]), separator).alias("roster"),
        )
    )


def slot_grid(
    machines: DataFrame, machine_key: str, production: DataFrame, shifts: Sequence
) -> DataFrame:
    """All expected (machine, date, shift) slots between the first and last production date.

    Dates and shifts are generated inside each machine's row, so nothing is joined.
    """
    period = production.agg(
        F.struct(F.min("date").alias("first"), F.max("date").alias("last")).alias("period")
    ).scalar()
    days = F.sequence(
        period.getField("first"), period.getField("last"), F.expr("interval 1 day")
    )
    # Each machine grows to days x shifts rows, so the machines are spread first, by an
    # explicit count: a plain shuffle of the few machines would be coalesced to one task.
    partitions = int(machines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        machines.select(F.col(machine_key).alias("machine_id"))
        .repartition(partitions, "machine_id")
        .distinct()
        .select("machine_id", F.explode(days).alias("date"))
        .select("machine_id", "date", F.explode(F.array(*map(F.lit, shifts))).alias("shift_id"))
    )


def missing_slots(grid: DataFrame, production: DataFrame) -> DataFrame:
    """Expected slots no production record reports."""
    slot = ["machine_id", "date", "shift_id"]
    return grid.join(production.select(*slot).distinct(), slot, "left_anti")


def missing_intervals(
    machines: DataFrame, machine_key: str, production: DataFrame, shifts: Sequence
) -> DataFrame:
    """Unreported slots as intervals of dates: ``(machine_id, shift_id, first, last, days)``.

    The slots are those of :func:`slot_grid`, but no row is made for a slot. The dates a machine's
    shift reports are collected as a set, merged before the shuffle and never longer than the
    period has days; what lies between neighbouring dates is missing. A shift without any record
    is missing for the whole period.
    """
    known = production.select("machine_id", "date", "shift_id")
    period = known.agg(F.struct(F.min("date").alias("first"), F.max("date").alias("last")).alias("p")).scalar()
    before, after = F.date_sub(period["first"], 1), F.date_add(period["last"], 1)
    pairs = machines.select(F.col(machine_key).alias("machine_id")).distinct().select(
        "machine_id", F.explode(F.array(*map(F.lit, shifts))).alias("shift_id")
    )
    reported = known.groupBy("machine_id", "shift_id").agg(
        F.array_sort(F.collect_set("date")).alias("_dates")
    )
    dates = F.coalesce("_dates", F.array().cast("array<date>"))
    edges = F.concat(F.array(before), dates, F.array(after))

    def gap(d: Column, i: Column) -> Column:
        return F.struct(
            F.date_add(d, 1).alias("first"),
            F.date_sub(F.get("_edges", i + 1), 1).alias("last"),
        )

    gaps = F.filter(F.transform("_edges", gap), lambda g: g["first"] <= g["last"])
    return (
        pairs.join(reported, ["machine_id", "shift_id"], "left")
        .select("machine_id", "shift_id", edges.alias("_edges"))
        .select("machine_id", "shift_id", F.inline(gaps))
        .withColumn("days", (F.datediff("last", "first") + 1).cast("bigint"))
    )


def tail_extract(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows in the given order, in that order.

    A few rows are the last ones of each task's last ones, merged. Of more, rows that can be among the last are found by a cut-off on the leading column, staged, and
    numbered over the cluster, so that neither a large ``n`` nor a large table meets in one task.
    """
    if n <= TAKEN_ROWS:
        return df.orderBy(*[F.col(c).desc() for c in order_by]).limit(n).orderBy(*order_by)
    candidates = _tail_candidates(df, order_by[0], n)
    numbered = number_rows_of_staged(candidates, order_by, out="_seq")
    rows = numbered.agg(F.max("_seq")).scalar()
    return numbered.filter(F.col("_seq") > rows - F.lit(n)).orderBy("_seq").select(*df.columns)


def _tail_candidates(df: DataFrame, lead: str, n: int) -> DataFrame:
    """A superset of the last ``n`` rows by ``lead``, staged with row ids.

    One pass looks at the row count and a series of approximate quantiles; the highest one
    with enough rows above it is the cut-off. Should the rows above it be too few after all,
    the next lower one is tried, and at last all rows are candidates.
    """
    cuts: list = []
    if isinstance(df.schema[lead].dataType, NumericType | DatetimeType):
        shares = [1.0 - 0.5**k for k in range(1, CUTOFFS + 1)]
        look = F.approx_percentile(lead, F.array(*map(F.lit, shares)), int(1 / CUTOFF_ERROR))
        seen = df.agg(F.count(lead).alias("rows"), look.alias("at")).first()
        enough = [
            at
            for share, at in zip(shares, seen["at"] or (), strict=False)
            if seen["rows"] * (1.0 - share - 2 * CUTOFF_ERROR) >= n
        ]
        cuts = list(reversed(enough))
    for cut in cuts:
        kept = stage(df.filter(F.col(lead) >= F.lit(cut)), row_ids=True)
        if kept.count() >= n:
            return kept
    return stage(df, row_ids=True)


def sensor_hourly(readings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean, minimum, maximum and count of the readings per key and hour, in time order."""
    hour = hour_of("timestamp")
    readings = without_nan(readings, ["reading_value"])
    hourly = with_known_keys(readings, [*keys, "timestamp"]).groupBy(*keys, hour.alias("hour"))
    value = "reading_value"
    return hourly.agg(
        F.avg(value).alias("mean_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.count(value).alias("n_readings"),
    ).orderBy(*keys, "hour")
