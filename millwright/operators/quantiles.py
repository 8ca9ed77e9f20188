"""Counted values and exact quantiles whose memory does not grow with the number of values.

Quantiles are selected digit by digit. A first pass counts the rows of each group by the leading
binary digits of the values (some two thousand buckets between a number and its double); the counts
say in which bucket each wanted rank lies and how far into it. The next pass looks only at those
buckets and counts by further digits, the third by all of them, which are the values. What is kept
between passes are counts: never more than one per bucket, whatever the number of rows, and all
groups and ranks go through the same three passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions.expressions import ColumnOrName, as_column, without_nan
from millwright.sources.staging import stage

# Leading binary digits of a value that the first and the second counting pass look at, of 53.
DIGITS = (12, 33)
# Doubles above this one are rounded after division by a power of two.
HUGE, SCALE = 2.0**900, 2.0**200
# Statistics of a group are joined to its rows in so many copies, so that the rows of a group
# holding much of a table are dealt to as many tasks.
SALTS = 16


def staged_counts(df: DataFrame, column: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct non-null value (and group), combined before the shuffle; staged.

    Nulls are left out of the staged counts rather than of the rows, because a filter below
    the count would compute ``column`` a second time for every row.
    """
    counts = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("count"))
    return stage(counts, row_ids=True).filter(F.col(column).isNotNull())


def with_group_statistics(rows: DataFrame, stats: DataFrame, by: Sequence[str], spread: str) -> DataFrame:
    """Append a group's statistics (one row per group) to its rows; null keys are groups too.

    Rows are dealt out by group and by the value of ``spread``, so a large group is not one
    task's; small statistics are broadcast by their measured size as in any join.
    """
    added = [c for c in stats.columns if c not in by]
    if not by:
        one = stats.agg(F.first(F.struct(*added)).alias("s")).scalar()
        return rows.withColumns({c: one.getField(c) for c in added})
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    copies = stats.select(
        *[F.col(k).alias(f"_group_{k}") for k in by],
        *added,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("_copy"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in by]
    same.append(F.col("_salt") == F.col("_copy"))
    joined = salted.join(copies, reduce(lambda a, b: a & b, same))
    return joined.select(*rows.columns, *added)


def leading(value: ColumnOrName, digits: int) -> Column:
    """A double rounded to its leading binary digits: never decreasing, and plain arithmetic.

    ``t - (t - value)`` with ``t = value * (2 ** dropped + 1)`` is the value to the nearest number
    of that many digits, because the sum loses the digits that are dropped.
    """
    value = as_column(value)
    # The product of a huge value would be infinite: it is taken of a smaller one.
    huge = F.abs(value) > F.lit(HUGE)
    scaled = F.when(huge, value * F.lit(1 / SCALE)).otherwise(value)
    product = scaled * F.lit(float((1 << (53 - digits)) + 1))
    rounded = product - (product - scaled)
    back = F.when(huge, rounded * F.lit(SCALE)).otherwise(rounded)
    return F.when(F.abs(value) == F.lit(float("inf")), value).otherwise(back)


def buckets(value: ColumnOrName) -> list[Column]:
    """The buckets of a value after one, two and all passes; the last is the value."""
    return [*[leading(value, d) for d in DIGITS], as_column(value)]


def _wanted(quantiles: Mapping[str, float]) -> Column:
    """The two ranks on either side of each quantile, in a group of ``_n`` rows."""
    ranks = []
    for name, share in quantiles.items():
        rank = (F.col("_n") - 1) * F.lit(float(share))
        for side, whole in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            ranks.append(
                F.struct(
                    F.lit(name).alias("name"), F.lit(side).alias("side"),
                    whole.cast("bigint").alias("offset"), rank.alias("rank"),
                )
            )
    return F.array(*ranks)


def _found(counts: DataFrame, within: Sequence[str]) -> DataFrame:
    """Buckets that hold wanted ranks, which then count from the bucket's first row.

    ``counts`` has ``_bucket``, ``count`` and the ranks wanted in each ``within`` part.
    """
    upto = Window.partitionBy(*within).orderBy("_bucket")
    summed = counts.withColumn(
        "_upto", F.sum("count").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    before = F.col("_upto") - F.col("count")

    def moved(r: Column) -> Column:
        return r.withField("offset", r["offset"] - before)

    inside = F.filter("_ranks", lambda r: (r["offset"] >= before) & (r["offset"] < F.col("_upto")))
    return summed.withColumn("_ranks", F.transform(inside, moved)).filter(F.size("_ranks") > 0)


def quantiles_of_staged(
    values: DataFrame, quantiles: Mapping[str, float], by: Sequence[str]
) -> DataFrame:
    """:func:`exact_quantiles` of the column ``value``, without null or NaN, of a staged table."""
    by = list(by)
    at = buckets("value")
    targets = None
    for k, bucket in enumerate(at):
        if targets is None:
            counts = values.groupBy(*by, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("count"))
            whole = F.sum("count").over(Window.partitionBy(*by))
            ranked = counts.withColumn("_n", whole).withColumn("_ranks", _wanted(quantiles))
            found = _found(ranked, by)
        else:
            # A group has at most two targets a quantile.
            wanted = targets.groupBy(*by).agg(F.collect_set("_bucket").alias("_targets"))
            part = at[k - 1].alias("_part")
            near = (
                with_group_statistics(values, wanted, by, "value")
                .select(*by, "value", "_targets", part)
                .filter(F.array_contains("_targets", F.col("_part")))
            )
            counts = near.groupBy(*by, "_part", bucket.alias("_bucket")).agg(
                F.count(F.lit(1)).alias("count")
            )
            keyed = counts.select("*", F.struct(*by, "_part").alias("_key"))
            parts = targets.select(F.struct(*by, F.col("_bucket").alias("_part")).alias("_key"), "_ranks")
            found = _found(keyed.join(parts, "_key"), ["_key"])
        found = found.select(*by, "_bucket", "_ranks")
        # What the last pass finds is read once only.
        targets = stage(found) if k + 1 < len(at) else found
    ranks = targets.select(*by, F.col("_bucket").alias("at"), F.explode("_ranks").alias("r"))

    def side(name: str, which: str) -> Column:
        return F.max(F.when((F.col("r.name") == name) & (F.col("r.side") == which), F.col("at")))

    def value(name: str) -> Column:
        rank = F.max(F.when(F.col("r.name") == name, F.col("r.rank")))
        low, high = side(name, "low"), side(name, "high")
        # Equal neighbours need no weights, which an infinity would turn into NaN.
        return F.when(low == high, low).otherwise(low + (high - low) * (rank - F.floor(rank)))

    return ranks.groupBy(*by).agg(*[value(name).alias(name) for name in quantiles])


def known_values(df: DataFrame, column: ColumnOrName, by: Sequence[str]) -> DataFrame:
    """``by`` and the column as double ``value``, without null and NaN."""
    raw = df.select(*by, as_column(column).cast("double").alias("value"))
    return without_nan(raw, ["value"]).filter(F.col("value").isNotNull())


def exact_quantiles(
    df: DataFrame, column: str, quantiles: Mapping[str, float], *, by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles of ``column`` with linear interpolation, one row per group.

    ``quantiles`` maps output names to shares in [0, 1]; null and NaN are left out, and a null key
    is a group. The values are staged and counted in three passes; see the module's docstring.
    """
    return quantiles_of_staged(stage(known_values(df, column, by)), quantiles, by)


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact medians of several columns: one row per column, ``(column, median)``."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    return exact_quantiles(long, "value", {"median": 0.5}, by=["column"])
