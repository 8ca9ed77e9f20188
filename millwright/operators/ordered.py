"""Order-dependent operators that stay parallel whatever the size of a group.

A plain window over the whole table, or over a key that holds a large share of the rows, runs
in one task. Each operator here stages its input, sorts the rows across the cluster and stages
them again with the number of the sorted partition they fell in (the *chunk*) and their
position in it. Windows then run per chunk, so no task sees more than a chunk, and what has to
cross a chunk boundary is carried over a summary with one row per chunk and key. There is one
form for every size: adaptive execution makes one chunk out of little data.

Ties in the given order are broken by the staged address of the rows. That makes the sort
repeatable when a task is retried, and spreads even a large group of identical rows over many
chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions.expressions import ColumnOrName, as_column, without_nan
from millwright.sources.staging import FILE_COLUMN, ROW_COLUMN, stage

CHUNK = "_chunk"
POSITION = "_position"
_ADDRESS = "_address"
_KEY = "_key"
# monotonically_increasing_id() keeps the partition above, the row below this bit.
_PARTITION_BIT = 33


def _visible(staged: DataFrame) -> list[str]:
    return [c for c in staged.columns if c not in (FILE_COLUMN, ROW_COLUMN)]


def _total_order(order_by: Sequence[ColumnOrName]) -> list[Column]:
    return [*map(as_column, order_by), F.col(FILE_COLUMN), F.col(ROW_COLUMN)]


def ordered_chunks(staged: DataFrame, order_by: Sequence[ColumnOrName]) -> DataFrame:
    """Sort a table staged with row ids; stage it again with chunk number and position."""
    columns = _visible(staged)
    addressed = staged.orderBy(*_total_order(order_by)).select(
        *columns, F.monotonically_increasing_id().alias(_ADDRESS)
    )
    return stage(addressed).select(
        *columns,
        F.shiftright(_ADDRESS, _PARTITION_BIT).alias(CHUNK),
        F.col(_ADDRESS).bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1)).alias(POSITION),
    )


def _with_key(chunks: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add the group as one struct column; returns the columns of a chunk's part of a group.

    A struct is never null, so groups with null keys join like any other, and the windows and
    the join below share one shuffle.
    """
    if not keys:
        return chunks, [CHUNK]
    return chunks.withColumn(_KEY, F.struct(*keys)), [CHUNK, _KEY]


def running_sum(
    df: DataFrame,
    value: ColumnOrName,
    order_by: Sequence[ColumnOrName],
    *,
    partition_by: Sequence[str] = (),
    out: str = "running_sum",
    total: str | None = None,
) -> DataFrame:
    """Running sum of ``value`` in the given order, per ``partition_by`` group.

    ``total`` names an extra column with the sum over the whole group.
    """
    staged = stage(df, row_ids=True)
    return running_sum_of_staged(
        staged, value, order_by, partition_by=partition_by, out=out, total=total
    )


def running_sum_of_staged(
    staged: DataFrame,
    value: ColumnOrName,
    order_by: Sequence[ColumnOrName],
    *,
    partition_by: Sequence[str] = (),
    out: str = "running_sum",
    total: str | None = None,
) -> DataFrame:
    """:func:`running_sum` of a table staged with row ids."""
    keys, value = list(partition_by), as_column(value)
    chunks, part = _with_key(ordered_chunks(staged, [*keys, *order_by]), keys)
    chunks = chunks.withColumn("_value", value)
    # One row per chunk and key: at most the number of sort partitions plus that of keys.
    by_key = Window.partitionBy(*part[1:])
    earlier = by_key.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        chunks.groupBy(*part)
        .agg(F.sum("_value").alias("_chunk_sum"))
        .select(
            *part,
            F.sum("_chunk_sum").over(earlier).alias("_before"),
            F.sum("_chunk_sum").over(by_key).alias("_whole"),
        )
    )
    within = (
        Window.partitionBy(*part)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = chunks.withColumn("_local", F.sum("_value").over(within))
    columns = [F.col(c) for c in _visible(staged)]
    # Either side is null as long as it has had no value; so is the sum over both.
    before, local = F.col("_before"), F.col("_local")
    columns.append(F.coalesce(before + local, local, before).alias(out))
    if total is not None:
        columns.append(F.col("_whole").alias(total))
    return summed.join(carried, part, "left").select(*columns)


def number_rows(df: DataFrame, order_by: Sequence[ColumnOrName], *, out: str = "seq") -> DataFrame:
    """Number all rows 1..n in the given order, without gaps."""
    return number_rows_of_staged(stage(df, row_ids=True), order_by, out=out)


def number_rows_of_staged(
    staged: DataFrame, order_by: Sequence[ColumnOrName], *, out: str = "seq"
) -> DataFrame:
    """:func:`number_rows` of a table staged with row ids."""
    chunks = ordered_chunks(staged, order_by)
    earlier = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunks.groupBy(CHUNK)
        .count()
        .select(CHUNK, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    )
    # One row per sort partition, so the broadcast is bounded by the partition count.
    return chunks.join(F.broadcast(offsets), CHUNK).select(
        *_visible(staged), (F.col("_before") + F.col(POSITION) + 1).cast("bigint").alias(out)
    )


def fill_gaps(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[ColumnOrName],
    *,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Fill nulls with the last value before them, leading nulls with the first after them.

    NaN is a missing value too.
    """
    keys = list(partition_by)
    staged = stage(without_nan(df, columns), row_ids=True)

    def pick(fn, c: str, frame) -> Column:
        return fn(c, ignorenulls=True).over(frame)

    chunks, part = _with_key(ordered_chunks(staged, [*keys, *order_by]), keys)

    def present(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col(POSITION))

    edges = chunks.groupBy(*part).agg(
        *[F.max_by(c, present(c)).alias(f"_last_{c}") for c in columns],
        *[F.min_by(c, present(c)).alias(f"_first_{c}") for c in columns],
    )
    by_chunk = Window.partitionBy(*part[1:]).orderBy(CHUNK)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    anywhere = by_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A row without any value before it takes the first value of its key, wherever that is.
    carried = edges.select(
        *part,
        *[pick(F.last, f"_last_{c}", earlier).alias(f"_prev_{c}") for c in columns],
        *[pick(F.first, f"_first_{c}", anywhere).alias(f"_lead_{c}") for c in columns],
    )
    back = (
        Window.partitionBy(*part)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = chunks.withColumns({f"_back_{c}": pick(F.last, c, back) for c in columns})
    filled = {c: F.coalesce(f"_back_{c}", f"_prev_{c}", f"_lead_{c}") for c in columns}
    return local.join(carried, part, "left").select(
        *[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns]
    )
