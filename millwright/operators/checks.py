"""Data quality checks: schema, nulls, row rules, references and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions.expressions import sum_or_zero, to_number, without_nan
from millwright.operators.kpi import with_known_keys

# Dtype names in use for data frames and the Spark types they stand for.
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_FRACTIONAL = ("float", "double")
_TIMES = ("date", "timestamp", "timestamp_ntz")
DTYPES = {
    "int": _WHOLE,
    "int8": ("tinyint",),
    "int16": ("smallint",),
    "int32": ("int",),
    "int64": ("bigint",),
    "float": _FRACTIONAL,
    "float32": ("float",),
    "float64": ("double",),
    "datetime": _TIMES,
    "datetime64": _TIMES,
    "datetime64[ns]": _TIMES,
    "object": ("string",),
    "str": ("string",),
    "category": ("string",),
    "bool": ("boolean",),
}


def _dtype_matches(actual: str, expected: str) -> bool:
    return actual in DTYPES.get(expected, (expected,))


def _converted(column: str, kind: str) -> Column:
    return to_number(column) if kind == "double" else F.col(column).try_cast(kind)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def has_columns(df: DataFrame, required: Sequence[str]) -> bool:
    return not missing_columns(df, required)


def validate_schema(
    df: DataFrame,
    table: str,
    required: Sequence[str] = (),
    dtypes: Mapping[str, str] | None = None,
) -> list[str]:
    """Schema errors as messages; only emptiness needs a look at the data."""
    if not df.columns or df.isEmpty():
        return [f"{table}: empty"]
    actual = dict(df.dtypes)
    errors = [f"{table}.{c}: column missing" for c in missing_columns(df, required)]
    errors += [
        f"{table}.{c}: type {actual[c]} instead of {expected}"
        for c, expected in (dtypes or {}).items()
        if c in actual and not _dtype_matches(actual[c], expected)
    ]
    return errors


def schema_report(
    df: DataFrame,
    table: str,
    required: Sequence[str] = (),
    dtypes: Mapping[str, str] | None = None,
    castable: Mapping[str, str] | None = None,
) -> DataFrame:
    """All schema checks as ``(table_name, check_name, column_name, detail, violations)``.

    Missing columns and type mismatches are known from the schema. ``castable`` names columns
    whose every value must convert to a type: the row count and those are one pass.
    """
    castable = {c: t for c, t in (castable or {}).items() if c in df.columns}
    actual = dict(df.dtypes)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count_if(F.col(c).isNotNull() & _converted(c, t).isNull()).alias(c)
            for c, t in castable.items()
        ],
    )

    def entry(check: str, column: str, detail: str, violations: Column) -> Column:
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            F.lit(detail).alias("detail"),
            violations.cast("bigint").alias("violations"),
        )

    entries = [entry("not_empty", "", "at least one row", (F.col("_rows") == 0).cast("int"))]
    entries += [
        entry("required", c, "column exists", F.lit(0 if c in actual else 1)) for c in required
    ]
    entries += [
        entry("dtype", c, t, F.lit(0 if _dtype_matches(actual[c], t) else 1))
        for c, t in (dtypes or {}).items()
        if c in actual
    ]
    entries += [entry("castable", c, t, F.col(c)) for c, t in castable.items()]
    return counted.select(F.inline(F.array(*entries)))


def null_profile(
    df: DataFrame, table: str, *, max_null_pct: float = 10.0, min_rows: int = 0
) -> DataFrame:
    """Nulls per column against a threshold, and the row count against a minimum.

    One pass over the table; one output row per column, so none for a table without columns.
    """
    if not df.columns:
        return df.sparkSession.createDataFrame(
            [],
            "table_name string, row_count bigint, column_count bigint, column_name string, "
            "null_count bigint, null_pct double, too_many_nulls boolean, too_few_rows boolean",
        )
    clean = without_nan(df)
    counted = clean.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    long = counted.unpivot(["_rows"], df.columns, "column_name", "null_count")
    percent = F.try_divide(F.col("null_count") * 100.0, F.col("_rows"))
    return long.select(
        F.lit(table).alias("table_name"),
        F.col("_rows").alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        "column_name",
        "null_count",
        percent.alias("null_pct"),
        F.coalesce(percent > F.lit(max_null_pct), F.lit(False)).alias("too_many_nulls"),
        (F.col("_rows") < F.lit(min_rows)).alias("too_few_rows"),
    )


def validate_data_quality(
    df: DataFrame, table: str, *, max_null_pct: float = 10.0, min_rows: int = 0
) -> dict:
    """The null profile as one mapping with warnings and errors as text."""
    rows = null_profile(df, table, max_null_pct=max_null_pct, min_rows=min_rows).collect()
    count = rows[0]["row_count"] if rows else df.count()
    return {
        "table_name": table,
        "row_count": count,
        "column_count": len(df.columns),
        "null_by_column": {r["column_name"]: r["null_pct"] for r in rows},
        "warnings": [
            f"{table}.{r['column_name']}: {r['null_pct']:.1f}% nulls, at most {max_null_pct}% allowed"
            for r in rows
            if r["too_many_nulls"]
        ],
        "errors": (
            [f"{table}: {count} rows, at least {min_rows} needed"] if count < min_rows else []
        ),
    }


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each named rule: ``(rule_name, rows_checked, violations)``.

    A rule that is null for a row is not broken by it.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(~rule).alias(name) for name, rule in rules.items()],
    )
    return counted.unpivot(["rows_checked"], list(rules), "rule_name", "violations")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent and how many rows carry them; null keys are no reference.

    The child is reduced to its distinct keys before the join.
    """
    keys = with_known_keys(child.select(key), [key]).groupBy(key)
    counted = keys.agg(F.count(F.lit(1)).alias("child_rows"))
    parents = parent.select(F.col(parent_key or key).alias(key))
    return counted.join(parents, key, "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """The child rows without a parent."""
    parents = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return with_known_keys(child, [key]).join(parents, key, "left_anti")


def reconcile_downtime(production: DataFrame, events: DataFrame, key: str = "record_id") -> DataFrame:
    """Downtime per production record against the minutes of its events.

    Both sides are reduced to a row per record first. ``record_rows`` above one shows records
    that were reported more than once.
    """
    recorded = (
        with_known_keys(without_nan(production, ["downtime_minutes"]), [key])
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("record_rows"),
            sum_or_zero("downtime_minutes").alias("recorded_minutes"),
        )
    )
    logged = (
        with_known_keys(without_nan(events, ["duration_minutes"]), [key])
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("event_rows"),
            sum_or_zero("duration_minutes").alias("event_minutes"),
        )
    )
    return (
        recorded.join(logged, key, "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("event_rows", "event_minutes")})
        .withColumn("difference_minutes", F.col("event_minutes") - F.col("recorded_minutes"))
    )
