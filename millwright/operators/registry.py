"""Surrogate keys that stay the same from load to load.

A registry holds the number of every natural key met so far. A load is compared with it, the keys it
does not hold yet are numbered on from where it ends, in a given order and without gaps, and they
are published as one more part of the registry. So a known key keeps its number for ever, a load
that fails leaves no numbers behind, and a load that is registered again changes nothing.

Loads must be registered one at a time: a second one that began with the same registry is refused
when it comes to publish.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.expressions import padded_key
from millwright.operators.ordered import number_rows
from millwright.sources.publishing import (
    TableSet,
    publish_tables,
    published_set,
    read_table_of,
)
from millwright.sources.staging import stage

NUMBER = "seq"


def registered(spark: SparkSession, directory: str) -> DataFrame | None:
    """All registered keys with their numbers; None if nothing is registered."""
    current = published_set(spark, directory)
    if current is None:
        return None
    parts = [read_table_of(spark, current, name) for name in sorted(current.tables)]
    return reduce(DataFrame.unionByName, parts)


def _held(current: TableSet | None) -> int:
    return sum(t["rows"] for t in current.tables.values()) if current else 0


def register(
    rows: DataFrame, natural: Sequence[str], directory: str, order_by: Sequence[str] = ()
) -> int:
    """Number the natural keys of a load that are not registered; returns how many were new.

    New keys are numbered in the order ``order_by`` (default: the natural key). A key with a null
    part is no key.
    """
    natural = list(natural)
    spark = rows.sparkSession
    current = published_set(spark, directory)
    asked = rows.select(*natural).dropna().distinct()
    known = registered(spark, directory)
    if known is not None:
        asked = asked.join(known.select(*natural), natural, "left_anti")
    held = _held(current)
    numbered = number_rows(asked, list(order_by) or natural, out=NUMBER)
    new = stage(numbered.withColumn(NUMBER, F.col(NUMBER) + held))
    count = new.count()
    if count:
        # Numbers of earlier loads are linked, not written again.
        part = f"keys_from_{held + 1:020d}"
        publish_tables(
            {part: new}, directory, made_from=current.version if current else 0, along=current
        )
    return count


def with_registered_keys(
    rows: DataFrame, natural: Sequence[str], directory: str, prefix: str, *, out: str = "key", width: int = 7
) -> DataFrame:
    """Append the padded surrogate key of each row; null where its natural key has no number."""
    natural = list(natural)
    known = registered(rows.sparkSession, directory)
    if known is None:
        return rows.withColumn(out, F.lit(None).cast("string"))
    keyed = known.select(*natural, padded_key(prefix, NUMBER, width).alias(out))
    return rows.join(keyed, natural, "left").select(*rows.columns, out)
