"""A store of small summaries, one part per load of records, that are merged when read.

Each load is published under its id: adding it again replaces it, and a load that fails half-way is
not there at all. Folding the loads into one base keeps reading from slowing down with their number.
The base names the loads it holds; a reader leaves these out, whether or not their folders are
still there::

    <directory>/loads/<id>/      the tables of one load
    <directory>/base/            the tables of merged loads, and which ones
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from millwright.sources.publishing import (
    TableSet,
    folder_names,
    publish_tables,
    published_set,
    read_table_of,
)

MERGED = "merged_loads"
Merge = Callable[[dict[str, list[DataFrame]]], dict[str, DataFrame]]


def _loads(directory: str) -> str:
    return f"{directory.rstrip('/')}/loads"


def _base(directory: str) -> str:
    return f"{directory.rstrip('/')}/base"


def add_load(directory: str, load_id: str, tables: Mapping[str, DataFrame]) -> TableSet:
    """Add a load's tables; a load added again replaces itself.

    A load that was merged into the base stays as it is there: adding it again is an error.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", load_id):
        raise ValueError(f"a load id is letters, digits and ._-, not {load_id!r}")
    spark = next(iter(tables.values())).sparkSession
    if load_id in _merged(spark, published_set(spark, _base(directory))):
        raise ValueError(f"load {load_id} is part of the base already")
    return publish_tables(tables, f"{_loads(directory)}/{load_id}")


def _merged(spark: SparkSession, base: TableSet | None) -> set[str]:
    """Ids of the loads in the base: one short text per load."""
    if base is None:
        return set()
    return {row["load_id"] for row in read_table_of(spark, base, MERGED).collect()}


def _parts(spark: SparkSession, directory: str) -> tuple[TableSet | None, set[str], dict[str, TableSet]]:
    """The base, the loads in it, and the loads beside it."""
    base = published_set(spark, _base(directory))
    merged = _merged(spark, base)
    beside = {}
    for name in folder_names(spark, _loads(directory)):
        if name not in merged:
            current = published_set(spark, f"{_loads(directory)}/{name}")
            if current is not None:
                beside[name] = current
    return base, merged, beside


def _tables(spark: SparkSession, sets: list[TableSet]) -> dict[str, list[DataFrame]]:
    found: dict[str, list[DataFrame]] = {}
    for s in sets:
        for name in sorted(set(s.tables) - {MERGED}):
            found.setdefault(name, []).append(read_table_of(spark, s, name))
    return found


def stored(spark: SparkSession, directory: str) -> dict[str, list[DataFrame]]:
    """Per table its parts in the base and in all loads beside it."""
    base, _, beside = _parts(spark, directory)
    return _tables(spark, [s for s in (base, *beside.values()) if s is not None])


def merge_loads(spark: SparkSession, directory: str, merge: Merge) -> TableSet | None:
    """Fold all loads into the base, in one step for readers; None where there is nothing at all."""
    base, merged, beside = _parts(spark, directory)
    if not beside:
        return base
    tables = merge(_tables(spark, [s for s in (base, *beside.values()) if s is not None]))
    ids = sorted(merged | set(beside))
    listed = spark.createDataFrame([(i,) for i in ids], "load_id string").coalesce(1)
    return publish_tables(
        {**tables, MERGED: listed}, _base(directory), made_from=base.version if base else 0
    )
