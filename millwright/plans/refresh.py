"""KPI tables that take in new records without reading the old ones.

Every KPI is a ratio of sums, so sums at the finest grain (day, factory, machine, shift) are all that
has to be kept of records. A *load* adds the sums of its records to a store (``sources.loads``); the
KPI tables are derived from the sums of all loads, whose number of rows depends on days and
machines, not on records.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.expressions import month_key, sum_or_zero
from millwright.operators import kpi
from millwright.plans.plant import GRAIN_TABLES
from millwright.sources import loads
from millwright.sources.publishing import TableSet
from millwright.sources.staging import FILE_COLUMN, ROW_COLUMN, stage

# The finest grain of each table of sums.
SUM_KEYS = {
    "production_sums": ("date", "factory_id", "machine_id", "shift_id"),
    "failure_sums": ("machine_id",),
    "inspection_sums": ("factory_id",),
    "defect_counts": ("defect_type",),
}


def load_sums(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The sums of a load's cleaned records, one table per kind of record it brings."""
    sums = {}
    if "production_records" in tables:
        rated = kpi.add_oee_components(tables["production_records"])
        sums["production_sums"] = kpi.kpi_sums(rated, SUM_KEYS["production_sums"])
    if "downtime_events" in tables:
        sums["failure_sums"] = kpi.failure_sums(tables["downtime_events"], SUM_KEYS["failure_sums"])
    if "quality_inspections" in tables:
        sums["inspection_sums"] = kpi.inspection_sums(
            tables["quality_inspections"], SUM_KEYS["inspection_sums"]
        )
    if "defects" in tables:
        counted = tables["defects"].groupBy("defect_type").agg(F.count(F.lit(1)).alias("count"))
        sums["defect_counts"] = counted
    return sums


def add_load(directory: str, load_id: str, tables: Mapping[str, DataFrame]) -> TableSet:
    """Add the sums of a load's cleaned records; a load added again replaces itself."""
    sums = load_sums(tables)
    if not sums:
        raise ValueError("a load needs at least one of the fact tables")
    return loads.add_load(directory, load_id, sums)


def _merge(parts: dict[str, list[DataFrame]]) -> dict[str, DataFrame]:
    """Sums of sums; a sum without any value stays null."""
    merged = {}
    for name, frames in parts.items():
        rows, keys = reduce(DataFrame.unionByName, frames), SUM_KEYS[name]
        measures = [c for c in rows.columns if c not in keys]
        merged[name] = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])
    return merged


def stored_sums(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The merged sums of all loads, per kind of record that any load has brought."""
    return _merge(loads.stored(spark, directory))


def merge_loads(spark: SparkSession, directory: str) -> TableSet | None:
    """Fold the sums of all loads into one base."""
    return loads.merge_loads(spark, directory, _merge)


def refreshed_kpis(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The KPI tables of all loads, without the row-level one, from stored sums alone."""
    sums = stored_sums(spark, directory)
    tables = {}
    if "production_sums" in sums:
        rows = stage(sums["production_sums"].withColumn("month", month_key("date")))
        by_grain = stage(kpi.merge_sums_by_grain(rows, list(GRAIN_TABLES.values())))
        tables |= {n: kpi.kpis_of_grain(by_grain, grain) for n, grain in GRAIN_TABLES.items()}
        uptime = (
            kpi.with_known_keys(rows, ["machine_id"])
            .groupBy("machine_id")
            .agg(sum_or_zero("run_time_minutes").alias("total_run_time_minutes"))
        )
        if "failure_sums" in sums:
            tables["mtbf_mttr_machine"] = kpi.finish_mtbf_mttr(
                sums["failure_sums"], uptime, ["machine_id"]
            )
    if "inspection_sums" in sums:
        tables["defect_rate_factory"] = kpi.finish_defect_rate(sums["inspection_sums"])
    if "defect_counts" in sums:
        counts = stage(sums["defect_counts"], row_ids=True).filter("defect_type IS NOT NULL")
        ordered = counts.select("defect_type", "count", FILE_COLUMN, ROW_COLUMN)
        tables["pareto"] = kpi.pareto_of_staged(ordered, "defect_type")
    return tables
