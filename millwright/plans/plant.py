"""From raw plant tables to cleaned tables, KPI tables and the headline summary."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache

from pyspark.sql import DataFrame

from millwright.operators.cleaning import FACT_SPECS, CleaningReport, CleanSpec, clean
from millwright.operators.kpi import (
    HEADLINE_KPIS,
    add_oee_components,
    calculate_defect_rate,
    calculate_mtbf_mttr,
    headline_kpis,
    kpi_sums_by_grain,
    kpis_of_grain,
    pareto_analysis,
    with_month,
)
from millwright.operators.limits import status_table
from millwright.settings import Settings
from millwright.sources.staging import stage

# The KPI tables by grain.
GRAIN_TABLES = {
    "monthly_kpis": "month",
    "factory_kpis": "factory_id",
    "machine_kpis": "machine_id",
    "shift_kpis": "shift_id",
}


class Lazy(Mapping):
    """A mapping whose values are made when they are first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], object]]):
        self._makers = {name: cache(make) for name, make in makers.items()}

    def __getitem__(self, name: str):
        return self._makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def clean_tables(
    tables: Mapping[str, DataFrame],
    settings: Settings | None = None,
    specs: Mapping[str, CleanSpec] = FACT_SPECS,
) -> tuple[Mapping[str, DataFrame], Mapping[str, CleaningReport]]:
    """Clean every table that has a spec; the others (the dimensions) pass through.

    A table is cleaned when it or its report is first asked for.
    """
    done = {
        name: cache(lambda df=df, name=name: clean(df, specs[name], settings))
        for name, df in tables.items()
        if name in specs
    }
    cleaned = {
        name: (lambda name=name: done[name]()[0]) if name in done else (lambda df=df: df)
        for name, df in tables.items()
    }
    return Lazy(cleaned), Lazy({name: (lambda name=name: done[name]()[1]) for name in done})


def compute_kpis(tables: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    """The eight KPI tables, each worked out when it is first asked for.

    The rated records are staged: the rollups, the failure statistics and the row-level table
    all read them. The four rollups share one pass, whose sums are staged too.
    """

    @cache
    def production() -> DataFrame:
        return stage(with_month(add_oee_components(tables["production_records"])))

    @cache
    def sums() -> DataFrame:
        return stage(kpi_sums_by_grain(production(), list(GRAIN_TABLES.values())))

    rollups = {
        name: (lambda grain=grain: kpis_of_grain(sums(), grain))
        for name, grain in GRAIN_TABLES.items()
    }
    return Lazy(
        {
            "production_with_kpis": production,
            **rollups,
            "mtbf_mttr_machine": lambda: calculate_mtbf_mttr(
                tables["downtime_events"], production(), ["machine_id"]
            ),
            "defect_rate_factory": lambda: calculate_defect_rate(
                tables["quality_inspections"], ["factory_id"]
            ),
            "pareto": lambda: pareto_analysis(tables["defects"]),
        }
    )


def kpi_summary(production_with_oee: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Headline KPIs with target, status and reporting period: one row per KPI."""
    settings = settings or Settings()
    return status_table(
        headline_kpis(production_with_oee),
        ["period_start", "period_end"],
        HEADLINE_KPIS,
        settings.targets,
    )
