"""Plant-floor analytics on Spark DataFrames."""

from millwright.operators.checks import (
    has_columns,
    null_profile,
    orphans,
    reconcile_downtime,
    rule_violations,
    schema_report,
    validate_data_quality,
    validate_schema,
)
from millwright.operators.cleaning import FACT_SPECS, CleaningReport, CleanSpec, clean
from millwright.operators.kpi import (
    add_oee_components,
    aggregate_kpis,
    aggregate_kpis_by_grain,
    calculate_defect_rate,
    calculate_mtbf_mttr,
    headline_kpis,
    pareto_analysis,
    vital_few,
)
from millwright.operators.limits import classify_status, control_chart, gauge_bands, status_table
from millwright.operators.summaries import box_stats, histogram, trendline
from millwright.plans.plant import clean_tables, compute_kpis, kpi_summary
from millwright.settings import Settings
from millwright.sources.staging import drop_staged, staged_scope
from millwright.sources.tables import load_tables, write_kpis, write_tables

__all__ = [
    "FACT_SPECS",
    "CleanSpec",
    "CleaningReport",
    "Settings",
    "add_oee_components",
    "aggregate_kpis",
    "aggregate_kpis_by_grain",
    "box_stats",
    "calculate_defect_rate",
    "calculate_mtbf_mttr",
    "classify_status",
    "clean",
    "clean_tables",
    "compute_kpis",
    "control_chart",
    "drop_staged",
    "gauge_bands",
    "has_columns",
    "headline_kpis",
    "histogram",
    "kpi_summary",
    "load_tables",
    "null_profile",
    "orphans",
    "pareto_analysis",
    "reconcile_downtime",
    "rule_violations",
    "schema_report",
    "staged_scope",
    "status_table",
    "trendline",
    "validate_data_quality",
    "validate_schema",
    "vital_few",
    "write_kpis",
    "write_tables",
]
