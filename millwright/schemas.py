"""Explicit schemas of the ten plant tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Tables, columns and types.
TABLE_DDL = {
    "factories": """
        factory_id string, factory_name string, country string, num_lines bigint, timezone string
    """,
    "production_lines": """
        line_id string, factory_id string, line_name string, product_family string,
        installed_year bigint
    """,
    "machines": """
        machine_id string, line_id string, factory_id string, machine_name string,
        machine_type string, manufacturer string, install_date date,
        ideal_cycle_time_seconds double, nominal_capacity_units_per_hour double
    """,
    "operators": """
        operator_id string, factory_id string, operator_name string, hire_date date,
        certification_level string, shift_preference string
    """,
    "shifts": """
        shift_id string, shift_name string, start_time string, end_time string,
        duration_hours double
    """,
    "production_records": """
        record_id string, date date, shift_id string, factory_id string, line_id string,
        machine_id string, operator_id string, planned_production_time_minutes double,
        downtime_minutes double, run_time_minutes double, ideal_cycle_time_seconds double,
        total_units_produced bigint, good_units bigint, scrap_units bigint
    """,
    "downtime_events": """
        event_id string, record_id string, date date, shift_id string, factory_id string,
        line_id string, machine_id string, reason_code string, duration_minutes double,
        is_planned boolean, start_time timestamp_ntz
    """,
    "quality_inspections": """
        inspection_id string, record_id string, date date, shift_id string, factory_id string,
        line_id string, machine_id string, sample_size bigint, defective_units bigint,
        result string, inspector_id string
    """,
    "defects": """
        defect_id string, inspection_id string, record_id string, date date, factory_id string,
        line_id string, machine_id string, defect_type string, severity string,
        disposition string
    """,
    "sensor_readings": """
        machine_id string, factory_id string, line_id string, timestamp timestamp_ntz,
        sensor_type string, reading_value double, unit string
    """,
}

DIMENSIONS = ("factories", "production_lines", "machines", "operators", "shifts")
FACTS = (
    "production_records",
    "downtime_events",
    "quality_inspections",
    "defects",
    "sensor_readings",
)


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLE_DDL[name])


def table_schemas() -> dict[str, StructType]:
    return {name: table_schema(name) for name in TABLE_DDL}
