"""SQL counterparts of the queries over several loads: the same result from all rows at once."""

from __future__ import annotations

from millwright.catalog.oracles import MTBF, ORACLES as WHOLE, over

ORACLES: dict[str, str] = {
    "kpi_set_published": over(
        MTBF
        + """, units AS (
            SELECT strftime(date, '%Y-%m') AS month, * FROM production_v)
        SELECT 'production_with_kpis' AS table_name, count(*) AS row_count,
            CAST(sum(total_units_produced) AS BIGINT) AS total FROM units
        UNION ALL SELECT 'monthly_kpis', count(DISTINCT month),
            CAST(sum(total_units_produced) AS BIGINT) FROM units
        UNION ALL SELECT 'factory_kpis', count(DISTINCT factory_id),
            CAST(sum(good_units) AS BIGINT) FROM units
        UNION ALL SELECT 'machine_kpis', count(DISTINCT machine_id),
            CAST(sum(scrap_units) AS BIGINT) FROM units
        UNION ALL SELECT 'shift_kpis', count(DISTINCT shift_id),
            CAST(sum(total_units_produced) AS BIGINT) FROM units
        UNION ALL SELECT 'mtbf_mttr_machine', count(*), CAST(sum(failure_count) AS BIGINT) FROM mtbf
        UNION ALL SELECT 'defect_rate_factory', count(DISTINCT factory_id),
            CAST(sum(defective_units) AS BIGINT) FROM inspections_v
        UNION ALL SELECT 'pareto', count(DISTINCT defect_type), count(defect_type) FROM defects_v""",
        "production_v",
        "downtime_v",
        "inspections_v",
        "defects_v",
    ),
    "table_set_after_failure": over(
        """SELECT event_id, machine_id, reading_value, s_nationkey AS factory_id
        FROM sensor_v LEFT JOIN supplier ON s_suppkey = machine_id""",
        "sensor_v",
    ),
    "kpi_refreshed": WHOLE["kpi_all_grains"],
    "mtbf_refreshed": WHOLE["mtbf_mttr"],
    "dedupe_two_loads": """
        SELECT * EXCLUDE (copy) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey % 4 = 0, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS copy
            FROM lineitem) WHERE copy = 1
    """,
    "surrogate_keys_two_loads": over(
        """WITH keyed AS (
            SELECT *, row_number() OVER (ORDER BY defect_id % 3 <> 0, defect_id, defect_type) AS n
            FROM (SELECT DISTINCT defect_id, defect_type FROM defects_v
                WHERE defect_type IS NOT NULL))
        SELECT d.defect_id, d.defect_type, 'DF' || lpad(CAST(n AS VARCHAR), 7, '0') AS defect_key
        FROM defects_v d LEFT JOIN keyed k
            ON k.defect_id = d.defect_id AND k.defect_type = d.defect_type""",
        "defects_v",
    ),
    "null_profile_merged": WHOLE["null_profile"],
    "column_profile_merged": over(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
            {f"CAST(min({c}) AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"} AS min_value,
            {f"CAST(max({c}) AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"} AS max_value,
            TRUE AS distinct_close, TRUE AS median_close FROM downtime_v"""
            for c, number in (
                ("event_id", True), ("machine_id", True), ("reason_code", False),
                ("duration_minutes", True), ("is_planned", False), ("start_time", False),
            )
        ),
        "downtime_v",
    ),
    "tail_extract_clustered": WHOLE["tail_extract"],
    "sensor_hourly_period": over(
        """WITH bounds AS (
            SELECT min(timestamp) AS a, max(timestamp) AS z FROM sensor_v)
        SELECT machine_id, sensor_type, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS hour,
            round(avg(reading_value), 6) AS mean_value, round(min(reading_value), 6) AS min_value,
            round(max(reading_value), 6) AS max_value, count(reading_value) AS n_readings
        FROM sensor_v, bounds
        WHERE epoch_us(timestamp) >= epoch_us(a) + (epoch_us(z) - epoch_us(a)) * 0.75
        GROUP BY ALL""",
        "sensor_v",
    ),
    "sensor_hourly_stream": WHOLE["sensor_hourly"],
}
