"""SQL counterparts of the registered queries, for an independent engine.

Written from the definitions of the KPIs, not from the Spark plans: plain window functions,
joins and built-in quantiles over whole tables.
"""

from __future__ import annotations

VIEWS = {
    "production_v": """
        SELECT l_orderkey, l_linenumber, l_suppkey AS machine_id, s_nationkey AS factory_id,
            l_linenumber % 3 AS shift_id, CAST(l_shipdate AS DATE) AS date,
            CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 0e0 ELSE l_quantity * 10e0 END
                AS planned_production_time_minutes,
            CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 0e0
                ELSE l_quantity * 10e0 * (1e0 - l_discount) END AS run_time_minutes,
            CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN -5e0
                ELSE l_quantity * 10e0 * l_discount END AS downtime_minutes,
            20e0 + 1.4e0 * p_size AS ideal_cycle_time_seconds,
            CAST(l_quantity * 10 AS BIGINT) AS total_units_produced,
            CAST(floor(l_quantity * 10 * (1e0 - l_tax)) AS BIGINT) AS good_units,
            CAST(l_quantity * 10 AS BIGINT)
                - CAST(floor(l_quantity * 10 * (1e0 - l_tax)) AS BIGINT) AS scrap_units
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    """,
    "downtime_v": """
        SELECT event_id, user_id + 50 AS machine_id,
            CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_type END AS reason_code,
            value AS duration_minutes,
            CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_id % 5 = 0 END AS is_planned,
            ts AS start_time
        FROM events
    """,
    "inspections_v": """
        SELECT l_orderkey * 10 + l_linenumber AS inspection_id, s_nationkey AS factory_id,
            CAST(l_quantity AS BIGINT) AS sample_size,
            CAST(floor(l_quantity * l_tax) AS BIGINT) AS defective_units,
            CASE WHEN floor(l_quantity * l_tax) = 0 THEN 'Pass' ELSE 'Fail' END AS result
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
    """,
    "defects_v": """
        SELECT l_orderkey * 10 + l_linenumber AS defect_id,
            CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE p_brand END AS defect_type
        FROM lineitem JOIN part ON p_partkey = l_partkey
        WHERE l_returnflag = 'R'
    """,
    "sensor_v": """
        SELECT event_id, user_id AS machine_id, event_type AS sensor_type, ts AS timestamp,
            CASE WHEN event_id % 199 = 0 THEN NULL ELSE value END AS reading_value
        FROM events
    """,
    "raw_events_v": """
        SELECT event_id,
            CASE WHEN event_id % 97 = 0 THEN 'not_a_number'
                WHEN event_id % 89 = 0 THEN '  ' || CAST(value AS VARCHAR) || ' '
                ELSE CAST(value AS VARCHAR) END AS reading_text,
            CASE WHEN event_id % 83 = 0 THEN 'some day' ELSE CAST(ts AS VARCHAR) END AS time_text,
            event_type, nullif(event_type, 'error') AS operator_id
        FROM events
    """,
}


def ratio(numerator: str, denominator: str) -> str:
    """Division with the plant convention: 0 for a zero or missing operand."""
    return (
        f"coalesce(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0e0), 0e0)"
    )


def oee_rows(records: str) -> str:
    """Production records with the row-level KPIs."""
    ideal = "ideal_cycle_time_seconds * total_units_produced / 60e0"
    return f"""
        SELECT *, availability * performance * quality AS oee FROM (
            SELECT *, strftime(date, '%Y-%m') AS month,
                {ratio("run_time_minutes", "planned_production_time_minutes")} AS availability,
                least({ratio(ideal, "run_time_minutes")}, 1.5e0) AS performance,
                {ratio("good_units", "total_units_produced")} AS quality,
                {ratio("scrap_units", "total_units_produced")} AS scrap_rate,
                {ratio("run_time_minutes * 60e0", "total_units_produced")}
                    AS cycle_time_actual_seconds,
                {ratio("run_time_minutes", "planned_production_time_minutes")} AS utilization,
                {ratio("total_units_produced", "run_time_minutes / 60e0")}
                    AS throughput_units_per_hour
            FROM {records})
    """


VIEWS["oee_v"] = oee_rows("production_v")
VIEW_INPUTS = {"oee_v": ["production_v"]}


def over(body: str, *views: str) -> str:
    """``body`` with the views it reads in front."""
    needed: list[str] = []
    for view in views:
        needed += [v for v in (*VIEW_INPUTS.get(view, []), view) if v not in needed]
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in needed)
    body = body.strip()
    if body.startswith("WITH "):
        return f"WITH {ctes}, {body.removeprefix('WITH ')}"
    return f"WITH {ctes} {body}"


def weighted(rate: str, weight: str) -> str:
    return (
        f"CASE WHEN coalesce(sum({weight}), 0) <> 0 THEN "
        f"coalesce(sum({rate} * {weight}), 0e0) / CAST(sum({weight}) AS DOUBLE) END"
    )


KPI_MEASURES = f"""
    CAST(coalesce(sum(total_units_produced), 0) AS BIGINT) AS total_units_produced,
    CAST(coalesce(sum(good_units), 0) AS BIGINT) AS good_units,
    CAST(coalesce(sum(scrap_units), 0) AS BIGINT) AS scrap_units,
    round(coalesce(sum(planned_production_time_minutes), 0e0), 3)
        AS planned_production_time_minutes,
    round(coalesce(sum(run_time_minutes), 0e0), 3) AS run_time_minutes,
    round(coalesce(sum(downtime_minutes), 0e0), 3) AS downtime_minutes,
    round({weighted("availability", "planned_production_time_minutes")}, 6) AS availability,
    round({weighted("performance", "run_time_minutes")}, 6) AS performance,
    round({weighted("quality", "total_units_produced")}, 6) AS quality,
    round({weighted("oee", "planned_production_time_minutes")}, 6) AS oee,
    round({ratio("sum(scrap_units)", "sum(total_units_produced)")}, 6) AS scrap_rate,
    round({weighted("throughput_units_per_hour", "run_time_minutes")}, 6)
        AS throughput_units_per_hour
"""


def kpis_by(*keys: str) -> str:
    listed = ", ".join(keys)
    return over(f"SELECT {listed}, {KPI_MEASURES} FROM oee_v GROUP BY {listed}", "oee_v")


def oee_by(key: str, name: str = "oee") -> str:
    """CTE body: unrounded weighted OEE per key."""
    return (
        f"SELECT {key}, {weighted('oee', 'planned_production_time_minutes')} AS {name} "
        f"FROM oee_v GROUP BY {key}"
    )


TARGETS = {
    "oee": "0.75e0",
    "availability": "0.9e0",
    "performance": "0.9e0",
    "quality": "0.98e0",
    "scrap_rate": "0.03e0",
}


def status_rows(wide: str, keys: str, kpis: list[str]) -> str:
    """Long status table over the CTE ``wide``, one branch per KPI."""
    branches = []
    for name in kpis:
        target = TARGETS.get(name)
        if target is None:
            status, target = "'N/A'", "CAST(NULL AS DOUBLE)"
        elif name == "scrap_rate":
            status = (
                f"CASE WHEN {name} IS NULL THEN 'N/A' WHEN {name} <= {target} THEN 'Green' "
                f"WHEN {name} <= {target} * 1.2e0 THEN 'Amber' ELSE 'Red' END"
            )
        else:
            status = (
                f"CASE WHEN {name} IS NULL THEN 'N/A' WHEN {name} >= {target} THEN 'Green' "
                f"WHEN {name} >= {target} * 0.9e0 THEN 'Amber' ELSE 'Red' END"
            )
        branches.append(
            f"SELECT {keys}, '{name}' AS kpi, round({name}, 6) AS value, {target} AS target, "
            f"{status} AS status FROM {wide}"
        )
    return " UNION ALL ".join(branches)


MTBF = f"""
    WITH up AS (
        SELECT machine_id, sum(run_time_minutes) AS run FROM production_v GROUP BY machine_id),
    fail AS (
        SELECT machine_id, count(event_id) AS n, sum(duration_minutes) AS down
        FROM downtime_v WHERE is_planned = FALSE GROUP BY machine_id),
    joined AS (
        SELECT up.machine_id, coalesce(run, 0e0) AS run, coalesce(n, 0) AS n,
            coalesce(down, 0e0) AS down
        FROM up LEFT JOIN fail ON up.machine_id = fail.machine_id),
    mtbf AS (
        SELECT machine_id, round(run, 3) AS total_run_time_minutes,
            CAST(n AS BIGINT) AS failure_count, round(down, 3) AS total_downtime_minutes,
            round({ratio("run / 60e0", "n")}, 6) AS mtbf_hours,
            round({ratio("down / 60e0", "n")}, 6) AS mttr_hours
        FROM joined)
"""

PARETO = """
    WITH counts AS (
        SELECT defect_type, count(*) AS n FROM defects_v
        WHERE defect_type IS NOT NULL GROUP BY defect_type),
    pareto AS (
        SELECT defect_type, CAST(n AS BIGINT) AS "count",
            CAST(n AS DOUBLE) * 100e0 / CAST(sum(n) OVER () AS DOUBLE) AS pct,
            CAST(sum(n) OVER (ORDER BY n DESC, defect_type
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) * 100e0
                / CAST(sum(n) OVER () AS DOUBLE) AS cum
        FROM counts)
"""

CONTROL = """
    WITH limits AS (
        SELECT avg(reading_value) AS center,
            avg(reading_value) + 3e0 * stddev_samp(reading_value) AS ucl,
            avg(reading_value) - 3e0 * stddev_samp(reading_value) AS lcl
        FROM sensor_v),
    chart AS (
        SELECT event_id, reading_value, center, ucl, lcl,
            coalesce(reading_value > ucl OR reading_value < lcl, FALSE) AS out_of_control
        FROM sensor_v CROSS JOIN limits)
"""

MINUTES = "l_orderkey, l_linenumber, machine_id, round({}, 6) AS minutes FROM production_v"

CLEAN_PRODUCTION = """
    WITH ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY factory_id, machine_id, date, shift_id
            ORDER BY l_orderkey, l_linenumber, planned_production_time_minutes,
                run_time_minutes, downtime_minutes NULLS FIRST, ideal_cycle_time_seconds,
                total_units_produced, good_units, scrap_units) AS copy
        FROM production_v),
    deduped AS (SELECT * EXCLUDE (copy) FROM ranked WHERE copy = 1),
    filled AS (
        SELECT * REPLACE (coalesce(downtime_minutes,
            (SELECT median(downtime_minutes) FROM deduped)) AS downtime_minutes)
        FROM deduped),
    moments AS (
        SELECT avg(downtime_minutes) AS dm, stddev_pop(downtime_minutes) AS ds,
            avg(total_units_produced) AS um, stddev_pop(total_units_produced) AS us
        FROM filled),
    flagged AS (
        SELECT filled.*, abs(downtime_minutes - dm) > 3e0 * ds AS downtime_minutes_is_outlier,
            abs(total_units_produced - um) > 3e0 * us AS total_units_produced_is_outlier
        FROM filled CROSS JOIN moments)
"""

CLEAN_DOWNTIME = """
    WITH flagged AS (
        SELECT downtime_v.*, abs(duration_minutes - m) > 3e0 * s AS duration_minutes_is_outlier
        FROM downtime_v CROSS JOIN (
            SELECT avg(duration_minutes) AS m, stddev_pop(duration_minutes) AS s FROM downtime_v))
"""

CLEAN_SENSOR = """
    WITH ranked AS (
        SELECT *, row_number() OVER (PARTITION BY machine_id, timestamp, sensor_type
            ORDER BY event_id, reading_value NULLS FIRST) AS copy
        FROM sensor_v),
    deduped AS (SELECT * EXCLUDE (copy) FROM ranked WHERE copy = 1),
    filled AS (
        SELECT * REPLACE (coalesce(reading_value,
            (SELECT median(reading_value) FROM deduped)) AS reading_value)
        FROM deduped),
    flagged AS (
        SELECT filled.*, abs(reading_value - m) > 3e0 * s AS reading_value_is_outlier
        FROM filled CROSS JOIN (
            SELECT avg(reading_value) AS m, stddev_pop(reading_value) AS s FROM filled))
"""


def _report(table: str, view: str, deduped: str, cleaned: str, filled: str, flags: list[str]):
    """Branches of the cleaning report; ``filled`` and ``flags`` name the columns concerned."""

    def row(metric: str, value: str, column: str = "") -> str:
        return (
            f"SELECT '{table}' AS table_name, '{metric}' AS metric, '{column}' AS column_name, "
            f"CAST(({value}) AS BIGINT) AS value"
        )

    before, after = f"SELECT count(*) FROM {view}", f"SELECT count(*) FROM {deduped}"
    rows = [
        row("rows_before", before),
        row("rows_after", after),
        row("duplicates_removed", f"({before}) - ({after})"),
    ]
    if filled:
        missing = f"SELECT count(*) FROM {deduped} WHERE {filled} IS NULL"
        rows.append(row("missing_filled", missing, filled))
    for column in flags:
        flagged = f"SELECT count(*) FROM {cleaned} WHERE {column}_is_outlier"
        rows.append(row("outliers_flagged", flagged, column))
    return rows


def _cleaning_report() -> str:
    """All five reports in one statement, with the CTEs of each plan under its own prefix."""

    def prefixed(sql: str, prefix: str, names: list[str]) -> str:
        body = sql.strip().removeprefix("WITH ")
        for name in names:
            for before in ("FROM ", "JOIN ", "\n    ", "SELECT "):
                body = body.replace(f"{before}{name} AS (", f"{before}{prefix}_{name} AS (")
                body = body.replace(f"{before}{name})", f"{before}{prefix}_{name})")
                body = body.replace(f"{before}{name} ", f"{before}{prefix}_{name} ")
                body = body.replace(f"{before}{name}.*", f"{before}{prefix}_{name}.*")
                body = body.replace(f"{before}{name}\n", f"{before}{prefix}_{name}\n")
            if body.startswith(f"{name} AS ("):
                body = f"{prefix}_{body}"
        return body

    steps = ["ranked", "deduped", "filled", "moments", "flagged"]
    ctes = [
        prefixed(CLEAN_PRODUCTION, "p", steps),
        prefixed(CLEAN_DOWNTIME, "d", ["flagged"]),
        prefixed(CLEAN_SENSOR, "s", steps),
        "q_deduped AS (SELECT DISTINCT * FROM inspections_v)",
        "f_deduped AS (SELECT DISTINCT * FROM defects_v)",
    ]
    rows = [
        *_report(
            "production",
            "production_v",
            "p_deduped",
            "p_flagged",
            "downtime_minutes",
            ["downtime_minutes", "total_units_produced"],
        ),
        *_report("downtime", "downtime_v", "downtime_v", "d_flagged", "", ["duration_minutes"]),
        *_report("quality", "inspections_v", "q_deduped", "", "", []),
        *_report("defects", "defects_v", "f_deduped", "", "", []),
        *_report("sensor", "sensor_v", "s_deduped", "s_flagged", "reading_value", ["reading_value"]),
    ]
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(rows)


def _null_profile() -> str:
    columns = [
        "event_id", "machine_id", "reason_code", "duration_minutes", "is_planned", "start_time",
    ]
    return " UNION ALL ".join(
        f"""SELECT 'downtime' AS table_name, count(*) AS row_count,
            CAST({len(columns)} AS BIGINT) AS column_count, '{c}' AS column_name,
            count(*) - count({c}) AS null_count,
            round((count(*) - count({c})) * 100e0 / count(*), 6) AS null_pct,
            (count(*) - count({c})) * 100e0 / count(*) > 1.5e0 AS too_many_nulls,
            count(*) < 50000 AS too_few_rows
        FROM downtime_v"""
        for c in columns
    )


def _rules() -> str:
    rules = [
        ("good_within_total", "production_v", "good_units <= total_units_produced + 1"),
        ("downtime_not_negative", "production_v", "downtime_minutes >= 0"),
        ("some_planned_time", "production_v", "planned_production_time_minutes > 0"),
        ("defective_within_sample", "inspections_v", "defective_units <= sample_size"),
        ("brand_prefix", "defects_v", "defect_type LIKE 'Brand#1%'"),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS rule_name, count(*) AS rows_checked,
            count(*) FILTER (WHERE NOT ({rule})) AS violations FROM {view}"""
        for name, view, rule in rules
    )


SCHEMA_CHECKS = [
    ("not_empty", "", "at least one row", "count(*) FILTER (WHERE FALSE)"),
    ("required", "event_id", "column exists", "0"),
    ("required", "reading_text", "column exists", "0"),
    ("required", "inspector_id", "column exists", "1"),
    ("dtype", "event_id", "int", "0"),
    ("dtype", "reading_text", "float", "1"),
    (
        "castable",
        "reading_text",
        "double",
        "count(*) FILTER (WHERE reading_text IS NOT NULL "
        "AND TRY_CAST(reading_text AS DOUBLE) IS NULL)",
    ),
    (
        "castable",
        "time_text",
        "timestamp_ntz",
        "count(*) FILTER (WHERE time_text IS NOT NULL "
        "AND TRY_CAST(time_text AS TIMESTAMP) IS NULL)",
    ),
]

SAMPLE_TABLES = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
    "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2,
    "labels": 3, "conversations": 4,
}

ORACLES: dict[str, str] = {
    "scan_tables": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, "
        f"CAST({n} AS BIGINT) AS column_count FROM {t}"
        for t, n in SAMPLE_TABLES.items()
    ),
    "safe_divide": over(
        f"""SELECT l_orderkey, l_linenumber,
            {ratio("run_time_minutes", "planned_production_time_minutes")} AS run_share,
            {ratio("total_units_produced", "downtime_minutes")} AS units_per_stop_minute
        FROM production_v""",
        "production_v",
    ),
    "oee_components": over(
        """SELECT l_orderkey, l_linenumber, machine_id, availability, performance, quality, oee,
            scrap_rate, cycle_time_actual_seconds, utilization, throughput_units_per_hour
        FROM oee_v""",
        "oee_v",
    ),
    "date_functions": """
        WITH moved AS (
            SELECT *, CAST(l_shipdate AS DATE) AS day,
                l_shipdate + to_minutes(CAST(l_quantity * 17 AS BIGINT)) AS later
            FROM lineitem)
        SELECT l_orderkey, l_linenumber,
            CAST(date_trunc('month', day) + INTERVAL 7 MONTH AS DATE)
                + CAST(least(day(day), 28) - 1 AS INTEGER) AS seven_months_on,
            isodow(day) >= 6 AS weekend, CAST(dayofyear(day) AS INTEGER) AS day_of_year,
            strftime(day, '%Y-%m') AS month, later,
            CAST(date_trunc('hour', later) AS TIMESTAMP) AS hour
        FROM moved
    """,
    "shift_hours": """
        WITH clocks AS (
            SELECT event_id, strftime(ts, '%H:%M') AS start_time,
                strftime(ts + to_minutes(CAST(floor(value) AS BIGINT)), '%H:%M') AS end_time
            FROM events),
        minutes AS (
            SELECT *,
                (CAST(split_part(end_time, ':', 1) AS INTEGER) * 60
                    + CAST(split_part(end_time, ':', 2) AS INTEGER)
                    - CAST(split_part(start_time, ':', 1) AS INTEGER) * 60
                    - CAST(split_part(start_time, ':', 2) AS INTEGER) + 1440) % 1440 AS span
            FROM clocks)
        SELECT event_id, start_time, end_time,
            round(CASE WHEN span = 0 THEN 24e0 ELSE span / 60e0 END, 6) AS duration_hours
        FROM minutes
    """,
    "material_downtime": over(
        f"SELECT {MINUTES.format('downtime_minutes')} WHERE coalesce(downtime_minutes, 0e0) > 5e0",
        "production_v",
    ),
    "weighted_avg": over(
        f"""SELECT machine_id,
            round({weighted("downtime_minutes", "planned_production_time_minutes")}, 6) AS by_plan,
            round({weighted("ideal_cycle_time_seconds", "downtime_minutes")}, 6) AS by_downtime
        FROM production_v GROUP BY machine_id""",
        "production_v",
    ),
    "kpi_by_factory": kpis_by("factory_id"),
    "kpi_by_machine": kpis_by("machine_id"),
    "kpi_by_shift": kpis_by("shift_id"),
    "kpi_monthly": kpis_by("month") + " ORDER BY month",
    "kpi_factory_month": kpis_by("factory_id", "month"),
    "kpi_all_grains": over(
        " UNION ALL ".join(
            f"SELECT '{g}' AS grain, CAST({g} AS VARCHAR) AS grain_value, {KPI_MEASURES} "
            f"FROM oee_v GROUP BY {g}"
            for g in ("month", "factory_id", "machine_id", "shift_id")
        ),
        "oee_v",
    ),
    "kpi_trend_series": over(
        f"WITH monthly AS ({oee_by('month')}) SELECT month, round(oee, 6) AS oee FROM monthly",
        "oee_v",
    ),
    "kpi_percent_table": over(
        "WITH k AS (SELECT factory_id, "
        + f"""{weighted("oee", "planned_production_time_minutes")} AS oee,
            {weighted("availability", "planned_production_time_minutes")} AS availability,
            {weighted("performance", "run_time_minutes")} AS performance,
            {weighted("quality", "total_units_produced")} AS quality,
            {ratio("sum(scrap_units)", "sum(total_units_produced)")} AS scrap_rate
        FROM oee_v GROUP BY factory_id)
        SELECT factory_id, """
        + ", ".join(
            f"CAST(round_even({c} * 100, 1) AS VARCHAR) || '%' AS {c}"
            for c in ("oee", "availability", "performance", "quality", "scrap_rate")
        )
        + " FROM k",
        "oee_v",
    ),
    "kpi_heatmap": over(
        "SELECT factory_id, "
        + ", ".join(
            f"round(CASE WHEN sum(w) FILTER (WHERE shift_id = {s}) <> 0 THEN "
            f"sum(oee * w) FILTER (WHERE shift_id = {s}) "
            f"/ sum(w) FILTER (WHERE shift_id = {s}) END, 6) AS shift_{s}"
            for s in (0, 1, 2)
        )
        + " FROM (SELECT *, planned_production_time_minutes AS w FROM oee_v) GROUP BY factory_id",
        "oee_v",
    ),
    "headline_kpis": over(
        """SELECT round(avg(oee), 6) AS oee, round(avg(availability), 6) AS availability,
            round(avg(performance), 6) AS performance, round(avg(quality), 6) AS quality,
            round(avg(scrap_rate), 6) AS scrap_rate,
            strftime(min(date), '%Y-%m-%d') AS period_start,
            strftime(max(date), '%Y-%m-%d') AS period_end
        FROM oee_v""",
        "oee_v",
    ),
    "mtbf_mttr": over(MTBF + " SELECT * FROM mtbf", "production_v", "downtime_v"),
    "worst_mtbf_topk": over(
        MTBF
        + " SELECT * FROM mtbf ORDER BY mtbf_hours, machine_id LIMIT 10",
        "production_v",
        "downtime_v",
    ),
    "worst_mtbf_failing_topk": over(
        MTBF
        + " SELECT * FROM mtbf WHERE failure_count > 0 ORDER BY mtbf_hours, machine_id LIMIT 10",
        "production_v",
        "downtime_v",
    ),
    "defect_rate": over(
        f"""SELECT factory_id, CAST(sum(sample_size) AS BIGINT) AS units_inspected,
            CAST(sum(defective_units) AS BIGINT) AS defective_units,
            count(inspection_id) AS inspections_count,
            count(*) FILTER (WHERE result = 'Pass') AS pass_count,
            round({ratio("sum(defective_units)", "sum(sample_size)")}, 6) AS defect_rate,
            round({ratio("count(*) FILTER (WHERE result = 'Pass')", "count(inspection_id)")}, 6)
                AS first_pass_yield
        FROM inspections_v GROUP BY factory_id""",
        "inspections_v",
    ),
    "pareto": over(
        PARETO
        + """ SELECT defect_type, "count", round(pct, 6) AS pct_of_total,
            round(cum, 6) AS cumulative_pct FROM pareto ORDER BY "count" DESC, defect_type""",
        "defects_v",
    ),
    "pareto_vital_few": over(
        PARETO
        + """ SELECT defect_type, "count", round(pct, 6) AS pct_of_total,
            round(cum, 6) AS cumulative_pct, cum <= 80e0 AS is_vital_few FROM pareto""",
        "defects_v",
    ),
    "lookup_join": over(
        """SELECT event_id, machine_id, sensor_type,
            CASE sensor_type WHEN 'click' THEN 'count' WHEN 'view' THEN 's'
                WHEN 'purchase' THEN 'eur' END AS unit,
            s_nationkey AS factory_id
        FROM sensor_v LEFT JOIN supplier ON s_suppkey = machine_id""",
        "sensor_v",
    ),
    "fk_orphans": over(
        """SELECT machine_id, count(*) AS child_rows FROM downtime_v
        WHERE machine_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY machine_id""",
        "downtime_v",
    ),
    "slot_coverage": over(
        """WITH days AS (
            SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE)
                AS date
            FROM production_v),
        grid AS (
            SELECT s_suppkey AS machine_id, date, shift_id
            FROM supplier CROSS JOIN days CROSS JOIN (VALUES (0), (1), (2)) AS s(shift_id))
        SELECT machine_id, shift_id, count(*) AS missing_slots, min(date) AS first_missing,
            max(date) AS last_missing
        FROM grid ANTI JOIN production_v USING (machine_id, date, shift_id)
        GROUP BY machine_id, shift_id""",
        "production_v",
    ),
    "slot_gaps": over(
        """WITH days AS (
            SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE)
                AS date
            FROM production_v),
        missing AS (
            SELECT * FROM (
                SELECT s_suppkey AS machine_id, date, shift_id
                FROM supplier CROSS JOIN days CROSS JOIN (VALUES (0), (1), (2)) AS s(shift_id))
            ANTI JOIN production_v USING (machine_id, date, shift_id)),
        islands AS (
            SELECT *, date - CAST(row_number() OVER (PARTITION BY machine_id, shift_id ORDER BY date)
                AS INTEGER) AS island
            FROM missing)
        SELECT machine_id, shift_id, min(date) AS first, max(date) AS last, count(*) AS days
        FROM islands GROUP BY machine_id, shift_id, island""",
        "production_v",
    ),
    "slot_grid": over(
        """WITH days AS (
            SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE)
                AS date
            FROM production_v)
        SELECT date, count(*) AS missing_slots FROM (
            SELECT s_suppkey AS machine_id, date, shift_id
            FROM supplier CROSS JOIN days CROSS JOIN (VALUES (0), (1), (2)) AS s(shift_id))
            ANTI JOIN production_v USING (machine_id, date, shift_id)
        GROUP BY date""",
        "production_v",
    ),
    "union_all": over(
        """SELECT machine_id, round(downtime_minutes, 6) AS minutes, 'record' AS origin
        FROM production_v
        UNION ALL SELECT machine_id, round(duration_minutes, 6), 'event' FROM downtime_v""",
        "production_v",
        "downtime_v",
    ),
    "unpivot_sensors": " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS sensor_type, {c} AS reading_value FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
    "expand_units": over(
        """SELECT inspection_id, factory_id, unnest(generate_series(1, defective_units)) AS unit_no
        FROM inspections_v WHERE defective_units > 0""",
        "inspections_v",
    ),
    "roster_by_factory": """
        WITH ranked AS (
            SELECT s_nationkey AS factory_id, s_suppkey AS m,
                (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) // 1000
                    AS page
            FROM supplier)
        SELECT factory_id, CAST(page AS BIGINT) AS page, count(*) AS members,
            string_agg(CAST(m AS VARCHAR), ',' ORDER BY m) AS roster
        FROM ranked GROUP BY factory_id, page
    """,
    "surrogate_keys": over(
        """SELECT defect_id, defect_type, 'DF' || lpad(CAST(row_number() OVER (
            ORDER BY defect_id, defect_type NULLS FIRST) AS VARCHAR), 7, '0') AS defect_key
        FROM defects_v""",
        "defects_v",
    ),
    "tail_extract": over(
        "SELECT * FROM sensor_v ORDER BY timestamp DESC, event_id DESC LIMIT 100", "sensor_v"
    ),
    "tail_extract_large": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
        ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
            l_quantity DESC
        LIMIT 20000
    """,
    "sensor_hourly_nan": over(
        """SELECT machine_id, sensor_type, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS hour,
            round(avg(v), 6) AS mean_value, round(min(v), 6) AS min_value,
            round(max(v), 6) AS max_value, count(v) AS n_readings
        FROM (SELECT *, CASE WHEN event_id % 13 <> 0 THEN reading_value END AS v FROM sensor_v)
        GROUP BY ALL""",
        "sensor_v",
    ),
    "running_sum": over(
        """SELECT *, CAST(sum(v) OVER (PARTITION BY k ORDER BY event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
        FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE machine_id END AS k,
            CASE WHEN event_id % 10 = 0 THEN CAST(1 AS BIGINT) END AS v FROM sensor_v)""",
        "sensor_v",
    ),
    "csv_round_trip": """
        SELECT doc_id AS id, md5('say "so", \\' || text) AS body, lang FROM documents
        UNION ALL SELECT n_nationkey, md5(n_name), 'nation' FROM nation
    """,
    "sensor_hourly": over(
        """SELECT machine_id, sensor_type, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS hour,
            round(avg(reading_value), 6) AS mean_value, round(min(reading_value), 6) AS min_value,
            round(max(reading_value), 6) AS max_value, count(reading_value) AS n_readings
        FROM sensor_v GROUP BY ALL""",
        "sensor_v",
    ),
    "clean_coerce": over(
        """SELECT event_id, TRY_CAST(reading_text AS DOUBLE) AS reading_text,
            TRY_CAST(time_text AS TIMESTAMP) AS time_text FROM raw_events_v""",
        "raw_events_v",
    ),
    "clean_dedupe": """
        SELECT * EXCLUDE (copy) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                    l_returnflag, l_linestatus, l_shipdate) AS copy
            FROM lineitem) WHERE copy = 1
    """,
    "clean_dedupe_gaps": over(
        """WITH sent AS (
            SELECT * FROM sensor_v UNION ALL
            SELECT * REPLACE (CAST(NULL AS DOUBLE) AS reading_value) FROM sensor_v
            WHERE event_id % 7 = 0)
        SELECT * EXCLUDE (copy) FROM (
            SELECT *, row_number() OVER (PARTITION BY machine_id, sensor_type, timestamp
                ORDER BY event_id, reading_value NULLS LAST) AS copy FROM sent) WHERE copy = 1""",
        "sensor_v",
    ),
    "clean_missing_median": over(
        "SELECT "
        + MINUTES.format(
            "coalesce(downtime_minutes, (SELECT median(downtime_minutes) FROM production_v))"
        ),
        "production_v",
    ),
    "clean_missing_mean": over(
        "SELECT "
        + MINUTES.format(
            "coalesce(downtime_minutes, (SELECT avg(downtime_minutes) FROM production_v))"
        ),
        "production_v",
    ),
    "clean_missing_ffill": over(
        """SELECT * REPLACE (coalesce(
            last_value(reading_value IGNORE NULLS) OVER (ORDER BY timestamp, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value(reading_value IGNORE NULLS) OVER (ORDER BY timestamp, event_id
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS reading_value)
        FROM sensor_v""",
        "sensor_v",
    ),
    "clean_missing_ffill_by_machine": over(
        """SELECT * REPLACE (coalesce(
            last_value(reading_value IGNORE NULLS) OVER (PARTITION BY machine_id
                ORDER BY timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value(reading_value IGNORE NULLS) OVER (PARTITION BY machine_id
                ORDER BY timestamp, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
            AS reading_value)
        FROM sensor_v""",
        "sensor_v",
    ),
    "clean_missing_drop": over(
        f"SELECT {MINUTES.format('downtime_minutes')} WHERE downtime_minutes IS NOT NULL",
        "production_v",
    ),
    "clean_sentinel": over(
        """SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_type END
            AS reason_code, coalesce(operator_id, 'UNKNOWN') AS operator_id
        FROM raw_events_v""",
        "raw_events_v",
    ),
    "clean_outliers": over(
        """SELECT sensor_v.*, coalesce(abs(reading_value - m) > 3e0 * s, FALSE)
            AS reading_value_is_outlier
        FROM sensor_v CROSS JOIN (
            SELECT avg(reading_value) AS m, stddev_pop(reading_value) AS s FROM sensor_v)""",
        "sensor_v",
    ),
    "clean_non_negative": over(
        "SELECT "
        + MINUTES.format("CASE WHEN downtime_minutes < 0 THEN 0 ELSE downtime_minutes END"),
        "production_v",
    ),
    "clean_production": over(
        CLEAN_PRODUCTION
        + """ SELECT * REPLACE (
            round(greatest(downtime_minutes, 0), 3) AS downtime_minutes,
            round(planned_production_time_minutes, 3) AS planned_production_time_minutes,
            round(run_time_minutes, 3) AS run_time_minutes,
            round(ideal_cycle_time_seconds, 6) AS ideal_cycle_time_seconds)
        FROM flagged""",
        "production_v",
    ),
    "clean_kpi_by_factory": over(
        CLEAN_PRODUCTION
        + f""", cleaned AS (
            SELECT * REPLACE (greatest(downtime_minutes, 0e0) AS downtime_minutes) FROM flagged),
        rated AS ({oee_rows("cleaned")})
        SELECT factory_id, {KPI_MEASURES} FROM rated GROUP BY factory_id""",
        "production_v",
    ),
    "clean_downtime": over(
        CLEAN_DOWNTIME + " SELECT * REPLACE (round(duration_minutes, 6) AS duration_minutes)"
        " FROM flagged",
        "downtime_v",
    ),
    "clean_quality": over("SELECT DISTINCT * FROM inspections_v", "inspections_v"),
    "clean_defects": over("SELECT DISTINCT * FROM defects_v", "defects_v"),
    "clean_sensor": over(
        CLEAN_SENSOR + " SELECT * REPLACE (round(reading_value, 6) AS reading_value) FROM flagged",
        "sensor_v",
    ),
    "cleaning_report": over(
        _cleaning_report(), "production_v", "downtime_v", "inspections_v", "defects_v", "sensor_v"
    ),
    "schema_report": over(
        " UNION ALL ".join(
            f"""(SELECT 'events' AS table_name, '{check}' AS check_name, '{column}' AS column_name,
            '{detail}' AS detail, CAST({violations} AS BIGINT) AS violations
            FROM raw_events_v {"" if "count(" in violations else "LIMIT 1"})"""
            for check, column, detail, violations in SCHEMA_CHECKS
        ),
        "raw_events_v",
    ),
    "null_profile": over(_null_profile(), "downtime_v"),
    "rule_violations": over(_rules(), "production_v", "inspections_v", "defects_v"),
    "downtime_reconcile": over(
        """WITH recorded AS (
            SELECT l_orderkey AS record_id, count(*) AS record_rows,
                coalesce(sum(downtime_minutes), 0e0) AS rec
            FROM production_v GROUP BY l_orderkey),
        logged AS (
            SELECT event_id // 2 AS record_id, count(*) AS event_rows, sum(duration_minutes) AS ev
            FROM downtime_v GROUP BY event_id // 2)
        SELECT recorded.record_id, record_rows, round(rec, 3) AS recorded_minutes,
            coalesce(event_rows, 0) AS event_rows, round(coalesce(ev, 0e0), 3) AS event_minutes,
            round(coalesce(ev, 0e0) - rec, 3) AS difference_minutes
        FROM recorded LEFT JOIN logged ON recorded.record_id = logged.record_id""",
        "production_v",
        "downtime_v",
    ),
    "rag_status": over(
        f"""WITH k AS (
            SELECT machine_id, {weighted("oee", "planned_production_time_minutes")} AS oee,
                {weighted("availability", "planned_production_time_minutes")} AS availability,
                {weighted("performance", "run_time_minutes")} AS performance,
                {weighted("quality", "total_units_produced")} AS quality,
                {ratio("sum(scrap_units)", "sum(total_units_produced)")} AS scrap_rate,
                {weighted("throughput_units_per_hour", "run_time_minutes")}
                    AS throughput_units_per_hour
            FROM oee_v GROUP BY machine_id) """
        + status_rows("k", "machine_id", [*TARGETS, "throughput_units_per_hour"]),
        "oee_v",
    ),
    "rag_summary": over(
        """WITH h AS (
            SELECT avg(oee) AS oee, avg(availability) AS availability,
                avg(performance) AS performance, avg(quality) AS quality,
                avg(scrap_rate) AS scrap_rate, strftime(min(date), '%Y-%m-%d') AS period_start,
                strftime(max(date), '%Y-%m-%d') AS period_end
            FROM oee_v) """
        + status_rows("h", "period_start, period_end", list(TARGETS)),
        "oee_v",
    ),
    "gauge_bands": over(
        f"""WITH k AS ({oee_by("machine_id")}),
        p AS (SELECT *, round_even(oee * 100, 1) AS pct FROM k)
        SELECT machine_id, round(oee, 6) AS oee, round(pct, 6) AS value_pct,
            round(pct - 75e0, 6) AS delta_pct, 60e0 AS band_low_to, 75e0 AS band_middle_to,
            CASE WHEN pct IS NULL THEN 'N/A' WHEN pct < 60e0 THEN 'low'
                WHEN pct < 75e0 THEN 'middle' ELSE 'high' END AS band
        FROM p""",
        "oee_v",
    ),
    "control_chart": over(
        CONTROL
        + """ SELECT event_id, round(reading_value, 6) AS reading_value,
            round(center, 6) AS center, round(ucl, 6) AS ucl, round(lcl, 6) AS lcl, out_of_control
        FROM chart""",
        "sensor_v",
    ),
    "control_chart_monthly": over(
        f"""WITH m AS ({oee_by("month")}),
        l AS (SELECT avg(oee) AS center, stddev_samp(oee) AS sd FROM m)
        SELECT month, round(oee, 6) AS oee, round(center, 6) AS center,
            round(center + 3e0 * sd, 6) AS ucl, round(center - 3e0 * sd, 6) AS lcl,
            coalesce(oee > center + 3e0 * sd OR oee < center - 3e0 * sd, FALSE) AS out_of_control
        FROM m CROSS JOIN l""",
        "oee_v",
    ),
    "out_of_control": over(
        CONTROL + " SELECT event_id, reading_value FROM chart WHERE out_of_control", "sensor_v"
    ),
    "histogram_by_factory": over(
        """WITH e AS (
            SELECT min(cycle_time_actual_seconds) AS low,
                (max(cycle_time_actual_seconds) - min(cycle_time_actual_seconds)) / 10e0 AS width
            FROM oee_v),
        counted AS (
            SELECT factory_id,
                CAST(least(floor((cycle_time_actual_seconds - low) / width), 9) AS BIGINT) AS bin,
                count(*) AS n
            FROM oee_v CROSS JOIN e GROUP BY 1, 2)
        SELECT f.factory_id, b.bin, round(low + b.bin * width, 6) AS bin_start,
            round(low + (b.bin + 1) * width, 6) AS bin_end, coalesce(n, 0) AS "count"
        FROM (SELECT unnest(generate_series(0, 9)) AS bin) AS b
        CROSS JOIN (SELECT DISTINCT factory_id FROM oee_v) AS f
        LEFT JOIN counted ON counted.bin = b.bin AND counted.factory_id = f.factory_id
        CROSS JOIN e""",
        "oee_v",
    ),
    "histogram": over(
        """WITH e AS (
            SELECT min(cycle_time_actual_seconds) AS low,
                (max(cycle_time_actual_seconds) - min(cycle_time_actual_seconds)) / 30e0 AS width
            FROM oee_v),
        counted AS (
            SELECT CAST(least(floor((cycle_time_actual_seconds - low) / width), 29) AS BIGINT)
                AS bin, count(*) AS n
            FROM oee_v CROSS JOIN e GROUP BY 1)
        SELECT b.bin, round(low + b.bin * width, 6) AS bin_start,
            round(low + (b.bin + 1) * width, 6) AS bin_end, coalesce(n, 0) AS "count"
        FROM (SELECT unnest(generate_series(0, 29)) AS bin) AS b
        LEFT JOIN counted ON counted.bin = b.bin CROSS JOIN e""",
        "oee_v",
    ),
    "box_stats": over(
        """WITH q AS (
            SELECT factory_id, quantile_cont(oee, 0.25) AS q1, median(oee) AS med,
                quantile_cont(oee, 0.75) AS q3
            FROM oee_v GROUP BY factory_id),
        marked AS (
            SELECT oee_v.factory_id, oee, q1, med, q3,
                oee BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) AS inside
            FROM oee_v JOIN q ON q.factory_id = oee_v.factory_id)
        SELECT factory_id, count(*) AS n, round(any_value(q1), 9) AS q1,
            round(any_value(med), 9) AS median, round(any_value(q3), 9) AS q3,
            round(min(oee) FILTER (WHERE inside), 9) AS whisker_low,
            round(max(oee) FILTER (WHERE inside), 9) AS whisker_high,
            count(*) FILTER (WHERE NOT inside) AS outliers
        FROM marked GROUP BY factory_id""",
        "oee_v",
    ),
    "kpi_trendline": over(
        """SELECT factory_id, count(*) AS n,
            round(regr_slope(oee, cycle_time_actual_seconds), 6) AS slope,
            round(regr_intercept(oee, cycle_time_actual_seconds), 6) AS intercept,
            round(corr(cycle_time_actual_seconds, oee), 6) AS correlation
        FROM oee_v GROUP BY factory_id""",
        "oee_v",
    ),
}

# The pipelines as a whole are the single steps over the cleaned tables.
ORACLES["plant_factory_kpis"] = ORACLES["clean_kpi_by_factory"]


def _over_distinct(sql: str, view: str) -> str:
    """A statement with the rows of a view taken once each, as cleaning does without a key."""
    return sql.replace(f"FROM {view}", f"FROM (SELECT DISTINCT * FROM {view})")


ORACLES["plant_pareto"] = _over_distinct(ORACLES["pareto"], "defects_v")
ORACLES["plant_defect_rate"] = _over_distinct(ORACLES["defect_rate"], "inspections_v")
