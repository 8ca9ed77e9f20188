import pytest
from pyspark.sql import functions as F

from millwright.operators import kpi
from millwright.plans.plant import compute_kpis, kpi_summary


def by(rows, key):
    return {r[key]: r for r in rows}


def test_row_components(production):
    rows = by(kpi.add_oee_components(production).collect(), "record_id")
    expected = {
        "R1": (0.9, 0.8, 0.975, 0.702),
        "R2": (0.75, 0.8, 0.95, 0.57),
        "R3": (1.0, 0.75, 0.99, 0.7425),
    }
    for record, (a, p, q, oee) in expected.items():
        row = rows[record]
        got = (row["availability"], row["performance"], row["quality"], row["oee"])
        assert got == pytest.approx((a, p, q, oee), abs=1e-6)
        assert row["utilization"] == row["availability"]
    assert rows["R1"]["scrap_rate"] == 0.025
    assert rows["R1"]["cycle_time_actual_seconds"] == 30.0
    assert rows["R1"]["throughput_units_per_hour"] == pytest.approx(720 / 6)


def test_idle_row_is_zero_everywhere(spark):
    idle = spark.createDataFrame(
        [(0.0, 0.0, 30.0, 0, 0, 0)],
        """planned_production_time_minutes double, run_time_minutes double,
        ideal_cycle_time_seconds double, total_units_produced bigint, good_units bigint,
        scrap_units bigint""",
    )
    row = kpi.add_oee_components(idle).first()
    for name in (*kpi.HEADLINE_KPIS, "cycle_time_actual_seconds", "throughput_units_per_hour"):
        assert row[name] == 0.0


def test_performance_is_capped(production):
    fast = production.withColumn("run_time_minutes", F.lit(1.0))
    assert {r["performance"] for r in kpi.add_oee_components(fast).collect()} == {1.5}


def test_weighted_rollup(production):
    rows = by(kpi.aggregate_kpis(kpi.add_oee_components(production), ["factory_id"]).collect(), "factory_id")
    p1 = rows["P1"]
    got = (p1["availability"], p1["performance"], p1["quality"], p1["oee"])
    assert got == pytest.approx((0.81, 0.8, 1272 / 1320, 0.6228), abs=1e-6)
    assert p1["scrap_rate"] == pytest.approx(48 / 1320, abs=1e-6)
    assert p1["throughput_units_per_hour"] == pytest.approx(1320 / 13.5, abs=1e-6)
    assert (p1["total_units_produced"], p1["run_time_minutes"]) == (1320, 810.0)


def test_rollup_identities(production):
    row = kpi.aggregate_kpis(kpi.add_oee_components(production), ["factory_id"]).filter("factory_id = 'P1'").first()
    assert row["availability"] == pytest.approx(row["run_time_minutes"] / row["planned_production_time_minutes"])
    assert row["quality"] == pytest.approx(row["good_units"] / row["total_units_produced"])


def test_null_keys_form_no_group(production):
    with_gap = kpi.add_oee_components(
        production.withColumn("machine_id", F.when(F.col("record_id") != "R3", F.col("machine_id")))
    )
    assert kpi.aggregate_kpis(with_gap, ["machine_id"]).count() == 1
    grains = kpi.aggregate_kpis_by_grain(with_gap, ["factory_id", "machine_id"])
    assert {(r["grain"], r["grain_value"]) for r in grains.collect()} == {
        ("factory_id", "P1"), ("factory_id", "P2"), ("machine_id", "P1-A-1"),
    }


def test_all_grains_equal_single_rollups(production):
    rows = kpi.with_month(kpi.add_oee_components(production))
    together = kpi.aggregate_kpis_by_grain(rows, ["month", "factory_id", "shift_id"]).collect()
    for grain in ("month", "factory_id", "shift_id"):
        alone = by(kpi.aggregate_kpis(rows, [grain]).collect(), grain)
        mine = {r["grain_value"]: r for r in together if r["grain"] == grain}
        assert mine.keys() == alone.keys()
        for value, row in mine.items():
            for c in (*kpi.ADDITIVE_MEASURES, *kpi.RATE_WEIGHTS, "scrap_rate"):
                assert row[c] == pytest.approx(alone[value][c], abs=1e-12)


def test_missing_minutes_sum_to_zero(production):
    gap = production.withColumn("downtime_minutes", F.lit(None).cast("double"))
    row = kpi.aggregate_kpis(kpi.add_oee_components(gap), ["factory_id"]).first()
    assert row["downtime_minutes"] == 0.0


def test_empty_input_keeps_its_columns(production):
    empty = kpi.aggregate_kpis(kpi.add_oee_components(production.limit(0)), ["factory_id"])
    assert empty.count() == 0
    assert "throughput_units_per_hour" in empty.columns


def test_mtbf_mttr(downtime, production):
    rows = by(kpi.calculate_mtbf_mttr(downtime, production, ["machine_id"]).collect(), "machine_id")
    first, second = rows["P1-A-1"], rows["P2-A-1"]
    assert (first["failure_count"], first["mtbf_hours"]) == (1, 13.5)
    assert first["mttr_hours"] == pytest.approx(40 / 60)
    assert (second["failure_count"], second["mttr_hours"]) == (1, 0.0)
    assert second["mtbf_hours"] == pytest.approx(500 / 60)


def test_machine_without_failures_has_zeros(downtime, production):
    planned = downtime.withColumn("is_planned", F.lit(None).cast("boolean"))
    result = kpi.calculate_mtbf_mttr(planned, production, ["machine_id"])
    assert {(r["failure_count"], r["mtbf_hours"], r["mttr_hours"]) for r in result.collect()} == {(0, 0.0, 0.0)}
    assert dict(result.dtypes)["failure_count"] == "bigint"


def test_defect_rate(spark):
    inspections = spark.createDataFrame(
        [("P1", 80, 4, "I1", "Fail"), ("P1", 120, 2, "I2", "Pass"), ("P2", 40, 6, "I3", "Fail")],
        "factory_id string, sample_size bigint, defective_units bigint, inspection_id string, result string",
    )
    rows = by(kpi.calculate_defect_rate(inspections, ["factory_id"]).collect(), "factory_id")
    assert rows["P1"]["defect_rate"] == pytest.approx(0.03)
    assert rows["P2"]["defect_rate"] == pytest.approx(0.15)
    assert (rows["P1"]["first_pass_yield"], rows["P2"]["first_pass_yield"]) == (0.5, 0.0)


def test_pareto(spark):
    defects = spark.createDataFrame([(c,) for c in "QQQQRRS"] + [(None,)], "defect_type string")
    rows = kpi.pareto_analysis(defects).collect()
    assert [(r["defect_type"], r["count"]) for r in rows] == [("Q", 4), ("R", 2), ("S", 1)]
    assert [r["pct_of_total"] for r in rows] == pytest.approx([400 / 7, 200 / 7, 100 / 7])
    assert [r["cumulative_pct"] for r in rows] == pytest.approx([400 / 7, 600 / 7, 100.0])
    assert rows[-1]["cumulative_pct"] == 100.0
    flagged = kpi.vital_few(kpi.pareto_analysis(defects)).collect()
    assert [r["is_vital_few"] for r in flagged] == [True, False, False]


def test_pareto_with_many_tied_categories(spark):
    defects = spark.range(400).select(F.concat(F.lit("c"), F.lpad("id", 3, "0")).alias("defect_type"))
    rows = kpi.pareto_analysis(defects).collect()
    assert [r["defect_type"] for r in rows] == sorted(r["defect_type"] for r in rows)
    assert [r["cumulative_pct"] for r in rows] == pytest.approx([(i + 1) / 4 for i in range(400)])


def test_headline_is_the_unweighted_mean(production):
    row = kpi.headline_kpis(kpi.add_oee_components(production)).first()
    assert row["oee"] == pytest.approx((0.702 + 0.57 + 0.7425) / 3)
    assert (row["period_start"], row["period_end"]) == ("2024-03-04", "2024-03-05")


def test_percent_table(production):
    table = kpi.percent_table(kpi.aggregate_kpis(kpi.add_oee_components(production), ["factory_id"]), ["factory_id"])
    assert by(table.collect(), "factory_id")["P1"]["oee"] == "62.3%"


def test_material_downtime(spark):
    df = spark.createDataFrame([(5.0,), (5.1,), (None,)], "downtime_minutes double")
    assert [r[0] for r in kpi.material_downtime(df).collect()] == [5.1]


def test_compute_kpis_shares_one_pass(spark, production, downtime):
    inspections = spark.createDataFrame(
        [("P1", 10, 1, "I1", "Pass")],
        "factory_id string, sample_size bigint, defective_units bigint, inspection_id string, result string",
    )
    tables = {
        "production_records": production,
        "downtime_events": downtime,
        "quality_inspections": inspections,
        "defects": spark.createDataFrame([("A",)], "defect_type string"),
    }
    kpis = compute_kpis(tables)
    assert {n: df.count() for n, df in kpis.items()} == {
        "production_with_kpis": 3, "monthly_kpis": 1, "factory_kpis": 2, "machine_kpis": 2,
        "shift_kpis": 2, "mtbf_mttr_machine": 2, "defect_rate_factory": 1, "pareto": 1,
    }
    totals = {
        kpis[n].agg(F.sum("total_units_produced")).first()[0]
        for n in ("monthly_kpis", "factory_kpis", "machine_kpis", "shift_kpis")
    }
    assert totals == {2820}


def test_summary_has_targets_and_status(production):
    rows = by(kpi_summary(kpi.add_oee_components(production)).collect(), "kpi")
    # Means of the three records: availability 0.883 of 0.90, scrap rate 0.028 of at most 0.03.
    assert (rows["scrap_rate"]["target"], rows["scrap_rate"]["status"]) == (0.03, "Green")
    assert (rows["availability"]["target"], rows["availability"]["status"]) == (0.9, "Amber")
