"""KPI tables from stored sums against those from all records."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millwright.plans import refresh
from millwright.plans.plant import compute_kpis
from millwright.sources.publishing import folder_names, published_set


@pytest.fixture(scope="module")
def facts(spark):
    n = F.col("id")
    production = spark.range(600).select(
        F.concat(F.lit("R"), n).alias("record_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (n % 70).cast("int")).alias("date"),
        F.concat(F.lit("S"), n % 3).alias("shift_id"),
        F.when(n % 41 != 0, F.concat(F.lit("F"), n % 4)).alias("factory_id"),
        F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("M"), n % 7)).alias("machine_id"),
        F.lit(480.0).alias("planned_production_time_minutes"),
        F.when(n % 11 != 0, (n % 50).cast("double")).alias("downtime_minutes"),
        F.when(n % 13 != 0, 480.0 - n % 50).otherwise(0.0).alias("run_time_minutes"),
        F.lit(30.0).alias("ideal_cycle_time_seconds"),
        (n % 17 * 100).alias("total_units_produced"),
        (n % 17 * 90).alias("good_units"),
        (n % 17 * 10).alias("scrap_units"),
    )
    downtime = spark.range(300).select(
        n.alias("event_id"),
        F.concat(F.lit("M"), n % 9).alias("machine_id"),
        (n % 30).cast("double").alias("duration_minutes"),
        F.when(n % 29 != 0, n % 4 == 0).alias("is_planned"),
    )
    inspections = spark.range(200).select(
        n.alias("inspection_id"),
        F.concat(F.lit("F"), n % 4).alias("factory_id"),
        F.lit(50).cast("bigint").alias("sample_size"),
        (n % 5).alias("defective_units"),
        F.when(n % 5 == 0, "Pass").otherwise("Fail").alias("result"),
    )
    defects = spark.range(250).select(F.when(n % 19 != 0, F.concat(F.lit("T"), n * n % 11)).alias("defect_type"))
    return {
        "production_records": production,
        "downtime_events": downtime,
        "quality_inspections": inspections,
        "defects": defects,
    }


def split(facts, n):
    """Loads with every n-th row each, so that all groups are in all loads."""
    return [
        {
            name: df.withColumn("_i", F.monotonically_increasing_id()).filter(F.col("_i") % n == k).drop("_i")
            for name, df in facts.items()
        }
        for k in range(n)
    ]


def tables_of(kpis):
    out = {}
    for name, df in kpis.items():
        rows = df.collect()
        out[name] = sorted(
            ([(c, round(v, 9) if isinstance(v, float) else v) for c, v in zip(df.columns, r, strict=True)] for r in rows),
            key=repr,
        )
    return out


@pytest.fixture(scope="module")
def whole(facts):
    kpis = compute_kpis(facts)
    return tables_of({n: kpis[n] for n in kpis if n != "production_with_kpis"})


def test_loads_give_the_kpis_of_all_records(spark, tmp_path, facts, whole):
    folder = str(tmp_path / "store")
    one, two, three = split(facts, 3)
    refresh.add_load(folder, "2024-01", one)
    refresh.add_load(folder, "2024-02", two)
    refresh.add_load(folder, "2024-03", three)
    assert tables_of(refresh.refreshed_kpis(spark, folder)) == whole
    refresh.merge_loads(spark, folder)
    assert tables_of(refresh.refreshed_kpis(spark, folder)) == whole


def test_a_load_added_again_replaces_itself(spark, tmp_path, facts, whole):
    folder = str(tmp_path / "store")
    one, two = split(facts, 2)
    refresh.add_load(folder, "a", two)
    refresh.add_load(folder, "a", one)
    refresh.merge_loads(spark, folder)
    refresh.add_load(folder, "b", one)
    refresh.add_load(folder, "b", two)
    assert tables_of(refresh.refreshed_kpis(spark, folder)) == whole
    # A merged load is not counted a second time, though its folder is still there.
    assert "a" in folder_names(spark, f"{folder}/loads")
    with pytest.raises(ValueError, match="part of the base"):
        refresh.add_load(folder, "a", one)


def test_a_load_that_fails_is_not_there(spark, tmp_path, facts):
    folder = str(tmp_path / "store")
    one, _ = split(facts, 2)
    refresh.add_load(folder, "a", one)
    before = tables_of(refresh.refreshed_kpis(spark, folder))
    lost = one["defects"].withColumn("defect_type", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        refresh.add_load(folder, "b", {**one, "defects": lost})
    assert tables_of(refresh.refreshed_kpis(spark, folder)) == before
    assert published_set(spark, f"{folder}/loads/b") is None


def test_loads_of_some_tables_only(spark, tmp_path, facts):
    folder = str(tmp_path / "store")
    refresh.add_load(folder, "a", {"defects": facts["defects"]})
    assert set(refresh.refreshed_kpis(spark, folder)) == {"pareto"}
    refresh.add_load(folder, "b", {"production_records": facts["production_records"]})
    assert set(refresh.refreshed_kpis(spark, folder)) == {"pareto", *refresh.GRAIN_TABLES}
    with pytest.raises(ValueError, match="at least one"):
        refresh.add_load(folder, "c", {"factories": facts["defects"]})
    with pytest.raises(ValueError, match="load id"):
        refresh.add_load(folder, "../a", facts)


def test_old_records_are_not_read(spark, tmp_path, facts):
    """The KPI tables read the store's files alone, a row per day, machine and shift at most."""
    folder = str(tmp_path / "store")
    for k, load in enumerate(split(facts, 2)):
        refresh.add_load(folder, f"l{k}", load)
    sums = refresh.stored_sums(spark, folder)["production_sums"]
    assert all(folder in f for f in sums.inputFiles())
    keys = list(refresh.SUM_KEYS["production_sums"])
    assert sums.count() == facts["production_records"].select(*keys).distinct().count()
    assert refresh.merge_loads(spark, folder).version == 1
    assert refresh.merge_loads(spark, folder).version == 1
    assert refresh.stored_sums(spark, str(tmp_path / "none")) == {}
