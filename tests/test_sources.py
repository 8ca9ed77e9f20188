import datetime as dt
import os

import pytest

from millwright.plans.plant import compute_kpis
from millwright.schemas import TABLE_DDL, table_schema
from millwright.sources import staging, tables
from millwright.sources.staging import stage, staging_root


def test_schemas_parse():
    assert len(TABLE_DDL) == 10
    assert table_schema("production_records")["total_units_produced"].dataType.simpleString() == "bigint"


def test_csv_reading(spark, tmp_path):
    (tmp_path / "downtime_events.csv").write_text(
        "event_id,machine_id,reason_code,duration_minutes,is_planned,start_time\n"
        "DT1,M1,NA,43.8,False,2024-07-01T02:49:00\n"
        "DT2,M1,,bad,True,yesterday\n"
        "DT3,null,Jam,NaN,,2024-07-01 02:49:00\n"
    )
    (tmp_path / "notes.csv").write_text("a,b\n1,x\n")
    loaded = tables.load_tables(spark, str(tmp_path))
    assert set(loaded) == {"downtime_events", "notes"}
    assert dict(loaded["notes"].dtypes) == {"a": "string", "b": "string"}
    when = dt.datetime(2024, 7, 1, 2, 49)
    assert [tuple(r) for r in loaded["downtime_events"].collect()] == [
        ("DT1", "M1", None, 43.8, False, when),
        ("DT2", "M1", None, None, True, None),
        ("DT3", None, "Jam", None, None, when),
    ]


def test_whole_numbers_in_csv(spark, tmp_path):
    (tmp_path / "quality_inspections.csv").write_text("sample_size\n12\n12.0\n12.5\nx\n")
    df = tables.load_tables(spark, str(tmp_path))["quality_inspections"]
    assert [r[0] for r in df.collect()] == [12, 12, None, None]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip(spark, tmp_path, production, fmt):
    tables.write_tables({"production_records": production}, str(tmp_path), fmt=fmt)
    back = tables.load_tables(spark, str(tmp_path), fmt=fmt)["production_records"]
    assert back.schema.simpleString() == production.schema.simpleString()
    assert sorted(back.collect()) == sorted(production.collect())


def test_csv_dialect_round_trip(spark, tmp_path):
    texts = ['Plant "North", hall 2', "a,b", "back\\slash", "two\nlines", "", None, '"', "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "n bigint, t string")
    tables.write_tables({"notes": df}, str(tmp_path))
    back = tables.load_tables(spark, str(tmp_path), {}, multi_line=True, infer=True)["notes"]
    assert dict(back.dtypes) == {"n": "bigint", "t": "string"}
    # Empty text is one of the texts that stand for a missing value.
    assert {r["n"]: r["t"] for r in back.collect()} == dict(enumerate(t or None for t in texts))
    written = (f for f in (tmp_path / "notes.csv").iterdir() if f.name.startswith("part-"))
    lines = "".join(f.read_text() for f in written)
    assert '"Plant ""North"", hall 2"' in lines


def test_csv_rows_of_wrong_length_are_refused(spark, tmp_path):
    (tmp_path / "notes.csv").write_text("a,b,c\n1,2,3\n4,5\n")
    df = tables.load_tables(spark, str(tmp_path))["notes"]
    with pytest.raises(Exception, match="(?i)malformed"):
        df.collect()


def test_doubled_quotes_are_read(spark, tmp_path):
    (tmp_path / "factories.csv").write_text(
        "factory_id,factory_name,country,num_lines,timezone\n"
        'P1,"Hall ""East"", gate 4",DE,3,UTC\n'
    )
    row = tables.load_tables(spark, str(tmp_path))["factories"].first()
    assert tuple(row) == ("P1", 'Hall "East", gate 4', "DE", 3, "UTC")


def test_staged_scope_deletes_its_tables(spark, production):
    with staging.staged_scope(spark):
        inner = stage(production).inputFiles()[0].removeprefix("file://")
        assert os.path.exists(inner)
    assert not os.path.exists(inner)


def test_partitioned_write(spark, tmp_path, production):
    tables.write_tables(
        {"production_records": production},
        str(tmp_path),
        fmt="parquet",
        suffix="_clean",
        partition_by={"production_records": ["date"]},
    )
    back = spark.read.parquet(str(tmp_path / "production_records_clean.parquet"))
    plan = back.filter("date = date'2024-03-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert back.count() == 3


def test_kpi_sink(spark, tmp_path, production, downtime):
    inspections = spark.createDataFrame(
        [("P1", 10, 1, "I1", "Pass")],
        "factory_id string, sample_size bigint, defective_units bigint, inspection_id string, result string",
    )
    kpis = compute_kpis(
        {
            "production_records": production,
            "downtime_events": downtime,
            "quality_inspections": inspections,
            "defects": spark.createDataFrame([("A",)], "defect_type string"),
        }
    )
    tables.write_kpis(kpis, str(tmp_path))
    assert tables.table_names(spark, str(tmp_path)) == sorted(tables.KPI_TABLES)
    with pytest.raises(ValueError, match="pareto"):
        tables.write_kpis({n: df for n, df in kpis.items() if n != "pareto"}, str(tmp_path))


def test_staging_uses_the_session_folder(spark, production):
    root = staging_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    staged = stage(production)
    assert all(root in f for f in staged.inputFiles())
    assert sorted(staged.collect()) == sorted(production.collect())


def test_staged_tables_can_be_dropped(spark, production, monkeypatch):
    monkeypatch.setattr(staging, "_folder", lambda _: f"{staging_root(spark)}/to-drop")
    path = stage(production).inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    staging.drop_staged(spark)
    assert not os.path.exists(path)


def test_scopes_drop_folders_and_tables(spark, production):
    with staging.staged_scope(spark):
        folder = staging.scratch_folder(spark, "files")
        production.write.csv(folder)
        table, path = staging.scratch_table(spark, "scratch")
        production.write.format("parquet").option("path", path).saveAsTable(table)
        assert spark.table(table).count() == 3
    assert not os.path.exists(folder) and not os.path.exists(path)
    assert not spark.catalog.tableExists(table)


@pytest.mark.parametrize("name", ["csv_round_trip", "kpi_set_published", "surrogate_keys_two_loads"])
def test_queries_leave_nothing_behind(spark, name):
    from tests.conftest import QUERIES, SF

    root = staging._folder(spark)
    before = set(os.listdir(root)) if os.path.exists(root) else set()
    outside = set(os.listdir(staging_root(spark)))
    with staging.staged_scope(spark):
        QUERIES[name](spark, SF).count()
    assert set(os.listdir(root)) == before
    assert set(os.listdir(staging_root(spark))) - {os.path.basename(root)} == outside - {os.path.basename(root)}
