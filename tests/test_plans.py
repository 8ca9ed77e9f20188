"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from millwright.catalog.queries import QUERIES
from millwright.sources import proxies as P
from millwright.sources.staging import stage
from tests.conftest import SF


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", params=sorted(QUERIES))
def planned(request, queried):
    plan = plan_of(queried(request.param))
    return request.param, plan.split("== Initial Plan ==")[0]


def test_no_python_and_no_cross_join(planned):
    name, plan = planned
    assert not re.search(r"Python|ArrowEval|MapInPandas", plan), name
    assert "CartesianProduct" not in plan, name
    assert "BroadcastNestedLoopJoin" not in plan, name


def one_task_exchanges(plan):
    """What lies below and above each exchange into a single task, and the scan it reads."""
    lines = [line.lstrip(" :+-*0123456789()") for line in plan.splitlines()]
    for i, line in enumerate(lines):
        if line.startswith("Exchange SinglePartition"):
            scan = next((x for x in lines[i:] if x.startswith("FileScan")), "")
            yield lines[i + 1], lines[i - 1], scan


def gathers_reduced_rows(below, above):
    partial = below.startswith(("HashAggregate", "SortAggregate", "ObjectHashAggregate"))
    global_sum = partial and ("keys=[]" in below or "_chunk" in below or "Sort" in above)
    top_k = below.startswith(("LocalLimit", "GlobalLimit", "TakeOrdered"))
    chunk_sums = below.startswith("Project") and "_chunk" in below
    return global_sum or top_k or chunk_sums


def test_single_partition_only_gathers_reduced_rows(planned):
    """One-task exchanges feed final aggregates, top-k results and windows over chunk sums."""
    name, plan = planned
    for below, above, _ in one_task_exchanges(plan):
        assert gathers_reduced_rows(below, above), (name, above, below)


def test_cleaning_report_reads_no_source_table(queried):
    assert "/testdata/" not in plan_of(queried("cleaning_report"))


def test_scan_reads_needed_columns_only(spark):
    plan = plan_of(QUERIES["fk_orphans"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(schemas) == ["s_suppkey:bigint", "user_id:bigint"]


def test_filter_reaches_the_scan(spark):
    defects = P.defects(spark, SF)
    assert "EqualTo(l_returnflag,R)" in plan_of(defects)


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    plan = plan_of(QUERIES["clean_dedupe"](spark, SF))
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning(l_orderkey") < partial


def test_rollup_is_one_shuffle(spark):
    plan = plan_of(QUERIES["kpi_by_factory"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1


def test_all_grains_are_one_pass_and_one_shuffle(spark):
    plan = plan_of(QUERIES["kpi_all_grains"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("lineitem.parquet") == 1
    # Printed top down: the records are expanded below the partial sums, above the joins.
    assert plan.index("partial_sum") < plan.index("Expand") < plan.index("BroadcastHashJoin")


def test_statistics_are_computed_once(spark):
    df = QUERIES["clean_outliers"](spark, SF)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("ReusedSubquery") >= 1


def test_staged_tables_are_pruned(spark):
    staged = stage(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert "ReadSchema: struct<twice:bigint>" in plan_of(staged.select("twice"))


def test_tables_are_made_when_asked_for(spark, monkeypatch):
    """The Pareto table of defects needs neither production records nor their cleaning."""
    from millwright.plans import plant

    cleaned = []
    plain = plant.clean
    monkeypatch.setattr(plant, "clean", lambda df, spec, s: cleaned.append(spec.table) or plain(df, spec, s))
    defects = spark.createDataFrame([("D1", "A"), ("D2", "A"), ("D3", "B")], "defect_id string, defect_type string")
    lost = spark.range(1).select(F.raise_error(F.lit("read")).alias("record_id"))
    tables, reports = plant.clean_tables({"production_records": lost, "defects": defects, "machines": lost})
    kpis = plant.compute_kpis(tables)
    assert list(kpis) == list(plant.compute_kpis({})) and len(reports) == 2
    assert [r["count"] for r in kpis["pareto"].collect()] == [2, 1]
    assert kpis["pareto"] is kpis["pareto"]
    assert len(cleaned) == 1
    assert reports["defects"].rows_before == 3
    assert len(cleaned) == 1
