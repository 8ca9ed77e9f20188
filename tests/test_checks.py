import pytest
from pyspark.sql import functions as F

from millwright.operators import checks


@pytest.fixture
def gaps(spark):
    rows = [(float(i) if i else None, float(i) if i < 4 else None) for i in range(8)]
    return spark.createDataFrame(rows, "level double, flow double")


def test_null_profile(gaps):
    report = checks.validate_data_quality(gaps, "t", max_null_pct=30.0)
    assert report["row_count"] == 8
    assert report["null_by_column"] == {"level": 12.5, "flow": 50.0}
    assert len(report["warnings"]) == 1
    assert "flow" in report["warnings"][0]
    assert report["errors"] == []


def test_null_threshold_is_strict(gaps):
    rows = checks.null_profile(gaps, "t", max_null_pct=12.5).collect()
    assert {r["column_name"]: r["too_many_nulls"] for r in rows} == {"level": False, "flow": True}


def test_too_few_rows(gaps):
    report = checks.validate_data_quality(gaps, "t", min_rows=9)
    assert len(report["errors"]) == 1
    assert "rows" in report["errors"][0]


def test_null_profile_of_an_empty_table(gaps):
    rows = checks.null_profile(gaps.limit(0), "t").collect()
    assert [(r["row_count"], r["null_pct"], r["too_many_nulls"]) for r in rows] == [(0, None, False)] * 2


def test_null_profile_without_columns(spark):
    nothing = spark.range(3).select()
    assert checks.null_profile(nothing, "t").count() == 0
    assert checks.validate_data_quality(nothing, "t")["row_count"] == 3


@pytest.mark.parametrize(
    ("actual", "expected", "fits"),
    [
        ("bigint", "int64", True), ("bigint", "int", True), ("double", "float64", True),
        ("timestamp_ntz", "datetime64[ns]", True), ("interval", "int", False),
        ("int", "int64", False), ("string", "object", True), ("bigint", "bigint", True),
    ],
)
def test_dtype_names(actual, expected, fits):
    assert checks._dtype_matches(actual, expected) == fits


def test_schema_messages(spark):
    df = spark.createDataFrame([(1, 1.0, "A")], "id bigint, value double, category string")
    dtypes = {"id": "int", "value": "float", "category": "object"}
    assert checks.validate_schema(df, "t", ["id", "value"], dtypes) == []
    errors = checks.validate_schema(df, "t", ["id", "weight"], {"value": "int", "weight": "int"})
    assert len(errors) == 2
    assert any("weight" in e for e in errors)
    assert "empty" in checks.validate_schema(df.limit(0), "t")[0]
    assert checks.has_columns(df, ["id"])
    assert not checks.has_columns(df, ["id", "weight"])


def test_schema_report(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "n string")
    rows = checks.schema_report(df, "t", ["n", "m"], {"n": "float"}, {"n": "double"}).collect()
    assert {(r["check_name"], r["column_name"]): r["violations"] for r in rows} == {
        ("not_empty", ""): 0,
        ("required", "n"): 0,
        ("required", "m"): 1,
        ("dtype", "n"): 1,
        ("castable", "n"): 1,
    }


def test_rules(spark):
    df = spark.createDataFrame([(1, 2), (5, 2), (None, 2)], "a bigint, b bigint")
    rows = checks.rule_violations(df, {"a_at_most_b": F.col("a") <= F.col("b"), "b_is_two": F.col("b") == 2})
    assert {r["rule_name"]: (r["rows_checked"], r["violations"]) for r in rows.collect()} == {
        "a_at_most_b": (3, 1),
        "b_is_two": (3, 0),
    }


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    assert [tuple(r) for r in checks.orphans(child, parent, "k", "id").collect()] == [("z", 2)]
    assert checks.orphan_rows(child, parent, "k", "id").count() == 2


def test_reconcile(production, downtime):
    rows = {r["record_id"]: r for r in checks.reconcile_downtime(production, downtime).collect()}
    assert {k: r["difference_minutes"] for k, r in rows.items()} == {"R1": 0.0, "R2": 0.0, "R3": 0.0}
    twice = production.unionByName(production.filter("record_id = 'R1'"))
    row = checks.reconcile_downtime(twice, downtime).filter("record_id = 'R1'").first()
    assert (row["record_rows"], row["recorded_minutes"], row["difference_minutes"]) == (2, 80.0, -40.0)
