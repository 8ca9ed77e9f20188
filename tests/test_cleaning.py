import datetime as dt

import pytest
from pyspark.sql import functions as F

from millwright.operators import cleaning
from millwright.operators.cleaning import CleanSpec, clean
from millwright.plans.plant import clean_tables
from millwright.settings import Settings
from millwright.sources.tables import INGEST_POSITION, load_tables


def spec(**roles):
    return CleanSpec("gauge_log", **roles)


def test_whole_row_dedupe_needs_equal_rows(dirty):
    assert cleaning.dedupe(dirty).count() == 24
    assert cleaning.dedupe(dirty.unionByName(dirty)).count() == 24


def test_dedupe_keeps_the_first_by_order(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), (None, 5, "p"), (None, 4, "q"), ("b", 1, "z")]
    df = spark.createDataFrame(rows, "k string, seen bigint, v string")
    kept = {(r["k"], r["v"]) for r in cleaning.dedupe(df, ["k"], ["seen"]).collect()}
    assert kept == {("a", "y"), (None, "q"), ("b", "z")}


def test_dedupe_keeps_the_copy_with_a_value(spark):
    rows = [("m", 1, None), ("m", 1, 72.0), ("n", 1, None)]
    df = spark.createDataFrame(rows, "k string, t bigint, reading double")
    assert {tuple(r) for r in cleaning.dedupe(df, ["k"], ["t"]).collect()} == {
        ("m", 1, 72.0), ("n", 1, None),
    }


def test_dedupe_follows_the_file_where_it_is_known(spark, tmp_path):
    text = "machine_id,timestamp,sensor_type,reading_value\n"
    text += "".join(f"m1,2024-03-04T00:00:00,rpm,{v}\n" for v in (9, 4, 7))
    (tmp_path / "sensor_readings.csv").write_text(text)
    table = load_tables(spark, str(tmp_path), position=True)["sensor_readings"]
    cleaned, report = clean(table, cleaning.FACT_SPECS["sensor_readings"])
    assert [r["reading_value"] for r in cleaned.collect()] == [9.0]
    assert (report.rows_before, report.rows_deduped) == (3, 1)
    assert INGEST_POSITION not in cleaned.columns


def test_date_formats_come_from_the_settings(spark):
    df = spark.createDataFrame([("04/03/2024",)], "seen string")
    settings = Settings.from_config({"data_quality": {"date_formats": {"seen": "dd/MM/yyyy"}}})
    cleaned = clean(df, spec(date_cols=["seen"]), settings)[0]
    assert cleaned.first()["seen"] == dt.datetime(2024, 3, 4)


def test_dedupe_ignores_absent_keys(spark, production):
    doubled = production.unionByName(production.limit(1))
    kept, report = clean(doubled, CleanSpec("production", numeric_cols=["total_units_produced"]))
    assert kept.count() == 3
    counts = {(r["metric"], r["column_name"]): r["value"] for r in report.metrics().collect()}
    assert counts["duplicates_removed", ""] == 1
    without_shift = doubled.drop("shift_id", "line_id")
    assert clean(without_shift, CleanSpec("production"))[0].count() == 2


def test_median_fill_and_sentinel(dirty):
    cleaned, report = clean(dirty, spec(numeric_cols=["value"]))
    row = cleaned.filter("id = 22").first()
    assert (row["value"], row["category"]) == (100.0, "UNKNOWN")
    assert report.filled == {"value": 1, "category": 1}


def test_outliers_after_fill(dirty):
    cleaned, report = clean(dirty, spec(numeric_cols=["value"], outlier_cols=["value"]))
    assert cleaned.count() == 24
    assert [r["value"] for r in cleaned.filter("value_is_outlier").collect()] == [160.0, 160.0]
    stats = cleaned.agg(F.avg("value"), F.stddev_pop("value")).first()
    assert tuple(stats) == pytest.approx((105.000000, 16.673332), abs=1e-6)
    assert "2 outliers" in report.summary()
    keyed = clean(
        dirty, spec(numeric_cols=["value"], outlier_cols=["value"]), Settings(dedupe_keys={"gauge_log": ("id",)})
    )[0]
    assert keyed.count() == 23
    assert keyed.filter("value_is_outlier").count() == 1


def test_constant_and_empty_columns_have_no_outliers(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None)], "a double, b double")
    flagged = cleaning.flag_outliers(df, ["a", "b", "absent"])
    assert flagged.columns == ["a", "b", "a_is_outlier", "b_is_outlier"]
    assert flagged.filter("a_is_outlier or b_is_outlier").count() == 0


def test_threshold_is_strict(spark):
    # Population deviation 1, mean 0: the values are exactly one deviation away.
    df = spark.createDataFrame([(1.0,), (-1.0,)], "a double")
    assert cleaning.flag_outliers(df, ["a"], 1.0).filter("a_is_outlier").count() == 0
    assert cleaning.flag_outliers(df, ["a"], 0.99).filter("a_is_outlier").count() == 2


def test_coercion(spark):
    df = spark.createDataFrame([("4",), ("9",), ("some",)], "amount string")
    cleaned, report = clean(df, spec(numeric_cols=["amount"]))
    assert sorted(r["amount"] for r in cleaned.collect()) == [4.0, 6.5, 9.0]
    assert report.conversions == {"amount": "numeric"}


def test_coercion_of_dates(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("soon",)], "t string")
    got = [r["t"] for r in cleaning.coerce_types(df, date_cols=["t", "absent"]).collect()]
    assert got == [dt.datetime(2024, 1, 5, 10), None]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    cleaned, report = clean(df, spec(numeric_cols=["x"]))
    assert report.filled == {"x": 1}
    assert sorted(r["x"] for r in cleaned.collect()) == [1.0, 2.0, 3.0]


def test_whole_numbers_with_gaps_take_a_fractional_median(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "units bigint")
    cleaned = clean(df, spec(numeric_cols=["units"]))[0]
    assert sorted(r["units"] for r in cleaned.collect()) == [1.0, 1.5, 2.0]
    full = clean(df.dropna(), spec(numeric_cols=["units"]))[0]
    assert dict(full.dtypes)["units"] == "bigint"


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id bigint, x double")
    cleaned, report = clean(df, spec(numeric_cols=["x"]))
    assert cleaned.filter("x is null").count() == 2
    assert report.filled == {"x": 2}


def test_mean_strategy(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,), (None,)], "x double")
    cleaned = clean(df, spec(numeric_cols=["x"]), Settings(missing_value_strategy="mean"))[0]
    assert sorted(r["x"] for r in cleaned.collect()) == [1.0, 2.0, 3.0, 6.0]


def test_ffill_strategy(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 7.0), (5, None)], "t bigint, x double")
    settings = Settings(missing_value_strategy="ffill")
    cleaned = clean(df, spec(numeric_cols=["x"], order_by=["t"]), settings)[0]
    assert [r["x"] for r in cleaned.orderBy("t").collect()] == [5.0, 5.0, 5.0, 7.0, 7.0]
    with pytest.raises(ValueError, match="order_by"):
        clean(df, spec(numeric_cols=["x"]), settings)


def test_ffill_of_sensor_readings_stays_with_the_sensor(spark):
    rows = [("m1", 1, 1.0), ("m2", 2, 8.0), ("m1", 3, None), ("m2", 4, None), ("m3", 5, None)]
    df = spark.createDataFrame(rows, "machine_id string, t int, reading_value double").selectExpr(
        "machine_id",
        "make_timestamp_ntz(2024, 1, 1, t, 0, 0) AS timestamp",
        "'rpm' AS sensor_type",
        "reading_value",
    )
    settings = Settings(missing_value_strategy="ffill")
    cleaned = clean(df, cleaning.FACT_SPECS["sensor_readings"], settings)[0]
    assert [r["reading_value"] for r in cleaned.orderBy("timestamp").collect()] == [
        1.0, 8.0, 1.0, 8.0, None,
    ]


def test_drop_strategy_counts_in_turn(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (None, 2.0), (3.0, 4.0)], "a double, b double")
    settings = Settings(missing_value_strategy="drop")
    cleaned, report = clean(df, spec(numeric_cols=["a", "b"]), settings)
    assert [tuple(r) for r in cleaned.collect()] == [(3.0, 4.0)]
    assert report.filled == {"a": 2, "b": 1}


def test_unknown_strategy_is_refused():
    with pytest.raises(ValueError, match="missing_value_strategy"):
        Settings(missing_value_strategy="guess")


def test_sentinel_skips_categories(spark):
    df = spark.createDataFrame([(None, None, None)], "reason_code string, operator_id string, n bigint")
    row = cleaning.fill_sentinel(df, category_cols=["reason_code"]).first()
    assert tuple(row) == (None, "UNKNOWN", None)


def test_clamp(spark):
    df = spark.createDataFrame([(1, 7), (2, -3), (3, 0), (4, -12)], "id bigint, units bigint")
    cleaned = clean(df, spec(numeric_cols=["units"], non_negative_cols=["units"]))[0]
    assert [r["units"] for r in cleaned.orderBy("id").collect()] == [7, 0, 0, 0]


def test_observed_counts_come_with_the_write(dirty):
    _, report = clean(dirty, spec(numeric_cols=["value"], outlier_cols=["value"]))
    df, observation = report.observed()
    df.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows_after": 24, "value_is_outlier": 2}


def test_clean_tables_passes_dimensions_through(spark, production):
    factories = spark.createDataFrame([("P1", None)], "factory_id string, country string")
    cleaned, reports = clean_tables({"production_records": production, "factories": factories})
    assert cleaned["factories"] is factories
    assert list(reports) == ["production_records"]
    assert cleaned["production_records"].count() == 3


def test_settings_from_config():
    settings = Settings.from_config(
        {
            "data_quality": {
                "outlier_z_threshold": 2.5,
                "missing_value_strategy": "mean",
                "duplicate_subset_keys": {"sensor": ["machine_id"]},
            },
            "kpi_targets": {"oee_target": 0.6, "scrap_rate_max": 0.05},
        }
    )
    assert settings.outlier_z_threshold == 2.5
    assert settings.dedupe_keys == {"sensor": ("machine_id",)}
    assert (settings.targets["oee"], settings.targets["scrap_rate"]) == (0.6, 0.05)
    assert settings.targets["quality"] == 0.98
