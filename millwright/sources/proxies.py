"""Plant tables derived from the sample star schema.

The sample tables hold no nulls, zeros or negatives, so these are put in by fixed predicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production records from order lines; the supplier is the machine, its nation the factory."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    idle = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
    minutes = F.col("l_quantity") * 10.0
    total = minutes.cast("bigint")
    good = F.floor(minutes * (1.0 - F.col("l_tax"))).cast("bigint")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(_suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_suppkey").alias("machine_id"),
            F.col("s_nationkey").alias("factory_id"),
            (F.col("l_linenumber") % 3).alias("shift_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.when(idle, 0.0).otherwise(minutes).alias("planned_production_time_minutes"),
            F.when(idle, 0.0)
            .otherwise(minutes * (1.0 - F.col("l_discount")))
            .alias("run_time_minutes"),
            F.when(F.col("l_partkey") % 97 == 0, F.lit(None).cast("double"))
            .when(F.col("l_partkey") % 89 == 0, -5.0)
            .otherwise(minutes * F.col("l_discount"))
            .alias("downtime_minutes"),
            (20.0 + 1.4 * F.col("p_size")).alias("ideal_cycle_time_seconds"),
            total.alias("total_units_produced"),
            good.alias("good_units"),
            (total - good).alias("scrap_units"),
        )
    )


def downtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stoppages from events. Some machines have none, some stoppages no known machine."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") + 50).alias("machine_id"),
        F.when(event % 50 != 0, F.col("event_type")).alias("reason_code"),
        F.col("value").alias("duration_minutes"),
        F.when(event % 101 != 0, event % 5 == 0).alias("is_planned"),
        F.col("ts").alias("start_time"),
    )


def inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    defective = F.floor(F.col("l_quantity") * F.col("l_tax")).cast("bigint")
    return lines.join(
        _suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")
    ).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("inspection_id"),
        F.col("s_nationkey").alias("factory_id"),
        F.col("l_quantity").cast("bigint").alias("sample_size"),
        defective.alias("defective_units"),
        F.when(defective == 0, "Pass").otherwise("Fail").alias("result"),
    )


def defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("defect_id"),
            F.when(F.col("l_orderkey") % 50 != 0, F.col("p_brand")).alias("defect_type"),
        )
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("machine_id"),
        F.col("event_type").alias("sensor_type"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 199 != 0, F.col("value")).alias("reading_value"),
    )


def repeated_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of which every seventh was sent again, without its value."""
    once = sensors(spark, sf_dir)
    again = once.filter(F.col("event_id") % 7 == 0)
    return once.unionByName(again.withColumn("reading_value", F.lit(None).cast("double")))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a text export: numbers and times as text, some of them unreadable."""
    event = F.col("event_id")
    value = F.col("value").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(event % 97 == 0, "not_a_number")
        .when(event % 89 == 0, F.concat(F.lit("  "), value, F.lit(" ")))
        .otherwise(value)
        .alias("reading_text"),
        F.when(event % 83 == 0, "some day")
        .otherwise(F.col("ts").cast("string"))
        .alias("time_text"),
        "event_type",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("operator_id"),
    )


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("machine_id"),
        F.col("s_nationkey").alias("factory_id"),
        F.col("s_name").alias("machine_name"),
    )
