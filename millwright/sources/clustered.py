"""Tables whose files hold ranges of their order, so that a reader opens only files it needs.

The rows are range-sorted by the leading columns and written with a small *file index*: per file its
first and last key, the bounds of the leading column, and how many rows it has. The last rows of
the table, or those of a range of keys, are then found by looking at the index alone; all other
files are not even listed in the plan. Within a file Parquet's own row group bounds and, for columns
named as such, Bloom filters prune further. Table and index are published as one set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millwright.sources.publishing import TableSet, publish_tables, published_set, read_table_of

ROWS, INDEX = "rows", "file_index"
FILE = "file"


def write_clustered(
    df: DataFrame, directory: str, by: Sequence[str], *, files: int, bloom: Sequence[str] = ()
) -> TableSet:
    """Write ``df`` range-sorted by ``by`` (nulls first) into about ``files`` files, with an index.

    ``bloom`` names columns that are looked up by value without being in the order. A value of
    ``by`` that more than a file's share of the rows have is one file's.
    """
    by = list(by)
    ordered = df.repartitionByRange(files, *by).sortWithinPartitions(*by)
    options = {}
    for c in bloom:
        options[f"parquet.bloom.filter.enabled#{c}"] = "true"

    def index(written: TableSet) -> dict[str, DataFrame]:
        rows = read_table_of(df.sparkSession, written, ROWS)
        key = F.struct(*by)
        held = rows.select(*by, F.col("_metadata.file_name").alias(FILE)).groupBy(FILE)
        return {
            INDEX: held.agg(
                F.min(key).alias("first_key"),
                F.max(key).alias("last_key"),
                F.min(by[0]).alias("low"),
                F.max(by[0]).alias("high"),
                F.count_if(F.col(by[0]).isNull()).alias("nulls"),
                F.count(F.lit(1)).alias("rows"),
            ).coalesce(1)
        }

    return publish_tables({ROWS: ordered}, directory, options=options, derive=index)


def _current(spark: SparkSession, directory: str) -> TableSet:
    current = published_set(spark, directory)
    if current is None or INDEX not in current.tables:
        raise ValueError(f"{directory} holds no clustered table")
    return current


def file_index(spark: SparkSession, directory: str) -> DataFrame:
    """One row per file of a clustered table."""
    return read_table_of(spark, _current(spark, directory), INDEX)


def _of_files(spark: SparkSession, current: TableSet, chosen: DataFrame) -> DataFrame:
    """The rows of the chosen files: their names, a small part of one row per file, are collected."""
    held = current.tables[ROWS]
    names = [row[FILE] for row in chosen.select(FILE).collect()]
    if not names:
        return spark.createDataFrame([], held["columns"])
    folder = f"{current.folder}/{held['path']}"
    return spark.read.schema(held["columns"]).parquet(*[f"{folder}/{n}" for n in names])


def read_range(
    spark: SparkSession, directory: str, column: str, low: object = None, high: object = None
) -> DataFrame:
    """The rows whose leading column lies between two values, both included; None is no bound."""
    current = _current(spark, directory)
    index = read_table_of(spark, current, INDEX)
    bounds: list[tuple[Column, Column]] = []
    if low is not None:
        bounds.append((F.col("high") >= F.lit(low), F.col(column) >= F.lit(low)))
    if high is not None:
        bounds.append((F.col("low") <= F.lit(high), F.col(column) <= F.lit(high)))
    for of_file, _ in bounds:
        index = index.filter(of_file)
    rows = _of_files(spark, current, index)
    for _, of_row in bounds:
        rows = rows.filter(of_row)
    return rows


def last_files(index: DataFrame, n: int) -> DataFrame:
    """The files at the end of the order that together hold at least ``n`` rows."""
    # One row per file, so that one task can order them all.
    after = Window.orderBy(F.col("last_key").desc(), F.col("first_key").desc())
    behind = F.coalesce(F.sum("rows").over(after.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return index.withColumn("behind", behind).filter(F.col("behind") < F.lit(n))


def read_last(spark: SparkSession, directory: str, n: int) -> DataFrame:
    """The rows of the last files: among them are the last ``n`` of the table."""
    current = _current(spark, directory)
    return _of_files(spark, current, last_files(read_table_of(spark, current, INDEX), n))
