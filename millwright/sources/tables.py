"""Table sets: one dataset per table in a directory."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millwright.functions.expressions import to_number, to_timestamp, without_nan
from millwright.schemas import table_schemas
from millwright.sources.publishing import (
    TableSet,
    publish_tables,
    published_set,
    read_table_of,
)

# Where a row stood in its file; load_tables() adds it on request, cleaning takes it off.
INGEST_POSITION = "_ingest_position"
# Quotes inside a quoted field are doubled; a field may hold separators and backslashes.
_DIALECT = {"header": True, "quote": '"', "escape": '"'}
# An empty text is written in quotes, so that it differs from null in the file.
_WRITING = {**_DIALECT, "emptyValue": '""', "nullValue": ""}

# Texts that stand for a missing value in CSV files.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The names of the KPI result set.
KPI_TABLES = (
    "production_with_kpis",
    "monthly_kpis",
    "factory_kpis",
    "machine_kpis",
    "shift_kpis",
    "mtbf_mttr_machine",
    "defect_rate_factory",
    "pareto",
)


def _read_as(column: str, name: str) -> Column:
    value = F.col(column)
    text = F.when(~value.isin(*NULL_TEXTS), value)
    if name == "string":
        return text
    if name == "double":
        return to_number(text)
    if name == "timestamp_ntz":
        return to_timestamp(text)
    if name == "bigint":
        # A column with gaps is often written as "12.0": still a whole number.
        number = to_number(text)
        whole = F.when(number == F.floor(number), number.try_cast("bigint"))
        return F.coalesce(text.try_cast("bigint"), whole)
    return text.try_cast(name)


def table_names(spark: SparkSession, directory: str, fmt: str = "csv") -> list[str]:
    """Names of the tables in a directory: those of its published set, if it has one, or else
    every ``<name>.<fmt>`` file or dataset folder."""
    current = published_set(spark, directory)
    if current is not None:
        return sorted(current.tables)
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    found = (status.getPath().getName() for status in files)
    return sorted(n.removesuffix(f".{fmt}") for n in found if n.endswith(f".{fmt}"))


def _with_position(df: DataFrame, row: Column) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return df.select("*", F.struct(*place, row.alias("row")).alias(INGEST_POSITION))


def _inferred(value: Column, column: str) -> list[Column]:
    """Whether all values of a text column read as a whole number, a number, a time."""
    known = F.when(~value.isin(*NULL_TEXTS), value)
    kinds = ("bigint", "double", "boolean")
    return [
        F.every(known.isNull() | known.try_cast(k).isNotNull()).alias(f"{column} {k}") for k in kinds
    ]


def infer_kinds(raw: DataFrame) -> dict[str, str]:
    """Types for text columns, from one pass over all their values; text where none fits."""
    if not raw.columns:
        return {}
    fits = raw.agg(*[c for name in raw.columns for c in _inferred(F.col(name), name)]).first()
    order = ("bigint", "double", "boolean")
    return {
        name: next((k for k in order if fits[f"{name} {k}"]), "string")
        for name in raw.columns
    }


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    multi_line: bool = False,
    infer: bool = False,
    position: bool = False,
) -> DataFrame:
    """One CSV table with header. Values are read as text, then converted by ``schema``,
    so that any of the usual null texts and any unreadable value become null.

    Columns the schema does not know stay text, unless ``infer`` is set; columns the file lacks
    stay absent. Fields may hold line breaks only with ``multi_line``, which reads each file in
    one task. A row with too few or too many fields is an error when it is read, not shifted.
    """
    head = spark.read.options(**_DIALECT).option("multiLine", multi_line).csv(path)
    text = StructType([*[StructField(c, StringType()) for c in head.columns]])
    reader = spark.read.options(**_DIALECT).option("multiLine", multi_line)
    raw = reader.option("mode", "FAILFAST").schema(text).csv(path)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields} if schema is not None else {}
    if infer:
        unknown = [c for c in raw.columns if c not in kinds]
        kinds |= infer_kinds(raw.select(*unknown))
    if position:
        raw = _with_position(raw, F.monotonically_increasing_id())
    kept = [INGEST_POSITION] if position else []
    return raw.select(
        *[_read_as(c, kinds.get(c, "string")).alias(c) for c in text.names], *kept
    )


def load_tables(
    spark: SparkSession,
    directory: str,
    schemas: Mapping[str, StructType] | None = None,
    *,
    fmt: str = "csv",
    names: Iterable[str] | None = None,
    multi_line: bool = False,
    infer: bool = False,
    position: bool = False,
) -> dict[str, DataFrame]:
    """Table name to lazy DataFrame for ``<directory>/<name>.<fmt>``.

    ``names`` defaults to all tables found. CSV tables take their types from ``schemas``
    (default: the ten plant tables), see :func:`read_csv_table` for the options; other formats
    carry their own. ``position`` adds where each row stood in its file, so that duplicates
    can be told apart by file order.

    Of a directory with a published set all tables come from that set, in the format and with the
    columns that they were published with.
    """
    current = published_set(spark, directory)
    if current is not None:
        return _load_set(spark, current, names, position)
    base = directory.rstrip("/")
    known = table_schemas() if schemas is None else schemas
    tables = {}
    for name in names or table_names(spark, base, fmt):
        path = f"{base}/{name}.{fmt}"
        if fmt == "csv":
            tables[name] = read_csv_table(
                spark, path, known.get(name), multi_line=multi_line, infer=infer, position=position
            )
        else:
            df = spark.read.format(fmt).load(path)
            if position:
                columns = df.columns
                df = _with_position(df, F.col("_metadata.row_index")).select(*columns, INGEST_POSITION)
            tables[name] = without_nan(df)
    return tables


def _load_set(
    spark: SparkSession, current: TableSet, names: Iterable[str] | None, position: bool
) -> dict[str, DataFrame]:
    tables = {}
    for name in names or sorted(current.tables):
        df = read_table_of(spark, current, name)
        if position:
            row = F.col("_metadata.row_index") if current.tables[name]["format"] == "parquet" else (
                F.monotonically_increasing_id()
            )
            columns = df.columns
            df = _with_position(df, row).select(*columns, INGEST_POSITION)
        tables[name] = without_nan(df)
    return tables


def write_tables(
    tables: Mapping[str, DataFrame],
    directory: str,
    *,
    fmt: str = "csv",
    suffix: str = "",
    partition_by: Mapping[str, list[str]] | None = None,
) -> None:
    """One dataset per table, ``<directory>/<name><suffix>.<fmt>``, overwritten one by one.

    For readers that know nothing of published sets; :func:`publish_set` swaps all at once.
    """
    base = directory.rstrip("/")
    for name, df in tables.items():
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.options(**_WRITING)
        if partition_by and name in partition_by:
            writer = writer.partitionBy(*partition_by[name])
        writer.save(f"{base}/{name}{suffix}.{fmt}")


def publish_set(
    tables: Mapping[str, DataFrame],
    directory: str,
    *,
    fmt: str = "csv",
    partition_by: Mapping[str, list[str]] | None = None,
    made_from: int | None = None,
) -> TableSet:
    """All tables as the directory's next set, in one step; :func:`load_tables` follows it.

    Should anything fail on the way, readers keep the set before.
    """
    options = {k: str(v) for k, v in _WRITING.items()} if fmt == "csv" else {}
    return publish_tables(
        tables, directory, fmt=fmt, options=options, partition_by=partition_by, made_from=made_from
    )


def write_kpis(
    kpis: Mapping[str, DataFrame], directory: str, *, fmt: str = "csv", made_from: int | None = None
) -> TableSet:
    """The KPI result set under its fixed table names, published as one."""
    missing = [n for n in KPI_TABLES if n not in kpis]
    if missing:
        raise ValueError(f"KPI tables not computed: {', '.join(missing)}")
    return publish_set(
        {n: kpis[n] for n in KPI_TABLES}, directory, fmt=fmt, made_from=made_from
    )


def table_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
        for name, df in tables.items()
    ]
    first, *rest = counted
    for other in rest:
        first = first.unionByName(other)
    return first
