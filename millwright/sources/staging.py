"""Write an intermediate result once, to storage every executor can read.

Operators that read a costly result several times (deduplicated rows, a cluster-wide sort)
stage it as Parquet below the session's checkpoint directory. A staged table survives the
loss of executors, keeps its row layout between reads and still prunes columns.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_COLUMN = "_staged_file"
ROW_COLUMN = "_staged_row"

# Folders made for sessions in local mode that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}
# Paths staged within each open scope, the innermost last.
_SCOPES: list[list[str]] = []
# Catalog tables over staged files, by the folder of their files.
_TABLES: dict[str, str] = {}


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def local_mode_folder(spark: SparkSession) -> str:
    """A temporary folder for a session in local mode, where driver and executors are one."""
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="millwright-")
        warnings.warn(
            f"spark.checkpoint.dir is not set; staging in {_LOCAL_FOLDERS[application]}",
            stacklevel=3,
        )
    return _LOCAL_FOLDERS[application]


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` or the context's checkpoint dir.

    With neither set, local mode has a folder of its own and a cluster is refused. The
    settings of the session are not changed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if _is_local(spark):
            return local_mode_folder(spark)
        raise RuntimeError(
            "Set spark.checkpoint.dir to a folder all executors share; "
            "intermediate tables are staged there."
        )
    if root.startswith(("file:", "/")) and not _is_local(spark):
        warnings.warn(f"{root} must be a mount that all executors share", stacklevel=3)
    return root


def _folder(spark: SparkSession) -> str:
    return f"{staging_root(spark).rstrip('/')}/millwright-{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the staging folder, deleted with what is staged."""
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _SCOPES[-1:]:
        scope.append(path)
    return path


def scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A new catalog table's name and the folder for its files; dropped with what is staged."""
    path = scratch_folder(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    _TABLES[path] = table
    return table, path


def stage(df: DataFrame, *, row_ids: bool = False) -> DataFrame:
    """Write ``df`` to the staging folder and return a scan of it.

    With ``row_ids``, two more columns name the file and the row within it: together a
    unique, repeatable address of each staged row.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, "table")
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    if row_ids:
        staged = staged.select(
            "*",
            F.col("_metadata.file_name").alias(FILE_COLUMN),
            F.col("_metadata.row_index").alias(ROW_COLUMN),
        )
    return staged


def _delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder, after the catalog tables whose files it holds."""
    for path in [p for p in _TABLES if p == folder or p.startswith(f"{folder}/")]:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop(path)}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staged_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is staged within; results must have been written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            _delete(spark, path)


def drop_staged(spark: SparkSession) -> None:
    """Delete all tables this application has staged, once the results built on them are written."""
    _delete(spark, _folder(spark))
