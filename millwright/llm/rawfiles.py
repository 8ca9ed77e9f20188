"""Files of raw bytes, written and read by Spark itself.

Spark's text writer puts out the bytes of a value as they are and a separator after each. With
a zero byte as separator, a format whose entries end in a zero byte is written exactly: entries
are handed over without their last byte. So files go to any storage Spark can reach, and its
commit protocol keeps the parts of failed tasks out.

Spark's readers hand over files whole; ``open_file`` opens one in a task for reading at any place,
where pyarrow has a client for its file system (mounted folders, S3, GCS, Azure, HDFS).
"""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.sources.staging import scratch_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the staging folder, deleted with what is staged."""
    return scratch_folder(spark, name)


def write_raw(entries: DataFrame, column: str, folder: str, *, per_file: int = 0) -> None:
    """Write binary entries that end in a zero byte, one after the other, in row order.

    Every task writes a file of its own, or several with at most ``per_file`` entries.
    """
    body = F.expr(f"substring({column}, 1, length({column}) - 1)").cast("string")
    entries.select(body.alias("value")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", per_file
    ).text(folder)


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``content`` of every file of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` of every file of a folder; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path")


def open_file(path: str) -> pa.NativeFile:
    """A file that Spark named, open for reading at any place."""
    if path.startswith("file:"):  # Spark leaves its paths unquoted
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def can_seek(folder: str) -> bool:
    """Whether ``open_file`` has a client for the folder's file system."""
    if folder.startswith("file:"):
        return True
    try:
        system, inner = fs.FileSystem.from_uri(folder)
        return system.get_file_info(inner).type == fs.FileType.Directory
    except (OSError, ValueError, NotImplementedError):
        return False
