"""Publish a set of tables at once: readers see all of the new set or all of the old one.

A set is written beside those before it, in a folder of its own, and becomes the current one by a
single step: its manifest is renamed to the next version number, which fails if that number is taken.
Until then nothing a reader looks at has changed, so a job that is lost on the way leaves the old
set as it was. Readers list the manifests, take the highest and find all tables of one set through
it; sets of earlier versions stay for a while, for readers that have begun. A set may also hold
tables of the one before it, which are then named by both manifests and not written again.

The layout below a directory::

    _sets/<id>/<table>.<format>       the tables written with one set
    _sets/versions/<number>.json      what the set holds; twenty digits, ascending

The rename must fail on an existing target and be atomic, as on HDFS and local disks. On an object
store it needs a file system client with conditional writes.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETS = "_sets"
VERSIONS = f"{SETS}/versions"
# Sets kept after a new one is published, itself included.
KEPT_SETS = 2
# Times a publication tries the next version number when others publish meanwhile.
ATTEMPTS = 20


class PublishConflict(RuntimeError):
    """The current version is not the one that the new set was made from."""


class TableSet(NamedTuple):
    """A published set: its version, and per table path, format, columns and row count."""

    version: int
    folder: str
    tables: Mapping[str, Mapping]


class _Files:
    """The file system of a directory, through the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession, directory: str):
        self._jvm = spark._jvm
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        base = self._hadoop.Path(directory)
        self._fs = base.getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(base.toUri(), conf)

    def _path(self, path: str):
        return self._fs.makeQualified(self._hadoop.Path(path))

    def names(self, folder: str) -> dict[str, int]:
        """Entries of a folder and when they were last changed, in milliseconds."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(path)}

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> bool:
        """Whether the file has its new name; no, if the target exists."""
        from py4j.protocol import Py4JJavaError

        options = self._jvm.java.lang.reflect.Array.newInstance(
            self._hadoop.Options.Rename.NONE.getClass(), 0
        )
        try:
            self._context.rename(self._path(source), self._path(target), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def folder_names(spark: SparkSession, directory: str) -> list[str]:
    """Names of what a directory holds; none if it does not exist."""
    return sorted(_Files(spark, directory).names(directory))


def _base(directory: str) -> str:
    return directory.rstrip("/")


def _versions(files: _Files, base: str) -> list[int]:
    names = files.names(f"{base}/{VERSIONS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _manifest_path(base: str, version: int) -> str:
    return f"{base}/{VERSIONS}/{version:020d}.json"


def _read(files: _Files, base: str, version: int) -> TableSet:
    held = json.loads(files.read(_manifest_path(base, version)))
    return TableSet(version, f"{base}/{SETS}", held["tables"])


def _folders(tables: TableSet) -> set[str]:
    """The folders that a set's tables lie in."""
    return {t["path"].split("/")[0] for t in tables.tables.values()}


def published_set(spark: SparkSession, directory: str, version: int | None = None) -> TableSet | None:
    """The current set of a directory (or a kept earlier one); None where none was published."""
    base = _base(directory)
    files = _Files(spark, base)
    versions = _versions(files, base)
    if version is not None and version not in versions:
        raise ValueError(f"{directory} holds no version {version}; kept: {versions}")
    if not versions:
        return None
    return _read(files, base, versions[-1] if version is None else version)


def read_published(
    spark: SparkSession, directory: str, *, version: int | None = None, names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """The tables of one set, with the columns they were published with."""
    current = published_set(spark, directory, version)
    if current is None:
        raise ValueError(f"no table set was published to {directory}")
    return {n: read_table_of(spark, current, n) for n in names or sorted(current.tables)}


def read_table_of(spark: SparkSession, tables: TableSet, name: str) -> DataFrame:
    """One table of a set."""
    if name not in tables.tables:
        raise ValueError(f"version {tables.version} holds no table {name}")
    held = tables.tables[name]
    path = f"{tables.folder}/{held['path']}"
    reader = spark.read.schema(held["columns"]).options(**held["options"])
    return reader.format(held["format"]).load(path)


def publish_tables(
    tables: Mapping[str, DataFrame],
    directory: str,
    *,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    made_from: int | None = None,
    along: TableSet | None = None,
    derive: Callable[[TableSet], Mapping[str, DataFrame]] | None = None,
    keep: int = KEPT_SETS,
) -> TableSet:
    """Write all tables and make them the directory's current set in one step.

    The tables of ``along``, an earlier set of the directory, are part of the new one too, unless
    it brings a table of that name; they must come with ``made_from``. ``derive`` is called with the
    written tables and gives more of them (Parquet), such as an index of their files. Row counts are observed while the tables are written. ``made_from`` names the version that the
    tables were computed from (0: none): should another one be current by then, nothing is
    published and :class:`PublishConflict` is raised. Whatever fails, the current set stays.
    """
    if not tables:
        raise ValueError("a table set needs a table")
    if along is not None and made_from != along.version:
        raise ValueError("tables are taken along from the version that the set is made from")
    base = _base(directory)
    spark = next(iter(tables.values())).sparkSession
    files = _Files(spark, base)
    name = uuid.uuid4().hex
    folder = f"{base}/{SETS}/{name}"
    try:
        held = dict(along.tables) if along is not None else {}
        for table, df in tables.items():
            parts = list((partition_by or {}).get(table, ()))
            held[table] = _written(df, f"{base}/{SETS}", f"{name}/{table}.{fmt}", fmt, options or {}, parts)
        if derive is not None:
            written = TableSet(0, f"{base}/{SETS}", dict(held))
            for table, df in derive(written).items():
                held[table] = _written(df, f"{base}/{SETS}", f"{name}/{table}.parquet", "parquet", {}, [])
        version = _commit(files, base, name, held, made_from)
    except BaseException:
        files.delete(folder)
        raise
    _drop_old(files, base, keep)
    return TableSet(version, f"{base}/{SETS}", held)


def _written(
    df: DataFrame, sets: str, path: str, fmt: str, options: Mapping[str, str], parts: list[str]
) -> dict:
    observation = Observation(f"publication of {path}")
    observed = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.format(fmt).options(**options)
    (writer.partitionBy(*parts) if parts else writer).save(f"{sets}/{path}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return {
        "path": path,
        "format": fmt,
        "options": dict(options),
        "columns": columns,
        "rows": observation.get["rows"],
    }


def _commit(files: _Files, base: str, name: str, held: Mapping, made_from: int | None) -> int:
    """Give the set the next version number; only one writer can have it."""
    draft = f"{base}/{VERSIONS}/draft-{name}"
    files.write(draft, json.dumps({"set": name, "published": time.time(), "tables": held}))
    try:
        for _ in range(ATTEMPTS):
            current = max(_versions(files, base), default=0)
            if made_from is not None and current != made_from:
                raise PublishConflict(f"made from version {made_from}, but version {current} is current")
            if files.rename(draft, _manifest_path(base, current + 1)):
                return current + 1
        raise PublishConflict(f"others published {ATTEMPTS} times meanwhile")
    finally:
        files.delete(draft)


def _drop_old(files: _Files, base: str, keep: int) -> None:
    """Delete all but the newest sets: the manifest first, so that no reader starts on them."""
    versions = _versions(files, base)
    gone, kept = versions[: -max(1, keep)], versions[-max(1, keep) :]
    if not gone:
        return
    old = set().union(*[_folders(_read(files, base, v)) for v in gone])
    for version in gone:
        files.delete(_manifest_path(base, version))
    for folder in old - set().union(*[_folders(_read(files, base, v)) for v in kept]):
        files.delete(f"{base}/{SETS}/{folder}")


def sweep(spark: SparkSession, directory: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete folders of sets that were never published, as lost jobs leave them.

    Only those unchanged for some hours, because a set that is being written has no manifest yet.
    """
    base = _base(directory)
    files = _Files(spark, base)
    before = (time.time() - older_than_hours * 3600) * 1000
    known = set().union(*[_folders(_read(files, base, v)) for v in _versions(files, base)])
    left = [
        n
        for n, changed in files.names(f"{base}/{SETS}").items()
        if n not in known and n != "versions" and changed < before
    ]
    for n in left:
        files.delete(f"{base}/{SETS}/{n}")
    return left
