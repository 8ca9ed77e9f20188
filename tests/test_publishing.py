"""Sets of tables that change at once or not at all."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from millwright.sources import publishing, tables
from millwright.sources.publishing import (
    PublishConflict,
    publish_tables,
    published_set,
    read_published,
    sweep,
)


def numbers(spark, n):
    return spark.range(n).withColumn("text", F.concat(F.lit("n"), F.col("id")))


def failing(spark):
    return numbers(spark, 100).withColumn(
        "text", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("text"))
    )


def counts(spark, directory, **how):
    return {n: df.count() for n, df in read_published(spark, directory, **how).items()}


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_a_set_comes_back(spark, tmp_path, fmt):
    options = {"header": "true"} if fmt == "csv" else {}
    done = publish_tables({"a": numbers(spark, 5), "b": numbers(spark, 0)}, str(tmp_path), fmt=fmt, options=options)
    assert done.version == 1
    assert {n: t["rows"] for n, t in done.tables.items()} == {"a": 5, "b": 0}
    back = read_published(spark, str(tmp_path))
    assert sorted(back["a"].collect()) == sorted(numbers(spark, 5).collect())
    assert back["a"].dtypes == numbers(spark, 1).dtypes
    assert back["b"].count() == 0


def test_nothing_published(spark, tmp_path):
    assert published_set(spark, str(tmp_path)) is None
    assert published_set(spark, str(tmp_path / "absent")) is None
    with pytest.raises(ValueError, match="no table set"):
        read_published(spark, str(tmp_path))


def test_a_failing_write_leaves_the_set_before(spark, tmp_path):
    """The first new table is written, the second fails: readers see neither."""
    publish_tables({"a": numbers(spark, 5), "b": numbers(spark, 6)}, str(tmp_path))
    reader = read_published(spark, str(tmp_path))
    before = sorted(os.listdir(tmp_path / "_sets"))
    with pytest.raises(Exception, match="lost"):
        publish_tables({"a": numbers(spark, 50), "b": failing(spark)}, str(tmp_path))
    assert counts(spark, str(tmp_path)) == {"a": 5, "b": 6}
    assert reader["a"].count() == 5
    assert sorted(os.listdir(tmp_path / "_sets")) == before


def test_a_reader_stays_on_its_set(spark, tmp_path):
    publish_tables({"a": numbers(spark, 5), "b": numbers(spark, 5)}, str(tmp_path))
    old = read_published(spark, str(tmp_path))
    publish_tables({"a": numbers(spark, 7), "b": numbers(spark, 7)}, str(tmp_path))
    assert {n: df.count() for n, df in old.items()} == {"a": 5, "b": 5}
    assert counts(spark, str(tmp_path)) == {"a": 7, "b": 7}
    assert counts(spark, str(tmp_path), version=1) == {"a": 5, "b": 5}


def test_old_sets_go(spark, tmp_path):
    for n in range(1, 5):
        publish_tables({"a": numbers(spark, n)}, str(tmp_path), keep=2)
    assert counts(spark, str(tmp_path)) == {"a": 4}
    assert counts(spark, str(tmp_path), version=3) == {"a": 3}
    with pytest.raises(ValueError, match="no version 2"):
        read_published(spark, str(tmp_path), version=2)
    assert len(os.listdir(tmp_path / "_sets")) == 3  # two sets and the versions


def test_a_set_made_from_an_old_version_is_refused(spark, tmp_path):
    publish_tables({"a": numbers(spark, 1)}, str(tmp_path), made_from=0)
    publish_tables({"a": numbers(spark, 2)}, str(tmp_path), made_from=1)
    with pytest.raises(PublishConflict, match="version 2 is current"):
        publish_tables({"a": numbers(spark, 3)}, str(tmp_path), made_from=1)
    assert counts(spark, str(tmp_path)) == {"a": 2}


def test_writers_at_once_get_versions_of_their_own(spark, tmp_path):
    done, refused = [], []

    def write(n):
        done.append(publish_tables({"a": numbers(spark, n)}, str(tmp_path), keep=10).version)

    def write_from_start(n):
        try:
            publish_tables({"a": numbers(spark, n)}, str(tmp_path / "from0"), made_from=0)
            done.append("first")
        except PublishConflict:
            refused.append(n)

    for target in (write, write_from_start):
        threads = [threading.Thread(target=target, args=(n,)) for n in range(1, 5)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    assert sorted(map(str, done)) == ["1", "2", "3", "4", "first"]
    assert len(refused) == 3


def test_lost_sets_are_swept(spark, tmp_path):
    publish_tables({"a": numbers(spark, 1)}, str(tmp_path))
    os.makedirs(tmp_path / "_sets" / "lost" / "a.parquet")
    assert sweep(spark, str(tmp_path)) == []
    assert sweep(spark, str(tmp_path), older_than_hours=-1) == ["lost"]
    assert counts(spark, str(tmp_path)) == {"a": 1}


def test_the_manifest_names_what_it_holds(spark, tmp_path):
    publish_tables({"a": numbers(spark, 3)}, str(tmp_path), partition_by={"a": ["text"]})
    (name,) = [n for n in os.listdir(tmp_path / "_sets" / "versions") if n[0].isdigit()]
    held = json.loads((tmp_path / "_sets" / "versions" / name).read_text())
    assert name == f"{1:020d}.json"
    assert held["tables"]["a"]["rows"] == 3
    assert os.path.isdir(tmp_path / "_sets" / held["set"] / "a.parquet" / "text=n1")
    assert read_published(spark, str(tmp_path))["a"].filter("text = 'n1'").count() == 1


def test_load_tables_follows_the_published_set(spark, tmp_path, production):
    kpis = {n: production for n in tables.KPI_TABLES}
    tables.write_kpis(kpis, str(tmp_path))
    smaller = {n: production.limit(1) for n in tables.KPI_TABLES}
    tables.write_kpis(smaller, str(tmp_path))
    assert tables.table_names(spark, str(tmp_path)) == sorted(tables.KPI_TABLES)
    back = tables.load_tables(spark, str(tmp_path), position=True)
    assert {n: df.count() for n, df in back.items()} == dict.fromkeys(tables.KPI_TABLES, 1)
    assert back["pareto"].columns == [*production.columns, tables.INGEST_POSITION]
    with pytest.raises(Exception, match="lost"):
        bad = production.withColumn("record_id", F.raise_error(F.lit("lost")).cast("string"))
        tables.write_kpis({**kpis, "pareto": bad}, str(tmp_path))
    assert tables.load_tables(spark, str(tmp_path), names=["pareto"])["pareto"].count() == 1
    assert publishing.published_set(spark, str(tmp_path)).version == 2
