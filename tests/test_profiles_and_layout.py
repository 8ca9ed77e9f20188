"""Merged profiles against whole ones, and which files a clustered table's readers open."""

import random

import pytest
from pyspark.sql import functions as F

from millwright.operators import checks, profiles, reshape
from millwright.sources import clustered


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(8)
    rows = [
        (
            i,
            rng.choice(["hot", "hot", "a", "b", None]),
            rng.choice([None, float("nan"), *[rng.gauss(50, 20)] * 6]),
            i % 4,
        )
        for i in range(8000)
    ]
    return spark.createDataFrame(rows, "id bigint, kind string, v double, day int").repartition(4).cache()


def by_column(df):
    return {r["column_name"]: r.asDict() for r in df.collect()}


def test_merged_profile_equals_the_whole_one(spark, table):
    parts = profiles.profile_parts(table, by=["day"])
    assert parts.count() == 4 * 3
    merged = by_column(profiles.read_profile(profiles.merge_profiles(parts)))
    whole = by_column(profiles.read_profile(profiles.profile_parts(table.drop("day"))))
    exact = ("row_count", "null_count", "min_value", "max_value")
    for name, row in whole.items():
        assert [row[c] for c in exact] == [merged[name][c] for c in exact]
    known = sorted(r["v"] for r in table.filter("v IS NOT NULL AND NOT isnan(v)").collect())
    for got in (merged, whole):
        assert abs(got["id"]["distinct_estimate"] - 8000) <= 8000 * 0.06
        assert got["kind"]["distinct_estimate"] == 3
        assert got["kind"]["q50"] is None and got["kind"]["min_value"] is None
        assert got["v"]["null_count"] == 8000 - len(known)
        for share, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
            rank = sum(x <= got["v"][name] for x in known) / len(known)
            assert abs(rank - share) < 0.04


def test_null_report_is_that_of_the_table(table):
    plain = table.drop("day")
    report = profiles.null_report(profiles.profile_parts(plain), "t", max_null_pct=15.0, min_rows=9000)
    want = checks.null_profile(plain, "t", max_null_pct=15.0, min_rows=9000)
    assert report.columns == want.columns
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, want.collect()))


def test_profiles_of_loads(spark, tmp_path, table):
    folder = str(tmp_path / "profiles")
    assert profiles.stored_profile(spark, folder) is None
    plain = table.drop("day")
    for k in range(3):
        profiles.add_profile(folder, f"l{k}", plain.filter(F.col("id") % 3 == k))
        profiles.add_profile(folder, "l0" if k < 2 else f"l{k}", plain.filter(F.col("id") % 3 == (0 if k < 2 else k)))
        if k == 1:
            profiles.merge_stored(spark, folder)
    got = by_column(profiles.read_profile(profiles.stored_profile(spark, folder)))
    assert got["id"]["row_count"] == 8000
    assert (got["id"]["min_value"], got["id"]["max_value"]) == (0.0, 7999.0)


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a bigint, b string")
    got = by_column(profiles.read_profile(profiles.profile_parts(empty)))
    assert got["a"]["row_count"] == 0 and got["a"]["q50"] is None
    assert got["b"]["distinct_estimate"] == 0


@pytest.fixture(scope="module")
def layout(spark, table, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clustered"))
    clustered.write_clustered(table, folder, ["v", "id"], files=12, bloom=["kind"])
    return folder


def test_all_rows_are_there_in_ranges(spark, table, layout):
    index = clustered.file_index(spark, layout).orderBy("first_key").collect()
    assert len(index) > 6
    assert sum(r["rows"] for r in index) == 8000
    rows = clustered.read_range(spark, layout, "v")
    assert rows.count() == 8000
    assert dict(rows.dtypes) == dict(table.dtypes)


def test_the_last_rows_come_from_the_last_files(spark, table, layout):
    files = clustered.file_index(spark, layout).count()
    for n in (1, 50, 900, 8000, 100_000):
        last = clustered.read_last(spark, layout, n)
        got = reshape.tail_extract(last, ["v", "id"], n).collect()
        want = reshape.tail_extract(table, ["v", "id"], n).collect()
        assert [r["id"] for r in got] == [r["id"] for r in want]
        if n <= 50:
            assert len(last.inputFiles()) == 1
        assert len(last.inputFiles()) <= files


def test_a_range_reads_the_files_that_hold_it(spark, table, layout):
    files = clustered.file_index(spark, layout).count()
    got = clustered.read_range(spark, layout, "v", 48.0, 52.0)
    want = table.filter("v BETWEEN 48 AND 52").count()
    assert got.count() == want > 100
    assert len(got.inputFiles()) < files / 2
    assert clustered.read_range(spark, layout, "v", low=1e9, high=2e9).filter("NOT isnan(v)").count() == 0
    open_ended = clustered.read_range(spark, layout, "v", high=30.0)
    assert open_ended.count() == table.filter("v <= 30").count()


def test_lookups_by_another_column(spark, table, layout):
    rows = clustered.read_range(spark, layout, "v")
    assert rows.filter("kind = 'absent'").count() == 0
    assert rows.filter("kind = 'b'").count() == table.filter("kind = 'b'").count()


def test_tables_that_are_not_clustered(spark, tmp_path):
    with pytest.raises(ValueError, match="no clustered table"):
        clustered.read_last(spark, str(tmp_path), 5)


def test_an_empty_clustered_table(spark, table, tmp_path):
    clustered.write_clustered(table.limit(0), str(tmp_path), ["id"], files=3)
    assert clustered.read_last(spark, str(tmp_path), 5).collect() == []
    assert clustered.read_range(spark, str(tmp_path), "id", 1, 2).columns == table.columns
