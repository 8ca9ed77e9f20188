"""Every registered query against its SQL counterpart, and the shape of the plans."""

import math

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as driver
from __spark_entry__ import ORACLES, QUERIES
from tests.conftest import SF

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(table: pa.Table):
    columns = sorted(table.column_names)
    rows = list(zip(*[table[c].to_pylist() for c in columns], strict=True))
    return sorted(rows, key=repr)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1.1e-6)
    return a == b


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(queried, duck, name):
    got = queried(name).toArrow()
    want = duck.sql(driver.oracle_sql()[name]).to_arrow_table()
    types = {f.name: str(f.type) for f in got.schema}
    assert types == {f.name: str(f.type) for f in want.schema}
    assert got.num_rows == want.num_rows
    for mine, theirs in zip(comparable(got), comparable(want), strict=True):
        assert all(map(same, mine, theirs)), (mine, theirs)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "factory_id"
    assert df.count() > 0
