"""Every registered query against its SQL, on the driver's smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from cantiga.plans.expected import EXPECTED
from cantiga.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not there")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def test_every_query_has_sql():
    assert set(EXPECTED) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(EXPECTED) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["name", "views", "songs", "first_seq"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, database, name):
    result = QUERIES[name](spark, str(DATA))
    expected = database.execute(EXPECTED[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = canonical(result.columns, map(tuple, result.collect()))
    assert got == canonical(columns, expected.fetchall())
