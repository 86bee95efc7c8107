"""Every query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracles import ORACLES  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402

TABLES = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(TABLES):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{file}'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = queries()[name](spark, TABLES)
    columns = sorted(frame.columns)
    cursor = duck.execute(oracle_sql()[name])
    found = [column[0] for column in cursor.description]
    assert sorted(found) == columns
    places = [found.index(column) for column in columns]
    expected = sorted(repr(tuple(row[i] for i in places)) for row in cursor.fetchall())
    got = sorted(repr(tuple(row[column] for column in columns)) for row in frame.collect())
    assert got == expected


def test_entry(spark):
    assert not entry(spark).isEmpty()
