"""Every named query against its SQL twin on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from linkloom.plans.catalog import QUERIES
from linkloom.plans.oracles import oracle_queries

FOLDER = entry.SMALL
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_all_queries_have_an_oracle():
    assert QUERIES.keys() == oracle_queries().keys()
    assert QUERIES.keys() <= entry.queries().keys() and oracle_queries().keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    got = [tuple(row) for row in result.select(*columns).collect()]
    relation = duck.sql(entry.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    expected = relation.project(", ".join(f'"{column}"' for column in columns)).fetchall()
    assert expected, "the query gives no rows"
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
