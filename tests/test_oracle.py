"""Every registered query against its SQL text in DuckDB, over whole tables."""

import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from rosterline.plans import catalog
from rosterline.plans.catalog import GIVEN

QUERIES = {name: query for name, query in entry_points.queries().items() if name in catalog.QUERIES}
ORACLE = {name: sql for name, sql in entry_points.oracle_sql().items() if name in catalog.QUERIES}
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = [tuple((value is None, str(value)) for value in (row[i] for i in order)) for row in rows]
    return [columns[i] for i in order], [tuple(rows[k][i] for i in order) for k in sorted(range(len(rows)), key=key.__getitem__)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(name, spark, duck):
    df = QUERIES[name](spark, SMALL)
    columns, rows = _sorted(df.columns, [tuple(row) for row in df.collect()])
    relation = duck.sql(ORACLE[name])
    expected_columns, expected = _sorted(relation.columns, relation.fetchall())
    assert columns == expected_columns
    assert rows == expected
    types = dict(df.dtypes)
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SPARK_TO_SQL[t] for c, t in types.items()} == sql_types or not rows


def test_entry_is_not_empty(spark):
    assert entry_points.entry(spark).count() > 0
