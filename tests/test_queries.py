"""Every registered query against the SQL it must equal, over whole tables."""

import math

import duckdb
import pytest

from martweave.queries import ORACLE_SQL, QUERIES
from martweave.queries.inputs import TABLES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_canonical(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, oracle, name):
    result = QUERIES[name](spark, sf_dir)
    actual = result.collect()
    relation = oracle.execute(ORACLE_SQL[name])
    columns = [d[0] for d in relation.description]
    expected = relation.fetchall()
    assert sorted(result.columns) == sorted(columns)
    assert len(actual) == len(expected)
    assert _rows(result.columns, actual) == _rows(columns, expected)
    assert actual, "the query should find something to compare"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).collect()
