"""Every registered query with SQL must give the same rows as DuckDB on the same files."""

import math

import duckdb
import pytest

from newsweave.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows(found, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(plain(row[i]) for i in order) for row in found)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    expected = rows(result.fetchall(), [d[0] for d in result.description])
    assert rows([tuple(r) for r in df.collect()], df.columns) == expected


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["graph_view_documents", "explorer_nodes"])
def test_other_queries_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
