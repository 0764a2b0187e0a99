"""Registered corpus queries with SQL give the rows of DuckDB on the same files."""

import duckdb
import pytest

from newsweave.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = duck.execute(queries.ORACLE[name])
    columns = [d[0] for d in result.description]
    found = queries.QUERIES[name](spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(result.fetchall()) and any(r[-1] for r in found)
