"""Every registered query against its SQL, run by DuckDB over the same tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: query for name, (query, _) in contract.REGISTERED.items()}
SQL = {name: sql for name, (_, sql) in contract.REGISTERED.items()}

# Spark type to the DuckDB type it must come out as.
SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "decimal(18,2)": "DECIMAL(18,2)",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    want = duck.sql(SQL[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types)))
    assert {n: SAME_TYPE[t] for n, t in got.dtypes} == kinds
    got_rows = sorted((tuple(row[n] for n in names) for row in got.collect()), key=repr)
    order = [want.columns.index(n) for n in names]
    want_rows = sorted((tuple(row[i] for i in order) for row in want.fetchall()), key=repr)
    assert len(got_rows) > 0
    assert got_rows == want_rows
