"""Every registered query against its DuckDB counterpart on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = sorted(str(tuple(r[c] for c in columns)) for r in df.collect())
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert rows == sorted(str(tuple(r[i] for i in places)) for r in cursor.fetchall())
