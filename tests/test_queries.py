"""Every query of the reconciliation operators against its DuckDB SQL on the smallest tables."""

import os

import duckdb
import pytest

from recolith.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    return int(value) if hasattr(value, "__int__") and not isinstance(value, (str, bool)) and int(value) == value else value


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = sorted(str([plain(r[c]) for c in columns]) for r in got.collect())
    assert name in ORACLE_SQL
    result = duck.sql(ORACLE_SQL[name])
    assert sorted(result.columns) == columns
    at = [result.columns.index(c) for c in columns]
    expected = sorted(str([plain(r[i]) for i in at]) for r in result.fetchall())
    assert rows == expected and rows
