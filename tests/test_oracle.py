"""Every registered query against its independent DuckDB SQL (sf0.001).

The driver repeats this at sf0.01; here it guards each change.
"""

import duckdb
import pytest

import __spark_entry__ as E
from bidlake.plans.catalog import REGISTRY
from bidlake.sources.standins import DRIVER_TABLES
from tests.conftest import SF001
from tools.oracle_check import digest

QUERIES = {name: fn for name, (fn, _sql) in REGISTRY.items()}
SQL = {name: sql for name, (_fn, sql) in REGISTRY.items() if sql is not None}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_is_registered_with_sql_or_listed():
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) >= 50


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "noticeId" in df.columns and "row_pos" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    cols = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(expected)
    assert digest(rows, df.columns)[0] == digest(expected, cols)[0]
