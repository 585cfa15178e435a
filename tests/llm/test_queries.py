"""The registered queries against their SQL (the others have brute-force tests of their operators)."""

import duckdb
import pytest

from bidlake.llm.queries import REGISTRY
from tests.conftest import SF001
from tools.oracle_check import digest


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_query_matches_sql(spark, name):
    query, sql = REGISTRY[name]
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = query(spark, SF001)
    found = con.execute(sql)
    names, want = [d[0] for d in found.description], found.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(want, names)[0]
