"""Queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from arenaspark.llm.queries import ORACLE, REGISTRY
from conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    df = REGISTRY[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(cols)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, df.select(*cols).collect()), key=key) == sorted(cur.fetchall(), key=key)


def test_every_numbered_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
