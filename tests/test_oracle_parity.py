"""Every registered query against its DuckDB SQL on the smallest driver tables
(the driver runs the same comparison at sf0.01)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from arenaspark.plans.queries import NO_ORACLE, REGISTRY
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in data)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(REGISTRY)))
def test_query_matches_sql(spark, duck, name):
    df = REGISTRY[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(exp)
    assert _digest(df.columns, got) == _digest(ocols, exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "team" in df.columns
    assert E.entry(spark).schema == df.schema


def test_every_query_has_sql_or_is_model():
    assert set(REGISTRY) - set(E.oracle_sql()) == NO_ORACLE
    assert set(REGISTRY) <= set(E.queries())
