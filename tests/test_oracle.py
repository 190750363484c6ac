"""Every registered query with oracle SQL agrees with DuckDB (sf0.001)."""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMOKE
from vectable.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def test_every_query_has_a_callable():
    qs, sql = queries(), oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 40


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["true", "pred", "n"]
    assert sum(r["n"] for r in rows) == spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet").count()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_duckdb(spark, duck, name):
    df = queries()[name](spark, SF_SMOKE)
    cols = df.columns
    got = [tuple(_norm(x) for x in r) for r in df.collect()]
    rel = duck.sql(oracle_sql()[name])
    dcols = rel.columns
    exp = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    assert sorted(cols) == sorted(dcols)
    o = sorted(range(len(cols)), key=lambda i: cols[i])
    d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted((tuple(r[i] for i in o) for r in got), key=_key)
    b = sorted((tuple(r[i] for i in d) for r in exp), key=_key)
    assert a == b
