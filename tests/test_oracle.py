"""Every registered query against its DuckDB oracle on the sf0.001 tables:
row count, column names and order-insensitive values."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from clickscope.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["events", "customer", "part"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(round(v, 9)))
    return (1, str(v))


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    got = df.collect()
    rel = con.sql(oracle_sql()[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    a = sorted(tuple(_norm(v) for v in r) for r in got)
    b = sorted(tuple(_norm(r[i]) for i in order) for r in want)
    assert a == b


def test_entry_smoke(spark):
    df = entry(spark)
    r = df.collect()
    assert len(r) == 1 and r[0]["session_count"] == 88


def test_oracle_writes_its_constants_itself(spark, con, monkeypatch):
    """A wrong city row on the Spark side must not pass."""
    from clickscope.sources import fixtures

    wrong = [(i, n, "华东" if i == 0 else a) for i, n, a in fixtures.CITY_ROWS]
    monkeypatch.setattr(fixtures, "CITY_ROWS", wrong)
    got = {(r.area, r.city_name) for r in queries()["area_base"](spark, SF).select("area", "city_name").collect()}
    rel = con.sql(oracle_sql()["area_base"])
    want = {(r[rel.columns.index("area")], r[rel.columns.index("city_name")]) for r in rel.fetchall()}
    assert got != want
