"""Every registered query with an oracle equals its DuckDB SQL on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from lathe.sources.files import TABLES

from conftest import SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_name_and_most_have_oracles():
    assert len(QUERIES) >= 150
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) >= 130


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    c1, r1 = _canon(df.columns, rows)
    c2, r2 = _canon(ocols, cur.fetchall())
    assert c1 == c2
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
