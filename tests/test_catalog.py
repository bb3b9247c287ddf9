"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ladle.plans.catalog import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = duck.execute(ORACLES[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
