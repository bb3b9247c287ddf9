"""Queries whose results SQL can express, against DuckDB over whole tables."""

import duckdb
import pytest

from llm_rows import SF_SMALL
from ladle.llm.queries import ORACLES, QUERIES


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, name, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    got = sorted((tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    rel = con.execute(ORACLES[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    at = [cols.index(c) for c in sorted(cols)]
    assert got == sorted((tuple(_norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
