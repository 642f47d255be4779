"""Registered queries against their DuckDB SQL twins (small scale), and the
driver smoke entry."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from catalink.plans import registry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
entry.queries()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def canon(rows, cols):
    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 5)
        return v
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns[0] == "genre"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    rel = duck.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(dcols)
    assert canon(rows, cols) == canon(rel.fetchall(), dcols)
