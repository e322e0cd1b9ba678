"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlake.plans.queries import REGISTRY
from oracle import sql as oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = REGISTRY, oracle.statements()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def _plain(rows):
    clean = [tuple(float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in r) for r in rows]
    return sorted(clean, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = _plain(tuple(r[c] for c in cols) for r in df.collect())
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == _plain(tuple(r[i] for i in at) for r in cur.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert "ai_reason" in df.columns and df.count() > 0
