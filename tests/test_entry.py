"""Driver contract: the entry runs, and queries match their SQL oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from daypulse.plans import oracle
from daypulse.plans.queries import QUERIES, TABLES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"metric", "mean", "trend_direction", "trend_pct"} <= set(df.columns)


def test_every_library_query_has_an_oracle():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def _key(row):
    return tuple((x is not None, repr(x)) for x in row)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = sorted((tuple(r[c] for c in sorted(r.asDict())) for r in QUERIES[name](spark, SMALL).collect()),
                 key=_key)
    cur = con.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    exp = sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=_key)
    assert len(got) == len(exp)
    assert got == exp
