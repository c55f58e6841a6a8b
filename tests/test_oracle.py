"""Every registered query against its oracle text, on the driver's tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from freshet.catalog.fixtures import TABLES

SF = os.environ.get("FRESHET_TEST_SF", "/root/testdata/sf0.01")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("~" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    want = canon(cols, cur.fetchall())
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(want)
    assert got == want


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "risk" in df.columns


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_learned_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
