"""Every registered plan against its SQL oracle (DuckDB) on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tools.check_oracle import TABLES, digest

pytestmark = pytest.mark.skipif(not os.path.isdir(SF0001), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF0001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_matches_oracle(spark, con, name):
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL for it: tested against brute force beside its operator")
    df = E.queries()[name](spark, SF0001)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "trade_value" in df.columns
