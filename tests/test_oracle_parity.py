"""Every registered query with an SQL oracle matches DuckDB at sf0.001."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from opsight.sources.tables import TABLE_NAMES
from tools.oracle_check import _rows

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows, True) == _rows(dcols, drows, True)


def test_every_query_has_a_callable():
    q = E.queries()
    assert len(q) >= 70
    assert set(ORACLES) <= set(q)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["report_date", "ticket_count", "rolling_30d_avg", "rolling_30d_std", "status"]
    assert df.count() >= 0
