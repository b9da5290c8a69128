"""Every registered query with a SQL oracle matches DuckDB on sf0.001;
every query without one runs and returns a stable schema."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

ORACLES = E.oracle_sql()
ALL = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = ALL[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


@pytest.mark.parametrize("name", sorted(set(ALL) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = ALL[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["season", "total_cases", "mean_per_estab_week", "peak_count"]
    assert df.count() == 4
