"""Driver contract: entry() runs, every query has a callable, and every
query with oracle SQL matches DuckDB on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.standin import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import digest


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["show_id", "show_name", "season", "total_episodes"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 40


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(sdf.columns, srows) == digest(ocols, orows)
