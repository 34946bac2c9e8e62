"""Driver contract: entry runs, every query has an oracle, a sample agrees."""

import duckdb
import pytest

import __spark_entry__ as E
from ballotlake.plans.catalog import ORACLE, QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["county", "DateDT", "votesOnDate", "DaysFromElection", "votesToDate"]


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert digest(df.columns, rows)[:2] == digest(ocols, cur.fetchall())[:2]
