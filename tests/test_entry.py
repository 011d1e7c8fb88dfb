"""Driver contract: entry runs, every query has SQL, and they agree at sf0.001."""

import os

import pytest

import __spark_entry__ as E
from tickreport.plans import registry
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["trade_dt", "symbol", "event_time", "event_seq_num", "exchange", "bid_price",
                          "bid_size", "ask_price", "ask_size", "last_trade_price", "last_avg_trade_price",
                          "bid_pr_mv", "ask_pr_mv"]


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, name):
    con = duck(SF)
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["ok"], r
