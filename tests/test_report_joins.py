"""Quote report (both semantics), as-of join against brute force, union."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F
import pytest

from conftest import SAMPLE
from tickreport.operators.clean import clean_quotes, clean_trades, select_quotes, select_trades
from tickreport.operators.joins import asof_join
from tickreport.operators.setops import exchange_overlap, quote_union
from tickreport.operators.windows import Split, moving_avg_rows
from tickreport.plans.report import quote_report, quote_report_asof, report_preview
from tickreport.sources.ingest import parse_csv_lines, read_lines

SPLITS = [None, Split(bucket_minutes=1, chunk_rows=2), Split()]

# Own figures for the own feed on 2021-01-02, worked out with pandas (symbol, venue,
# time, number, last price, last average, bid movement, ask movement).
GOLDEN_REPORT = [
    ("ACME", "NYX", "09:20", 21, 14.1, 14.366667, -0.033333, 0.466667),
    ("ACME", "LSQ", "09:55", 22, 14.1, 14.366667, 0.366667, 0.766667),
    ("ACME", "NYX", "14:00", 23, 14.1, 14.366667, 1.466667, 1.866667),
    ("ACME", "LSQ", "14:40", 30, 14.1, 14.366667, 1.166667, 1.666667),
    ("BOLT", "NYX", "09:45", 24, 46.4, 46.966667, -3.033333, -2.433333),
    ("BOLT", "LSQ", "10:30", 25, 46.4, 46.966667, -3.633333, -2.933333),
    ("BOLT", "LSQ", "13:10", 31, 46.4, 46.966667, -3.933333, -3.533333),
    ("BOLT", "NYX", "15:00", 26, 46.4, 46.966667, -4.633333, -4.033333),
    ("CORE", "NYX", "12:00", 27, 202.4, 201.3, -1.966667, -0.766667),
    ("CORE", "NYX", "15:15", 29, 202.4, 201.3, 1.433333, 2.333333),
]


@pytest.fixture(scope="module")
def sample(spark):
    ev = parse_csv_lines(read_lines(spark, SAMPLE)).cache()
    return clean_trades(select_trades(ev)).cache(), clean_quotes(select_quotes(ev)).cache()


def _report_rows(df):
    rows = df.orderBy("symbol", "event_time", "exchange").collect()
    return [(r["symbol"], r["exchange"], r["event_time"].strftime("%H:%M"), r["event_seq_num"],
             round(r["last_trade_price"], 6), round(r["last_avg_trade_price"], 6),
             round(r["bid_pr_mv"], 6), round(r["ask_pr_mv"], 6)) for r in rows]


def test_quote_report_golden(sample):
    trades, quotes = sample
    got = _report_rows(quote_report(trades, quotes, dates=["2021-01-02"]))
    assert got == GOLDEN_REPORT
    # All days at once: the first day has no previous close, so the same rows.
    assert _report_rows(quote_report(trades, quotes)) == GOLDEN_REPORT


def test_quote_report_trading_day(sample):
    trades, quotes = sample
    assert quote_report(trades, quotes, dates=[]).count() == 0
    assert _report_rows(quote_report(trades, quotes, prev_trading_day=True)) == GOLDEN_REPORT
    # Drop 2021-01-01 trades → no previous close → empty report, no error.
    assert quote_report(trades.where("trade_dt > '2021-01-01'"), quotes).count() == 0


@pytest.mark.parametrize("split", SPLITS)
def test_asof_golden(sample, split):
    trades, quotes = sample
    a = asof_join(quotes, moving_avg_rows(trades, split=split), ["trade_price", "avg_trade_price"],
                  split=split)
    assert a.count() == 22
    hit = sorted((str(r["trade_dt"]), r["symbol"], r["exchange"], r["event_time"].strftime("%H:%M"),
                  r["trade_price"], round(r["avg_trade_price"], 6))
                 for r in a.where("trade_price IS NOT NULL").collect())
    d1, d2 = "2021-01-01", "2021-01-02"
    assert hit == sorted([
        (d1, "ACME", "LSQ", "10:15", 12.5, 11.166667), (d1, "ACME", "NYX", "09:40", 10.0, 10.0),
        (d1, "ACME", "NYX", "13:15", 13.0, 12.5), (d1, "ACME", "NYX", "14:05", 12.9, 12.833333),
        (d1, "BOLT", "LSQ", "11:00", 51.0, 51.0), (d1, "BOLT", "LSQ", "15:10", 49.5, 50.833333),
        (d1, "BOLT", "NYX", "14:30", 49.5, 50.833333), (d1, "CORE", "LSQ", "12:20", 201.0, 201.0),
        (d1, "CORE", "NYX", "12:00", 201.0, 201.0), (d1, "CORE", "NYX", "15:30", 199.0, 200.666667),
        (d2, "ACME", "LSQ", "09:55", 13.4, 13.25), (d2, "ACME", "LSQ", "14:40", 14.1, 14.366667),
        (d2, "ACME", "NYX", "14:00", 14.6, 13.933333), (d2, "BOLT", "LSQ", "10:30", 47.5, 47.75),
        (d2, "BOLT", "LSQ", "13:10", 47.0, 47.5), (d2, "BOLT", "NYX", "09:45", 48.0, 48.0),
        (d2, "BOLT", "NYX", "15:00", 46.4, 46.966667), (d2, "CORE", "LSQ", "12:40", 198.5, 197.75),
        (d2, "CORE", "NYX", "12:00", 198.5, 197.75), (d2, "CORE", "NYX", "15:15", 202.4, 201.3)])


def _brute_asof(quotes, trades, inclusive):
    out = {}
    for _, q in quotes.iterrows():
        cand = trades[(trades.symbol == q.symbol) & (trades.trade_dt == q.trade_dt)]
        cand = cand[cand.event_time <= q.event_time] if inclusive else cand[cand.event_time < q.event_time]
        if len(cand):
            best = cand.sort_values(["event_time", "event_seq_num", "exchange"]).iloc[-1]
            out[q.event_seq_num] = best.trade_price
        else:
            out[q.event_seq_num] = None
    return out


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("split", SPLITS)
def test_asof_matches_brute_force_with_ties(spark, inclusive, split):
    rnd = random.Random(3)
    day = dt.date(2021, 1, 1)

    def t(m):
        return dt.datetime(2021, 1, 1, 9) + dt.timedelta(minutes=m)
    trade_rows = [(day, "HOT" if rnd.random() < 0.7 else "S1", f"X{rnd.randint(0, 2)}",
                   t(rnd.randint(0, 180)), i, float(i)) for i in range(300)]
    quote_rows = [(day, "HOT" if rnd.random() < 0.7 else "S1", "X0", t(rnd.randint(0, 180)), 1000 + i)
                  for i in range(200)]
    trades = pd.DataFrame(trade_rows, columns=["trade_dt", "symbol", "exchange", "event_time",
                                               "event_seq_num", "trade_price"])
    quotes = pd.DataFrame(quote_rows, columns=["trade_dt", "symbol", "exchange", "event_time", "event_seq_num"])
    schema_t = "trade_dt date, symbol string, exchange string, event_time timestamp_ntz, " \
               "event_seq_num bigint, trade_price double"
    schema_q = "trade_dt date, symbol string, exchange string, event_time timestamp_ntz, event_seq_num bigint"
    st = spark.createDataFrame(trade_rows, schema_t)
    sq = spark.createDataFrame(quote_rows, schema_q)
    got = {r["event_seq_num"]: r["trade_price"]
           for r in asof_join(sq, st, ["trade_price"], inclusive=inclusive, split=split).collect()}
    assert got == _brute_asof(quotes, trades, inclusive)


def test_report_asof_semantics(sample):
    trades, quotes = sample
    rows = quote_report_asof(trades, quotes, split=Split(bucket_minutes=1)).orderBy(
        "symbol", "event_time").collect()
    assert len(rows) == 10
    matched = [r for r in rows if r["last_trade_price"] is not None]
    assert [(r["symbol"], r["event_time"].strftime("%H:%M"), r["last_trade_price"]) for r in matched] == [
        ("ACME", "09:55", 13.4), ("ACME", "14:00", 14.6), ("ACME", "14:40", 14.1), ("BOLT", "09:45", 48.0),
        ("BOLT", "10:30", 47.5), ("BOLT", "13:10", 47.0), ("BOLT", "15:00", 46.4), ("CORE", "12:00", 198.5),
        ("CORE", "15:15", 202.4)]
    assert [round(r["last_avg_trade_price"], 6) for r in matched[:3]] == [13.25, 14.4, 14.325]


def test_preview_is_ordered_top_k(sample):
    trades, quotes = sample
    prev = report_preview(quote_report(trades, quotes), 3).collect()
    assert [r["event_seq_num"] for r in prev] == [21, 22, 23]


def test_union_documented(spark):
    rows = [("2020-12-21", "ABC", "10:00", 1, 24.12), ("2020-12-21", "ABC", "10:10", 2, 21.21)]
    trades = spark.createDataFrame(
        [(dt.date.fromisoformat(d), s, "Exchange1", dt.datetime.fromisoformat(f"{d} {h}:00"), q, p)
         for d, s, h, q, p in rows],
        "trade_dt date, symbol string, exchange string, event_time timestamp_ntz, event_seq_num bigint, "
        "trade_price double")
    quotes = spark.createDataFrame(
        [(dt.date(2020, 12, 21), "ABC", "Exchange1", dt.datetime(2020, 12, 21, 10), 1, 20.12, 120, 21.57, 110)] * 2,
        "trade_dt date, symbol string, exchange string, event_time timestamp_ntz, event_seq_num bigint, "
        "bid_price double, bid_size bigint, ask_price double, ask_size bigint")
    u = quote_union(moving_avg_rows(trades), quotes).orderBy("rec_type", "event_time").collect()
    assert len(u) == 3   # duplicate quote collapses under UNION
    assert u[0]["rec_type"] == "Q" and u[0]["trade_price"] is None and u[0]["mov_avg_pr"] is None
    assert [(r["rec_type"], r["event_seq_num"], r["bid_price"], round(r["mov_avg_pr"], 4)) for r in u[1:]] == [
        ("T", None, None, 24.12), ("T", None, None, 22.665)]
    assert [r["exchange"] for r in exchange_overlap(trades, quotes).collect()] == ["Exchange1"]


def test_report_asof_previous_trading_day(sample):
    trades, quotes = sample
    plain = quote_report_asof(trades, quotes, split=Split(bucket_minutes=1)).count()
    trading = quote_report_asof(trades, quotes, split=Split(bucket_minutes=1), prev_trading_day=True).count()
    assert plain == trading == 10
    # A gap day: move day 2 two days later; calendar close is missing, trading-day close is not.
    shift = lambda df: df.withColumn("trade_dt", F.when(F.col("trade_dt") == F.lit("2021-01-02").cast("date"),
                                                        F.lit("2021-01-04").cast("date")).otherwise(F.col("trade_dt")))
    t2, q2 = shift(trades), shift(quotes)
    assert quote_report(t2, q2).count() == 0
    assert quote_report(t2, q2, prev_trading_day=True).count() == 10
    assert quote_report_asof(t2, q2, prev_trading_day=True).count() == 10


def test_union_documented_full(spark):
    """The documented 16-row union for 2020-12-21: trades with their 3-row
    averages and quotes on one schema."""
    day = dt.date(2020, 12, 21)

    def t(h, m):
        return dt.datetime(2020, 12, 21, h, m)
    trades = spark.createDataFrame(
        [(day, s, "Exchange1", t(10, 10 * i), i + 1, p) for s, prices in
         (("ABC", [24.12, 21.21, 23.11, 21.12]), ("DEF", [26.12, 25.12, 22.12, 21.12]))
         for i, p in enumerate(prices)],
        "trade_dt date, symbol string, exchange string, event_time timestamp_ntz, event_seq_num bigint, "
        "trade_price double")
    quotes = spark.createDataFrame(
        [(day, s, "Exchange1", t(10, 10 * i), i + 1, bp, bs, ap, az) for s in ("ABC", "DEF")
         for i, (bp, bs, ap, az) in enumerate([(20.12, 120, 21.57, 110), (20.12, 120, 20.57, 111),
                                               (21.12, 125, 19.57, 113), (21.12, 125, 19.57, 113)])],
        "trade_dt date, symbol string, exchange string, event_time timestamp_ntz, event_seq_num bigint, "
        "bid_price double, bid_size bigint, ask_price double, ask_size bigint")
    u = quote_union(moving_avg_rows(trades), quotes).collect()
    assert len(u) == 16
    got_t = sorted((r["symbol"], r["event_time"].strftime("%H:%M"), r["trade_price"], round(r["mov_avg_pr"], 4))
                   for r in u if r["rec_type"] == "T")
    assert got_t == [("ABC", "10:00", 24.12, 24.12), ("ABC", "10:10", 21.21, 22.665),
                     ("ABC", "10:20", 23.11, 22.8133), ("ABC", "10:30", 21.12, 21.8133),
                     ("DEF", "10:00", 26.12, 26.12), ("DEF", "10:10", 25.12, 25.62),
                     ("DEF", "10:20", 22.12, 24.4533), ("DEF", "10:30", 21.12, 22.7867)]
    assert all(r["event_seq_num"] is None and r["bid_price"] is None for r in u if r["rec_type"] == "T")
    got_q = [r for r in u if r["rec_type"] == "Q"]
    assert len(got_q) == 8 and all(r["trade_price"] is None and r["mov_avg_pr"] is None for r in got_q)
    assert sorted((r["symbol"], r["event_seq_num"], r["ask_size"]) for r in got_q)[:4] == [
        ("ABC", 1, 110), ("ABC", 2, 111), ("ABC", 3, 113), ("ABC", 4, 113)]


def test_asof_right_side_without_tie_breaks(spark):
    day = dt.date(2021, 1, 1)
    right = spark.createDataFrame([(day, "S", dt.datetime(2021, 1, 1, 9, 0), 1.0),
                                   (day, "S", dt.datetime(2021, 1, 1, 9, 10), 2.0)],
                                  "trade_dt date, symbol string, event_time timestamp_ntz, px double")
    left = spark.createDataFrame([(day, "S", dt.datetime(2021, 1, 1, 9, 5), 7),
                                  (day, "S", dt.datetime(2021, 1, 1, 8, 0), 8)],
                                 "trade_dt date, symbol string, event_time timestamp_ntz, id int")
    got = {r["id"]: r["px"] for r in asof_join(left, right, ["px"]).collect()}
    assert got == {7: 1.0, 8: None}


def test_union_for_one_day(sample):
    trades, quotes = sample
    u = quote_union(moving_avg_rows(trades), quotes, dates=["2021-01-02"])
    assert {str(r["trade_dt"]) for r in u.collect()} == {"2021-01-02"}
    assert u.where("rec_type = 'T'").count() == 15 and u.where("rec_type = 'Q'").count() == 11


def test_quote_only_day_keeps_the_close(sample):
    """Trades on two days with a gap; a day that only has quotes in between takes
    nothing away from the next trading day."""
    trades, quotes = sample
    to = lambda df, day: df.withColumn("trade_dt", F.when(F.col("trade_dt") == F.lit("2021-01-02").cast("date"),
                                                          F.lit(day).cast("date")).otherwise(F.col("trade_dt")))
    t, q = to(trades, "2021-01-08"), to(quotes, "2021-01-08")
    between = to(quotes, "2021-01-06").where("trade_dt = '2021-01-06'")
    alone = quote_report(t, q, prev_trading_day=True).count()
    assert alone == 10
    both = quote_report(t, q.unionByName(between), prev_trading_day=True)
    assert both.where("trade_dt = '2021-01-08'").count() == 10
    asof = quote_report_asof(t, q.unionByName(between), prev_trading_day=True)
    assert {str(r["trade_dt"]) for r in asof.select("trade_dt").distinct().collect()} == {"2021-01-06", "2021-01-08"}
