"""Cleaning, windows and closing prices against the documented values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE
from tickreport.operators.clean import (clean_quotes, clean_trades, latest_version, select_quotes,
                                        select_trades, versions_per_key)
from tickreport.operators.close import close_per_venue, day_last
from tickreport.operators.windows import (Split, forward_fill, last_value_per_series, moving_avg_range,
                                          moving_avg_rows)
from tickreport.sources.ingest import parse_csv_lines, read_lines

SPLITS = [None, Split(bucket_minutes=1, chunk_rows=2),
          Split(bucket_minutes=7, chunk_rows=3), Split()]

# Trades of two days for two symbols (documented example input).
DOC_TRADES = [
    ("2020-12-20", "ABC", "10:00", 1, 20.12), ("2020-12-20", "ABC", "10:10", 2, 22.32),
    ("2020-12-20", "ABC", "10:20", 3, 21.2), ("2020-12-20", "ABC", "10:30", 4, 25.12),
    ("2020-12-20", "DEF", "10:00", 1, 20.12), ("2020-12-20", "DEF", "10:10", 2, 20.12),
    ("2020-12-20", "DEF", "10:20", 3, 21.12), ("2020-12-20", "DEF", "10:30", 4, 21.12),
    ("2020-12-21", "ABC", "10:00", 1, 24.12), ("2020-12-21", "ABC", "10:10", 2, 21.21),
    ("2020-12-21", "ABC", "10:20", 3, 23.11), ("2020-12-21", "ABC", "10:30", 4, 21.12),
    ("2020-12-21", "DEF", "10:00", 1, 26.12), ("2020-12-21", "DEF", "10:10", 2, 25.12),
    ("2020-12-21", "DEF", "10:20", 3, 22.12), ("2020-12-21", "DEF", "10:30", 4, 21.12),
]


@pytest.fixture(scope="module")
def doc_trades(spark):
    rows = [(dt.date.fromisoformat(d), s, "Exchange1",
             dt.datetime.fromisoformat(f"{d} {t}:00"), seq, p) for d, s, t, seq, p in DOC_TRADES]
    return spark.createDataFrame(
        rows, "trade_dt date, symbol string, exchange string, event_time timestamp_ntz, "
              "event_seq_num bigint, trade_price double")


@pytest.fixture(scope="module")
def sample(spark):
    ev = parse_csv_lines(read_lines(spark, SAMPLE)).cache()
    return clean_trades(select_trades(ev)).cache(), clean_quotes(select_quotes(ev)).cache()


def test_clean_keeps_latest_whole_record(sample):
    trades, quotes = sample
    assert trades.count() == 30 and quotes.count() == 22
    dup = {str(r["trade_dt"]): r for r in quotes.where("symbol='CORE' AND event_seq_num=27 "
                                                       "AND exchange='NYX'").collect()}
    assert (dup["2021-01-01"]["bid_price"], dup["2021-01-01"]["bid_size"],
            dup["2021-01-01"]["ask_price"], dup["2021-01-01"]["ask_size"]) == (200.1, 4, 201.9, 7)
    assert (dup["2021-01-02"]["bid_price"], dup["2021-01-02"]["bid_size"],
            dup["2021-01-02"]["ask_price"], dup["2021-01-02"]["ask_size"]) == (198.7, 6, 199.9, 10)


def test_latest_version_never_mixes_columns(spark):
    df = spark.createDataFrame(
        [(1, 1, 9.0, 1), (1, 2, 1.0, 7), (1, 3, 5.0, 3), (2, 1, 4.0, 4)],
        "k int, v int, price double, size int")
    got = {r["k"]: (r["price"], r["size"]) for r in latest_version(df, ["k"], ["price", "size"], ["v"]).collect()}
    assert got == {1: (5.0, 3), 2: (4.0, 4)}
    audit = {r["k"]: tuple(r)[1:] for r in versions_per_key(df, ["k"], "v").collect()}
    assert audit == {1: (3, 3, 1, 3), 2: (1, 1, 1, 1)}


@pytest.mark.parametrize("split", SPLITS)
def test_rows_moving_average_documented(doc_trades, split):
    got = moving_avg_rows(doc_trades, split=split).where("trade_dt = '2020-12-21'").orderBy(
        "symbol", "event_time").collect()
    expect = [24.12, 22.665, 22.813333, 21.813333, 26.12, 25.62, 24.453333, 22.786667]
    assert [round(r["avg_trade_price"], 6) for r in got] == pytest.approx(expect, abs=1e-6)


@pytest.mark.parametrize("split", SPLITS)
def test_range_moving_average(doc_trades, split):
    got = moving_avg_range(doc_trades, minutes=30, split=split).where(
        "trade_dt = '2020-12-21' AND event_seq_num = 4").orderBy("symbol").collect()
    assert [round(r["avg_trade_price"], 6) for r in got] == pytest.approx([22.39, 23.62], abs=1e-6)


@pytest.mark.parametrize("split", SPLITS)
def test_range_frame_peers_share_values(sample, split):
    trades, _ = sample
    got = moving_avg_range(trades, minutes=30, split=split).where(
        "trade_dt = '2021-01-02' AND symbol = 'ACME'").orderBy("event_time", "exchange").collect()
    by_time = [(r["event_time"].strftime("%H:%M"), round(r["avg_trade_price"], 6)) for r in got]
    assert by_time.count(("14:00", 14.4)) == 2
    assert ("14:25", 14.325) in by_time


def test_close_documented(doc_trades):
    close = day_last(moving_avg_rows(doc_trades), ["avg_trade_price"], ["close_price"]).where(
        "trade_dt = '2020-12-20'").orderBy("symbol").collect()
    assert [round(r["close_price"], 6) for r in close] == pytest.approx([22.88, 20.786667], abs=1e-6)


def test_close_sample_replicated_per_exchange(sample):
    trades, _ = sample
    c = close_per_venue(day_last(moving_avg_rows(trades), ["avg_trade_price"], ["close_price"]), trades).where(
        "trade_dt = '2021-01-01'").collect()
    got = sorted((r["symbol"], r["exchange"], round(r["close_price"], 6)) for r in c)
    assert got == [("ACME", "LSQ", 12.833333), ("ACME", "NYX", 12.833333), ("BOLT", "LSQ", 50.833333),
                   ("BOLT", "NYX", 50.833333), ("CORE", "NYX", 200.666667)]


def test_last_value_per_series(doc_trades):
    rows = last_value_per_series(moving_avg_rows(doc_trades), ["avg_trade_price"], ["last_pr"]).where(
        "trade_dt = '2020-12-20'").collect()
    assert len(rows) == 8
    assert {(r["symbol"], round(r["last_pr"], 6)) for r in rows} == {("ABC", 22.88), ("DEF", 20.786667)}


@pytest.mark.parametrize("split", SPLITS)
def test_forward_fill_matches_plain(spark, split):
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        t = dt.datetime(2021, 1, 1, 9) + dt.timedelta(minutes=rnd.randint(0, 300))
        v = None if rnd.random() < 0.6 else float(i)
        rows.append((dt.date(2021, 1, 1), f"S{rnd.randint(0, 2)}", f"X{rnd.randint(0, 1)}", t, i, v))
    df = spark.createDataFrame(rows, "trade_dt date, symbol string, exchange string, "
                                     "event_time timestamp_ntz, event_seq_num bigint, v double")
    plain = {r["event_seq_num"]: r["f"] for r in forward_fill(df, "v", "f", split=None).collect()}
    got = {r["event_seq_num"]: r["f"] for r in forward_fill(df, "v", "f", split=split).collect()}
    assert got == plain


@pytest.mark.parametrize("split", SPLITS[1:])
def test_split_windows_match_plain_on_hot_symbol(spark, split):
    import random
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        sym = "HOT" if rnd.random() < 0.7 else f"S{rnd.randint(0, 3)}"
        t = dt.datetime(2021, 1, 1, 9) + dt.timedelta(minutes=rnd.randint(0, 240), seconds=rnd.randint(0, 59))
        rows.append((dt.date(2021, 1, 1), sym, f"X{rnd.randint(0, 2)}", t, i, float(rnd.randint(1, 1000))))
    df = spark.createDataFrame(rows, "trade_dt date, symbol string, exchange string, "
                                     "event_time timestamp_ntz, event_seq_num bigint, trade_price double")
    for fn, kw in [(moving_avg_rows, {"n": 3}), (moving_avg_rows, {"n": 5}), (moving_avg_range, {"minutes": 30})]:
        plain = {r["event_seq_num"]: round(r["avg_trade_price"], 9) for r in fn(df, split=None, **kw).collect()}
        got = {r["event_seq_num"]: round(r["avg_trade_price"], 9) for r in fn(df, split=split, **kw).collect()}
        assert got == plain, (fn.__name__, kw)


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("n", [1, 3, 5])
def test_series_end_averages_match_full_windows(spark, split, n):
    import random
    from tickreport.operators.windows import range_avg_at_series_end, rows_avg_at_series_end
    rnd = random.Random(5 + n)
    rows = []
    for i in range(500):
        sym = "HOT" if rnd.random() < 0.7 else f"S{rnd.randint(0, 3)}"
        t = dt.datetime(2021, 1, 1 + rnd.randint(0, 1), 9) + dt.timedelta(minutes=rnd.randint(0, 240))
        rows.append((t.date(), sym, f"X{rnd.randint(0, 2)}", t, i, float(rnd.randint(1, 1000))))
    df = spark.createDataFrame(rows, "trade_dt date, symbol string, exchange string, "
                                     "event_time timestamp_ntz, event_seq_num bigint, trade_price double")
    key = lambda r: (str(r["trade_dt"]), r["symbol"])
    want = {key(r): round(r["a"], 9) for r in day_last(moving_avg_rows(df, n=n, split=None), ["avg_trade_price"], ["a"]).collect()}
    got = {key(r): round(r["a"], 9) for r in rows_avg_at_series_end(df, n=n, out="a").collect()}
    assert got == want
    want30 = {key(r): round(r["a"], 9) for r in day_last(moving_avg_range(df, split=None), ["avg_trade_price"], ["a"]).collect()}
    got30 = {key(r): round(r["a"], 9) for r in range_avg_at_series_end(df, out="a").collect()}
    assert got30 == want30


def test_latest_version_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(50)], "k int, v int, price double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = latest_version(df, ["k"], ["price"], ["v"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # A partial group limit runs below the exchange: one row per key per map task.
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below
    assert [r["price"] for r in latest_version(df, ["k"], ["price"], ["v"]).collect()] == [49.0]


NULL_ROWS = [(d, s, "X", None if m is None else dt.datetime(2021, 1, 1, 9) + dt.timedelta(minutes=m), i, p)
             for i, (d, s, m, p) in enumerate([
                 (dt.date(2021, 1, 1), "A", 0, 1.0), (dt.date(2021, 1, 1), "A", 30, 2.0),
                 (dt.date(2021, 1, 1), "A", 31, 4.0), (dt.date(2021, 1, 1), "A", 31, 6.0),
                 (dt.date(2021, 1, 1), "A", None, 8.0), (dt.date(2021, 1, 1), "A", None, None),
                 (dt.date(2021, 1, 1), None, 5, 16.0), (dt.date(2021, 1, 1), None, 36, 32.0),
                 (None, "A", 7, 64.0), (None, None, None, 128.0), (dt.date(2021, 1, 1), "A", 62, None)])]


@pytest.mark.parametrize("split", [Split(bucket_minutes=1, chunk_rows=2), Split(bucket_minutes=7), Split()])
def test_split_windows_keep_null_keys(spark, split):
    df = spark.createDataFrame(NULL_ROWS, "trade_dt date, symbol string, exchange string, event_time timestamp_ntz, "
                                          "event_seq_num bigint, trade_price double")
    calls = {"rows": lambda s: moving_avg_rows(df, n=2, out="o", split=s),
             "range": lambda s: moving_avg_range(df, out="o", split=s),
             "fill": lambda s: forward_fill(df, "trade_price", "o", split=s)}
    for name, fn in calls.items():
        plain = {r["event_seq_num"]: r["o"] for r in fn(None).collect()}
        got = {r["event_seq_num"]: r["o"] for r in fn(split).collect()}
        assert len(plain) == len(NULL_ROWS) and got == plain, name
    last = {r["event_seq_num"]: r["o"] for r in last_value_per_series(df, ["trade_price"], ["o"]).collect()}
    assert last[6] == 32.0 and last[8] == 64.0 and last[9] == 128.0 and len(last) == len(NULL_ROWS)


def test_range_average_is_linear_in_a_hot_hour(spark):
    """Four times the rows of one symbol-hour take about four times as long (the
    sliding frame took sixteen); the bound leaves room for a busy machine."""
    import time

    def run(n):
        df = spark.range(n).selectExpr(
            "date'2021-01-01' as trade_dt", "'HOT' as symbol", "'X' as exchange",
            "timestamp_ntz'2021-01-01 09:00:00' + make_dt_interval(0, 0, 0, id * 3600.0 / " + str(n) + ") as event_time",
            "id as event_seq_num", "cast(id % 100 as double) as trade_price")
        t = time.perf_counter()
        moving_avg_range(df).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    run(1000)
    small, large = run(20_000), run(80_000)
    assert large < 9 * small + 2
