"""Batches, days and ranges: what is landed twice, asked for by day, or hot in one minute."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE
from tickreport.operators import joins, windows
from tickreport.operators.jobs import assign_job_ids, seed_tracker
from tickreport.operators.ranges import numbered
from tickreport.operators.trading_days import previous_trading_day
from tickreport.plans import daily_job, registry, report
from tickreport.sources import ingest, store
from tickreport.streaming.ingest_stream import land_batch, read_line_stream, stream_id

SF = "/root/testdata/sf0.001"
D = dt.date


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _counts(spark, landing):
    return {r[0]: r[1] for r in store.read_landing(spark, landing).groupBy("partition").count().collect()}


def test_ids_do_not_depend_on_exchange_reuse(spark):
    names = spark.range(200_000).selectExpr("concat('n', id * 7919 % 1000003) as job_name")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = assign_job_ids(seed_tracker(spark), names)
        got = out.agg(F.count_distinct("job_id"), F.min("job_id"), F.max("job_id")).first()
        ordered = numbered(out, ["job_name"]).where(F.col("_pos") + 4 != F.col("job_id")).count()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert tuple(got) == (200_000, 4, 200_003) and ordered == 0


def test_a_batch_landed_again_replaces_itself(spark, tmp):
    path = os.path.join(tmp, "landing")
    events = ingest.parse_csv_lines(ingest.read_lines(spark, SAMPLE))
    store.write_landing(events, path, batch_id="a")
    first = _counts(spark, path)
    store.write_landing(events, path, batch_id="a")
    assert _counts(spark, path) == first == {"T": 30, "Q": 24, "B": 6}
    store.write_landing(events, path, batch_id="b")
    assert _counts(spark, path) == {k: 2 * v for k, v in first.items()}
    # A batch that did not get to its manifest is not read.
    store.folders.delete(spark, f"{path}/_batches/batch=b")
    assert _counts(spark, path) == first
    store.write_landing(events.where("trade_dt is null and partition = 'T'"), path, batch_id="none")
    assert _counts(spark, path) == first


def test_a_retried_micro_batch_counts_once(spark, tmp):
    src, landing, ckpt = (os.path.join(tmp, x) for x in ("in", "landing", "ckpt"))
    os.makedirs(src)
    with open(SAMPLE) as f, open(os.path.join(src, "a.csv"), "w") as g:
        g.write(f.read())
    seen = []

    def twice(batch, n):
        for _ in range(2):  # the append came through, its commit did not
            land_batch(batch, landing, batch_id=f"{stream_id(spark, ckpt)}-{n}")
            seen.append(_counts(spark, landing))

    read_line_stream(spark, src).writeStream.option("checkpointLocation", ckpt).foreachBatch(twice) \
        .trigger(availableNow=True).start().awaitTermination(120)
    assert seen == [{"T": 30, "Q": 24, "B": 6}] * 2
    arrivals = store.read_landing(spark, landing, "T").select("arrival_time").distinct().collect()
    assert len(arrivals) == 1  # the file's time, the same in every attempt


def test_correction_opens_the_asked_for_days(spark, tmp):
    daily_job.land(spark, SAMPLE, tmp)
    landing = os.path.join(tmp, "output_partitions")
    one = store.read_landing(spark, landing, "T", ["2021-01-02"])
    scan = next(line for line in _plan(one).split("\n") if "PartitionFilters" in line and "day" in line)
    assert "day" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert {r[0] for r in one.select("trade_dt").distinct().collect()} == {D(2021, 1, 2)}
    assert store.pending_days(spark, landing)[0] == [D(2021, 1, 1), D(2021, 1, 2)]
    daily_job.correct(spark, tmp, pending=True)
    assert store.pending_days(spark, landing) == ([], [])
    late = os.path.join(tmp, "late.csv")
    with open(late, "w") as f:
        f.write("2021-01-02,T,Symbol9,1,2021-01-02 12:00,1,Exchange1,60.0,10\n# bad\n")
    before = os.listdir(os.path.join(tmp, "daily_data", "trade", "trade-dt=2021-01-01"))
    daily_job.land(spark, late, tmp)
    assert store.pending_days(spark, landing)[0] == [D(2021, 1, 2)]
    trades, _ = daily_job.correct(spark, tmp, pending=True)
    assert os.listdir(os.path.join(trades, "trade-dt=2021-01-01")) == before  # not written again
    assert store.read_daily(spark, trades, ["2021-01-02"]).where("symbol = 'Symbol9'").count() == 1


def test_a_withdrawn_day_reads_as_empty(spark, tmp):
    schema = "trade_dt date, symbol string"
    rows = [(D(2021, 1, d), f"s{d}") for d in (1, 2, 3)]
    root = os.path.join(tmp, "daily")
    store.write_daily(spark.createDataFrame(rows, schema), root)
    again = spark.createDataFrame([(D(2021, 1, 1), "new"), (D(2021, 1, 3), "not asked for")], schema)
    store.write_daily(again, root, days=["2021-01-01", "2021-01-02"])
    assert sorted(map(tuple, store.read_daily(spark, root).collect())) == [(D(2021, 1, 1), "new"), (D(2021, 1, 3), "s3")]
    assert not [x for x in os.listdir(root) if x.startswith("_staging")]
    store.write_daily(again.limit(0), root, days=["2021-01-01", "2021-01-03"])
    assert store.read_daily(spark, root, schema=again.schema).count() == 0


def test_a_failure_before_the_swap_changes_nothing(spark, tmp, monkeypatch):
    schema, root = "trade_dt date, symbol string", os.path.join(tmp, "daily")
    store.write_daily(spark.createDataFrame([(D(2021, 1, 1), "old")], schema), root)

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(store.folders, "move", fail)
    with pytest.raises(OSError):
        store.write_daily(spark.createDataFrame([(D(2021, 1, 1), "new")], schema), root, days=["2021-01-01"])
    assert [r["symbol"] for r in store.read_daily(spark, root).collect()] == ["old"]


def test_close_is_broadcast_only_if_small(spark):
    quotes = spark.createDataFrame([(D(2021, 1, 2), "a", "x", 1.0)], "trade_dt date, symbol string, exchange string, p double")
    close = quotes.withColumnRenamed("p", "close_price")
    small, large = (joins.attach_prev_close_broadcast(quotes, close, most) for most in (1 << 20, 10))
    assert "BroadcastHashJoin" in _plan(small) and "SortMergeJoin" in _plan(large)
    assert "BroadcastHashJoin" not in _plan(large) and small.collect() == large.collect()


def _hot(spark):
    """100,000 trades of one symbol inside one minute, and a few others."""
    at = "timestamp_ntz'2021-01-01 10:00:00' + make_dt_interval(0, 0, 0, cast(id % 3 as decimal(8, 6)))"
    hot = spark.range(100_000).selectExpr("date'2021-01-01' trade_dt", "'hot' symbol", "concat('e', id % 2) exchange",
                                          f"{at} event_time", "id * 7919 % 100003 event_seq_num", "id % 1000 / 8 trade_price")
    cold = hot.limit(50).selectExpr("trade_dt", "cast(null as string) symbol", "exchange",
                                    "event_time + make_dt_interval(0, 3) event_time", "event_seq_num", "trade_price")
    return hot.unionByName(cold)


def test_a_hot_minute_is_spread_over_tasks(spark):
    df, split = _hot(spark), windows.Split(chunk_rows=5_000, by_range=True)
    rows = windows.ranged(df, ["trade_dt", "symbol", *windows.SERIES_ORDER])
    sizes = [r["count"] for r in rows.where("symbol = 'hot'").groupBy("_part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 40_000
    plain = windows.moving_avg_rows(df, split=None)
    apart = windows.moving_avg_rows(df, split=split)
    assert apart.columns == plain.columns and apart.count() == 100_050
    assert plain.exceptAll(apart).count() == 0


def test_forward_fill_by_range(spark):
    df = _hot(spark).withColumn("trade_price", F.when(F.col("event_seq_num") % 20_000 == 3, F.col("trade_price")))
    plain = windows.forward_fill(df, "trade_price", "filled", split=None)
    apart = windows.forward_fill(df, "trade_price", "filled", split=windows.Split(by_range=True))
    assert apart.columns == plain.columns and plain.exceptAll(apart).count() == 0 and apart.count() == 100_050
    quotes = df.where("event_seq_num % 50 = 1").select("trade_dt", "symbol", "event_time", "event_seq_num")
    both = [joins.asof_join(quotes, df.where("trade_price is not null"), ["trade_price"], split=s)
            for s in (None, windows.Split(by_range=True))]
    assert both[0].exceptAll(both[1]).count() == 0 and both[0].count() == both[1].count()


def test_previous_trading_day(spark):
    day = lambda *ds: spark.createDataFrame([(D(2021, 1, d),) for d in ds], "trade_dt date")
    got = {r[0].day: r[1] and r[1].day for r in previous_trading_day(day(1, 3, 4, 9), day(1, 4, 8)).collect()}
    assert got == {1: None, 3: 1, 4: 1, 8: 4, 9: 8}


def test_report_after_a_day_of_quotes_only(spark, tmp):
    lines = ["2021-01-01,T,S,1,2021-01-01 12:00,1,E,10.0,1", "2021-01-02,Q,S,2021-01-02 12:00,1,E,11.0,1,12.0,1",
             "2021-01-03,T,S,1,2021-01-03 12:00,1,E,20.0,1", "2021-01-03,Q,S,2021-01-03 12:00,1,E,21.0,1,22.0,1"]
    path = os.path.join(tmp, "f.csv")
    with open(path, "w") as f:
        f.write("\n".join(lines))
    daily_job.land(spark, path, tmp)
    daily_job.correct(spark, tmp, pending=True)
    out = daily_job.report(spark, tmp, dates=["2021-01-03"], prev_trading_day=True)
    assert [r["bid_pr_mv"] for r in spark.read.parquet(out).collect()] == [11.0]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_sql_report_keeps_three_rows_of_a_series(spark):
    plan = _plan(registry.QUERIES["sql_views"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 2 and "], 3, Partial" in plan.replace("row_number(), ", "], ")


def test_summary_counts_nulls_and_odd_prices(spark):
    lines = ["2021-01-01,T,S,1,2021-01-01 12:00,1,E,NaN,1", "2021-01-01,T,S,1,2021-01-01 12:00,2,E,Infinity,1",
             "2021-01-01,T,S,1,2021-01-01 12:00,2,E,1.5,1", "junk"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r["partition"]: r for r in ingest.ingest_summary(ingest.parse_csv_lines(df)).collect()}
    assert got["T"]["nonfinite_trade_price"] == 2 and got["T"]["null_trade_price"] == 0
    assert got["B"]["null_trade_price"] == got["B"]["null_symbol"] == 1 and got["B"]["null_original_line"] == 0


def test_broken_json_has_its_own_reason(spark):
    lines = ['{"broken": ', '{"record_type": "X"}', "", '{"record_type": "T"} tail', '{"record_type": "T"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r[0]: r[1] for r in ingest.bad_records(ingest.parse_json_lines(df, keep_reason=True)).collect()}
    assert got == dict(zip(lines, ["bad_json", "unknown_record_type", "blank_line", "bad_json", "missing_field"]))
