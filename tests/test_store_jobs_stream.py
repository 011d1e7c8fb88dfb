"""Storage layout, idempotent rewrites, job table, streaming ingest."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from conftest import SAMPLE
from tickreport.operators.jobs import apply_status_updates, assign_job_ids, job_status, seed_tracker
from tickreport.plans import daily_job
from tickreport.sources.store import read_daily, read_landing, write_daily, write_landing
from tickreport.sources.ingest import parse_csv_lines, read_lines
from tickreport.streaming.ingest_stream import start_landing_stream


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landing_layout_and_pruning(spark, tmp):
    ev = parse_csv_lines(read_lines(spark, SAMPLE))
    path = os.path.join(tmp, "landing")
    write_landing(ev, path, mode="overwrite")
    assert sorted(d for d in os.listdir(path) if d.startswith("partition=")) == [
        "partition=B", "partition=Q", "partition=T"]
    t = read_landing(spark, path, "T")
    assert t.count() == 30
    plan = _plan(t)
    assert "PartitionFilters: [isnotnull(partition" in plan and "= T)" in plan


def test_daily_dynamic_overwrite_is_idempotent(spark, tmp):
    root = os.path.join(tmp, "daily_data")
    daily_job.land(spark, SAMPLE, tmp)
    daily_job.correct(spark, tmp)
    assert os.path.isdir(os.path.join(tmp, "output_partitions", "partition=B"))
    trade_root = os.path.join(root, "trade")
    assert sorted(os.listdir(trade_root))[-2:] == ["trade-dt=2021-01-01", "trade-dt=2021-01-02"]
    # A single day folder still carries its trade_dt column.
    one_day = spark.read.parquet(os.path.join(trade_root, "trade-dt=2021-01-01"))
    assert "trade_dt" in one_day.columns and one_day.count() == 15
    # Rewrite only day 2 with one row: day 1 stays, day 2 is replaced.
    one = read_daily(spark, trade_root, ["2021-01-02"]).limit(1)
    one = spark.createDataFrame(one.collect(), one.schema)
    write_daily(one, trade_root)
    again = read_daily(spark, trade_root)
    counts = {str(r[0]): r[1] for r in again.groupBy("trade_dt").count().collect()}
    assert counts == {"2021-01-01": 15, "2021-01-02": 1}
    sliced = read_daily(spark, trade_root, ["2021-01-01"])
    assert "PartitionFilters" in _plan(sliced) and sliced.count() == 15


def test_daily_job_end_to_end(spark, tmp):
    out = daily_job.run_all(spark, SAMPLE, tmp, dates=["2021-01-02"])
    rep = spark.read.parquet(out)
    assert rep.count() == 10
    assert os.path.isdir(os.path.join(out, "date=2021-01-02"))
    # A second landing of the same file (a rerun) must not change the result:
    # versions collapse in the cleaning step, the report overwrites its day.
    daily_job.land(spark, SAMPLE, tmp)
    daily_job.correct(spark, tmp)
    out = daily_job.report(spark, tmp, dates=["2021-01-02"])
    assert spark.read.parquet(out).count() == 10


def test_jobs(spark):
    tracker = seed_tracker(spark)
    names = spark.createDataFrame([("job2",), ("zeta",), ("alpha",)], "job_name string")
    ids = {r["job_name"]: (r["job_id"], r["is_new"]) for r in assign_job_ids(tracker, names).collect()}
    assert ids == {"job2": (2, False), "alpha": (4, True), "zeta": (5, True)}
    upd = spark.createDataFrame(
        [("job2", "failed", dt.datetime(2021, 1, 22), 1), ("job2", "success", dt.datetime(2021, 1, 22), 2),
         ("new", "success", dt.datetime(2021, 1, 23), 3)],
        "job_name string, status string, updated_time timestamp_ntz, _seq bigint")
    state = apply_status_updates(tracker, upd)
    got = {r["job_name"]: (r["job_id"], r["status"]) for r in state.collect()}
    assert got == {"job1": (1, "ok"), "job2": (2, "success"), "job3": (3, "ok"), "new": (4, "success")}
    assert [r["status"] for r in job_status(state, 2).collect()] == ["success"]
    assert job_status(state, 99).count() == 0
    empty = spark.createDataFrame([], tracker.schema)
    assert [r["job_id"] for r in assign_job_ids(empty, names).orderBy("job_name").collect()] == [1, 2, 3]


def test_streaming_landing(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    landing = os.path.join(tmp, "landing")
    ckpt = os.path.join(tmp, "ckpt")
    shutil.copy(SAMPLE, os.path.join(src, "part1.csv"))
    q = start_landing_stream(spark, src, landing, ckpt)
    q.awaitTermination(120)
    assert read_landing(spark, landing, "T").count() == 30
    # A new file is picked up once; old files are not re-read.
    with open(os.path.join(src, "part2.csv"), "w") as f:
        f.write("2021-01-03,T,Symbol1,1,2021-01-03 12:00,1,Exchange1,60.0,10\n")
    q = start_landing_stream(spark, src, landing, ckpt)
    q.awaitTermination(120)
    df = read_landing(spark, landing)
    assert df.where("partition = 'T'").count() == 31 and df.where("partition = 'B'").count() == 6
    assert df.where(F.col("arrival_time").isNull() & (F.col("partition") != "B")).count() == 0


def test_daily_job_records_stage_status(spark, tmp):
    import pytest
    from tickreport.operators.jobs import read_state
    log = os.path.join(tmp, "runlog")
    daily_job.run_all(spark, SAMPLE, tmp, dates=["2021-01-02"], run_log=log)
    state = {r["job_name"]: (r["job_id"], r["status"]) for r in read_state(spark, log).collect()}
    assert {k: v[1] for k, v in state.items() if not k.startswith("job")} == {
        "extract_csv": "success", "clean_trade": "success", "clean_quote": "success", "transform": "success"}
    assert sorted(v[0] for k, v in state.items() if not k.startswith("job")) == [4, 5, 6, 7]
    with pytest.raises(Exception):
        daily_job.land(spark, os.path.join(tmp, "missing.csv"), tmp, run_log=log)
    assert {r["job_name"]: r["status"] for r in read_state(spark, log).collect()}["extract_csv"] == "failed"


def test_report_reads_only_needed_days(spark, tmp):
    daily_job.land(spark, SAMPLE, tmp)
    daily_job.correct(spark, tmp)
    from tickreport.operators.clean import clean_trades
    trades = read_daily(spark, os.path.join(tmp, "daily_data", "trade"), ["2021-01-01"])
    assert "PartitionFilters: [isnotnull(trade-dt" in _plan(trades)
    # A table without feed positions still cleans (arrival_time orders versions).
    assert clean_trades(trades.drop("ingest_seq")).count() == 15
    out = daily_job.report(spark, tmp, dates=["2021-01-02"])
    assert spark.read.parquet(out).count() == 10


def test_streaming_landing_json(spark, tmp):
    import json as _json
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    rec = {"trade_date": "2021-01-01", "record_type": "T", "symbol": "S", "executionid": "1",
           "event_time": "2021-01-01 12:00", "event_seq_num": "1", "exchange": "E",
           "trade_price": "10.5", "trade_size": 3}
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(_json.dumps(rec) + "\n" + '{"broken": ' + "\n")
    landing = os.path.join(tmp, "landing")
    q = start_landing_stream(spark, src, landing, os.path.join(tmp, "ckpt"), fmt="json")
    q.awaitTermination(120)
    df = read_landing(spark, landing)
    assert {r["partition"]: r["n"] for r in df.groupBy("partition").agg(F.count("*").alias("n")).collect()} == {
        "T": 1, "B": 1}
    assert df.where("partition = 'T'").first()["trade_price"] == 10.5


def test_correct_and_report_for_given_days(spark, tmp):
    daily_job.land(spark, SAMPLE, tmp)
    daily_job.correct(spark, tmp, dates=["2021-01-01"])
    trades = os.path.join(tmp, "daily_data", "trade")
    assert sorted(x for x in os.listdir(trades) if "=" in x) == ["trade-dt=2021-01-01"]
    daily_job.correct(spark, tmp, dates=["2021-01-02"])
    assert daily_job._needed_trade_days(spark, trades, ["2021-01-05"], True) == [dt.date(2021, 1, 2), dt.date(2021, 1, 5)]
    out = daily_job.report(spark, tmp, dates=["2021-01-02"], prev_trading_day=True)
    assert spark.read.parquet(out).count() == 10
    files = [f for f in os.listdir(os.path.join(trades, "trade-dt=2021-01-01")) if f.endswith(".parquet")]
    assert len(files) == 1  # rebalanced: one file per small day
