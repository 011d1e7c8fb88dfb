"""Plan shape of the registered queries: no cross joins anywhere, filters and
column pruning reach the scan."""

import os

import pytest

from tickreport.plans import registry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_no_cross_joins(spark):
    for name, fn in sorted(registry.QUERIES.items()):
        plan = _plan(fn(spark, SF))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_report_scan_is_filtered_and_pruned(spark):
    plan = _plan(registry.QUERIES["quote_report"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan
    # The trade side never reads props (trade size is not reported).
    trade_scans = [line for line in plan.split("\n") if "EqualTo(event_type,purchase)" in line]
    assert trade_scans and all("props" not in line for line in trade_scans)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_report_reads_and_shuffles_little(spark):
    """Trades are read for the tail and for the venues, quotes once; the quotes meet one joined table."""
    plan = _plan(registry.QUERIES["quote_report"](spark, SF))
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("EqualTo(event_type,purchase)") <= 3 and initial.count("EqualTo(event_type,view)") == 1
    assert "REPARTITION" not in plan and "RoundRobin" not in plan


def test_range_average_has_no_sliding_frame(spark):
    from tickreport.operators.windows import moving_avg_range
    df = spark.createDataFrame([], "trade_dt date, symbol string, event_time timestamp_ntz, trade_price double")
    plan = _plan(moving_avg_range(df))
    assert "RangeFrame, -INTERVAL" not in plan and "PRECEDING, CURRENT ROW" not in plan.replace("UNBOUNDED PRECEDING", "")


def test_new_ids_are_not_numbered_in_one_task(spark):
    from tickreport.operators.jobs import assign_job_ids, seed_tracker
    names = spark.range(100_000).selectExpr("concat('job', id) as job_name")
    out = assign_job_ids(seed_tracker(spark), names)
    rows = out.where("is_new").orderBy("job_name").collect()
    assert [r["job_id"] for r in rows] == list(range(4, 4 + len(rows))) and len(rows) == 100_000 - 3
    # Names are dealt by range and written before they are numbered; no window is without partitions but
    # the one over the ranges' sizes (one row per range).
    windows = [line for line in _plan(out).split("\n") if "Window [" in line]
    assert all("job_name" not in line for line in windows)


def test_overlap_reduces_each_side_first(spark):
    from tickreport.operators.setops import exchange_overlap
    df = spark.createDataFrame([("a",)], "exchange string")
    plan = _plan(exchange_overlap(df, df.where("exchange > ''")))
    assert plan.split("== Initial Plan ==")[-1].count("HashAggregate") >= 4
