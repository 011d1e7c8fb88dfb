"""Skew check: largest per-task shuffle read, plain vs split plans.

Builds a trade table from ``lineitem`` in which a third of all rows belong to
one symbol (``HOT``), runs the row window, the range window and the as-of join
with and without splitting, and the latest-version step on a table where a
third of all rows are versions of one key (window baseline vs partial
aggregate), and reads Spark's event log (written to a fresh
scratch folder) for the largest number of shuffle records one task read.

Usage: python tools/skew_check.py [sf_dir]   (prints one JSON line)
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))


def hot_trades(spark, sf_dir):
    from pyspark.sql import functions as F
    li = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("l_orderkey") % 5).cast("int"))
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
    return li.select(
        day.alias("trade_dt"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("l_partkey") % 50).cast("string"))).alias("symbol"),
        F.concat(F.lit("X"), (F.col("l_suppkey") % 3).cast("string")).alias("exchange"),
        (day.cast("timestamp_ntz") + F.make_interval(secs=(F.col("l_orderkey") % 86400).cast("int"))).alias("event_time"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_seq_num"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("trade_price"),
    )


def max_task_records(log_dir: str) -> dict[str, int]:
    """job group -> largest shuffle-read record count of a single task."""
    stage_group, out = {}, {}
    # Spark 4 writes rolling logs: <dir>/eventlog_v2_<app>/events_<n>_<app>
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    group = stage_group.get(ev.get("Stage ID"))
                    if group:
                        out[group] = max(out.get(group, 0), recs)
    return out


def main() -> None:
    from pyspark.sql import functions as F
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tickreport-eventlog-")
    from tickreport.session import build_session
    from tickreport.operators import joins as JN
    from tickreport.operators import windows as W
    from tickreport.operators.clean import latest_version
    # Many shuffle partitions, as on a cluster: the largest task is then set
    # by the largest group a plan keeps together, not by the partition count.
    spark = build_session("local[8]", 200, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        # Keep the planned shuffle partitions so each task's input is visible.
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    trades = hot_trades(spark, sf_dir)
    quotes = trades.select("trade_dt", "symbol", "exchange",
                           (F.col("event_time") + F.expr("INTERVAL 1 SECOND")).alias("event_time"),
                           "event_seq_num")
    n = trades.count()
    hot = trades.where("symbol = 'HOT'").groupBy("trade_dt").count().agg(F.max("count")).first()[0]
    # Versions: a third of all lineitem rows become versions of one key.
    li = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet"))
    hot_key = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
    versions = li.withColumn("_hot", hot_key).select(
        *[F.when(F.col("_hot"), F.lit(-1).cast("bigint")).otherwise(F.col(c)).alias(c) if c == "l_orderkey"
          else F.when(F.col("_hot"), F.lit(1)).otherwise(F.col(c)).alias(c) if c == "l_linenumber"
          else F.col(c) for c in li.columns])
    key, order = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    payload = [c for c in li.columns if c not in key]

    def dedup(sp):
        # Baseline ("plain"): the same row_number() = 1 without Spark's
        # partial group limit, i.e. every version of a key in one task.
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1" if sp is None else "1000")
        return latest_version(versions, key, payload, order)

    cases = {
        "latest_version": dedup,
        "moving_avg_rows": lambda sp: W.moving_avg_rows(trades, split=sp),
        "moving_avg_range": lambda sp: W.moving_avg_range(trades, split=sp),
        "asof_join": lambda sp: JN.asof_join(quotes, trades, ["trade_price"], split=sp),
    }
    runs = {}
    for name, build in cases.items():
        for label, sp in (("plain", None), ("split", W.Split(chunk_rows=5000))):
            group = f"{name}/{label}"
            spark.sparkContext.setJobGroup(group, group)
            t0 = time.perf_counter()
            build(sp).write.format("noop").mode("overwrite").save()
            runs[group] = {"sec": round(time.perf_counter() - t0, 3)}
    spark.stop()
    for group, recs in max_task_records(log_dir).items():
        runs.setdefault(group, {})["max_task_shuffle_records"] = recs
    print(json.dumps({"rows": n, "largest_hot_series_rows": hot, "runs": runs}))


if __name__ == "__main__":
    main()
