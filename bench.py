"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (the whole plan
executes, nothing is collected on the driver); the time is the best of
$BENCH_REPEAT (default 2) runs after an untimed warm-up on the smallest
tables.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "ingest_csv",
    "dedup_lineitem",
    "moving_avg_rows",
    "moving_avg_30m",
    "quote_asof_trade",
    "quote_report",
    "quote_report_asof",
    "quote_union",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tickreport.session import build_session
    from tickreport.plans.registry import QUERIES

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(cpus, 1) * 2)))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=parts,
                          app_name="tickreport-bench", extra={"spark.driver.memory": "16g"})
    # Warm the JVM, the parquet reader and the generated-code cache with the
    # same query shapes on the smallest tables (not timed).
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in HEADLINE:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times, rows = {}, {}
    for _ in range(repeat):
        for name in HEADLINE:
            # Build + run: some plans materialise an intermediate while building.
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            sec = round(time.perf_counter() - t0, 3)
            times[name] = min(sec, times.get(name, sec))
    for name in HEADLINE:
        rows[name] = QUERIES[name](spark, sf_dir).count()
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
