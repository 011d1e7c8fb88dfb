"""Keyed status table as data: id assignment, upsert, lookup.

The table is never rewritten in place (a job cannot overwrite the path it
reads).  Updates are appended to a run log; the current state is a view that
keeps the latest update per key.  All steps are set-based, so any number of
names and updates are handled in one pass.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import JOB_TRACKER
from .ranges import numbered

# Initial rows of the tracker table.
SEED_ROWS = [
    (1, "job1", "ok", _dt.datetime(2021, 1, 21, 12, 0, 0)),
    (2, "job2", "ok", _dt.datetime(2021, 1, 21, 12, 10, 0)),
    (3, "job3", "ok", _dt.datetime(2021, 1, 21, 12, 30, 0)),
]


def seed_tracker(spark: SparkSession) -> DataFrame:
    """K4: the tracker table's initial content."""
    return spark.createDataFrame(SEED_ROWS, JOB_TRACKER)


def assign_job_ids(tracker: DataFrame, names: DataFrame) -> DataFrame:
    """K1: ``job_id`` for every name in ``names`` (column ``job_name``).

    A known name keeps its id; new names get max(id)+1, +2, ... in name order
    (an empty tracker starts at 1).  Output: job_name, job_id, is_new.
    """
    known = tracker.select("job_name", "job_id")
    wanted = names.select("job_name").distinct()
    old = wanted.join(known, "job_name").select("job_name", "job_id", F.lit(False).alias("is_new"))
    new = wanted.join(known, "job_name", "left_anti")
    # Ids are dense and in name order: names are dealt by range, written once and
    # numbered from that copy, so the ids can't depend on how often a plan samples.
    highest = known.agg(F.coalesce(F.max("job_id"), F.lit(0))).first()[0]
    fresh = numbered(new.select("job_name"), ["job_name"]).select(
        "job_name", (F.col("_pos") + F.lit(highest + 1)).cast("bigint").alias("job_id"), F.lit(True).alias("is_new"))
    return old.unionByName(fresh)


def upsert_latest(current: DataFrame, updates: DataFrame, key: str = "job_name",
                  order: tuple[str, ...] = ("updated_time", "_seq")) -> DataFrame:
    """K2: current state ∪ updates, latest per key (by ``order``); the
    current rows rank below any update with the same time."""
    cur = current.withColumn("_seq", F.lit(-1).cast("bigint"))
    upd = updates if "_seq" in updates.columns else updates.withColumn("_seq", F.lit(0).cast("bigint"))
    both = cur.unionByName(upd, allowMissingColumns=True)
    payload = [c for c in both.columns if c not in (key, "_seq")]
    latest = both.groupBy(key).agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_l"))
    return latest.select(key, *[F.col(f"_l.{c}").alias(c) for c in payload])


def apply_status_updates(tracker: DataFrame, updates: DataFrame) -> DataFrame:
    """Tracker state after a batch of status updates.

    ``updates``: job_name, status, updated_time and an optional ``_seq``
    tie-break.  New names get ids (K1); every name ends with its latest status.
    """
    ids = assign_job_ids(tracker, updates.select("job_name"))
    upd = updates.join(ids.select("job_name", "job_id"), "job_name")
    state = upsert_latest(tracker, upd)
    return state.select("job_id", "job_name", "status", "updated_time")


def job_status(state: DataFrame, job_id: int) -> DataFrame:
    """K3: status of one job id (empty when unknown)."""
    return state.where(F.col("job_id") == F.lit(job_id)).select("job_id", "status")


def append_run_log(updates: DataFrame, path: str) -> None:
    """Durable form of K2: append the updates; the state is ``read_state``."""
    updates.write.mode("append").parquet(path)


def read_state(spark: SparkSession, log_path: str) -> DataFrame:
    log = spark.read.parquet(log_path)
    return apply_status_updates(seed_tracker(spark), log)


def record_status(spark: SparkSession, log_path: str, job_name: str, status: str) -> None:
    """Append one status update (K2) to the run log; the current state of
    every job is ``read_state``.  The time is the driver's wall clock."""
    now = _dt.datetime.now()
    row = spark.createDataFrame(
        [(job_name, status, now, time.time_ns())],
        "job_name string, status string, updated_time timestamp_ntz, _seq bigint")
    append_run_log(row, log_path)


class tracked:
    """``with tracked(spark, log, "extract_csv"): ...`` records ``success``
    when the block finishes and ``failed`` (then re-raises) when it fails."""

    def __init__(self, spark: SparkSession, log_path: str | None, job_name: str):
        self.spark, self.log_path, self.job_name = spark, log_path, job_name

    def __enter__(self):
        return self

    def __exit__(self, exc_type, exc, tb):
        if self.log_path:
            record_status(self.spark, self.log_path, self.job_name, "failed" if exc_type else "success")
        return False
