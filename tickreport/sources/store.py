"""Table layout on storage: landing, daily and analytic areas.

Writes are partitioned by a column (never a job per value).  Reads filter on the
folder labels, so the scan lists and opens the asked-for folders only.

Landing: ``partition={T,Q,B}/day=YYYY-MM-DD/batch=<id>`` and a manifest of finished
batches (``_batches``: which record types and days a batch brought).  A batch that is
landed again under its id replaces its own folders, and readers see a batch once
its manifest row is written.  Corrected batches are marked in ``_corrected``, so a
correction can ask for the days touched since the last one.

Daily and analytic areas: one folder per day.  With ``days`` a write replaces
exactly those days, empty ones too: the new folders are staged first and then
moved into place, so a failure before that leaves everything as it was.
"""

from __future__ import annotations

import datetime as _dt
import os
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import folders

# Directory labels of the storage layout.
LANDING_DAY, LANDING_BATCH = "day", "batch"
MANIFEST, CORRECTED = "_batches", "_corrected"
DAILY_LABEL = "trade-dt"    # daily_data/{trade,quote}/trade-dt=YYYY-MM-DD
REPORT_LABEL = "date"       # analytic_data/date=YYYY-MM-DD


def _spread(df: DataFrame, partition_cols: Sequence[str], files_per_value: int | None) -> DataFrame:
    """Bound the file count.  Default: a rebalance on the partition columns, which
    adaptive execution merges where values are small and splits where one is hot.
    ``files_per_value``: that many tasks per value, chosen by a hash of the row."""
    if not files_per_value:
        return df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_cols])
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_value))
    return df.repartition(*[F.col(f"`{c}`") for c in partition_cols], bucket)


def _writer(df: DataFrame, partition_cols: Sequence[str], mode: str, files_per_value: int | None = None):
    w = _spread(df, partition_cols, files_per_value).write.mode(mode).partitionBy(*partition_cols)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    return w


def _day_list(days: Sequence) -> list[str]:
    return sorted({str(d) for d in days})


def _on_days(df: DataFrame, label: str, days: Sequence | None) -> DataFrame:
    if days is None:
        return df
    return df.where(F.col(f"`{label}`").cast("date").isin([F.lit(d).cast("date") for d in _day_list(days)]))


# ---------------------------------------------------------------- landing ---

def write_landing(events: DataFrame, path: str, mode: str = "append",
                  files_per_value: int | None = None, batch_id: str | None = None) -> str:
    """common_event into the landing area as one batch; returns the batch's id.

    ``append`` keeps earlier batches (the cleaning step keeps the latest version of
    an event); ``overwrite`` starts the area anew.  Landing a batch again under its
    id (``batch_id``; default: a new one) replaces it."""
    spark = events.sparkSession
    batch = batch_id or f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    if mode == "overwrite":
        folders.delete(spark, path)
    out = events.withColumn(LANDING_DAY, F.col("trade_dt")).withColumn(LANDING_BATCH, F.lit(batch))
    _writer(out, ["partition", LANDING_DAY, LANDING_BATCH], "overwrite", files_per_value).parquet(path)
    mine = f"{path}/partition=*/{LANDING_DAY}=*/{LANDING_BATCH}={batch}"
    if folders.matches(spark, mine):  # only this batch's folders are listed; no column is read
        rows = spark.read.option("basePath", path).parquet(mine).groupBy("partition", LANDING_DAY).agg(
            F.count(F.lit(1)).alias("n_rows"))
        rows = rows.withColumn(LANDING_DAY, F.col(LANDING_DAY).cast("date")).withColumn(LANDING_BATCH, F.lit(batch))
        _writer(rows, [LANDING_BATCH], "overwrite").parquet(f"{path}/{MANIFEST}")
    return batch


_MANIFEST_SCHEMA = T.StructType([T.StructField("partition", T.StringType()), T.StructField(LANDING_DAY, T.DateType()),
                                 T.StructField("n_rows", T.LongType()), T.StructField(LANDING_BATCH, T.StringType())])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Finished batches: partition, day, n_rows, batch."""
    if not folders.exists(spark, f"{path}/{MANIFEST}"):
        return spark.createDataFrame([], _MANIFEST_SCHEMA)
    return spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}")


def read_landing(spark: SparkSession, path: str, rec_type: str | None = None, dates: Sequence | None = None) -> DataFrame:
    """Finished batches of the landing area; ``rec_type`` and ``dates`` select folders."""
    df = spark.read.parquet(path)
    if rec_type is not None:
        df = df.where(F.col("partition") == F.lit(rec_type))
    if LANDING_BATCH not in df.columns:
        return df if dates is None else _on_days(df, "trade_dt", dates)
    df = _on_days(df, LANDING_DAY, dates).withColumn(LANDING_BATCH, F.col(LANDING_BATCH).cast("string"))
    done = read_manifest(spark, path).select(LANDING_BATCH).distinct()
    return df.join(done, LANDING_BATCH, "left_semi").drop(LANDING_DAY, LANDING_BATCH)


def pending_days(spark: SparkSession, path: str) -> tuple[list[_dt.date], list[str]]:
    """Days with trades or quotes landed since the last ``mark_corrected``, and the
    batches that brought them (one row per day and per batch reaches the driver)."""
    rows = read_manifest(spark, path)
    if folders.exists(spark, f"{path}/{CORRECTED}"):
        rows = rows.join(spark.read.schema(f"{LANDING_BATCH} string").parquet(f"{path}/{CORRECTED}").distinct(),
                         LANDING_BATCH, "left_anti")
    batches = [r[0] for r in rows.select(LANDING_BATCH).distinct().collect()]
    days = rows.where(F.col(LANDING_DAY).isNotNull()).select(LANDING_DAY).distinct().collect()
    return sorted(r[0] for r in days), sorted(batches)


def mark_corrected(spark: SparkSession, path: str, batches: Sequence[str]) -> None:
    if batches:
        spark.createDataFrame([(b,) for b in batches], f"{LANDING_BATCH} string").coalesce(1) \
            .write.mode("append").parquet(f"{path}/{CORRECTED}")


# --------------------------------------------------- daily and analytic areas ---

def replace_days(df: DataFrame, root: str, label: str, days: Sequence, files_per_value: int | None = None) -> None:
    """``root/<label>=day`` for exactly ``days`` from the rows of ``df`` on those
    days.  The folders are written aside, then each day's old folder is moved away and
    its new one (if there are rows) moved in: one rename a day, on stores that have
    renames.  A day without rows ends without a folder."""
    spark, wanted = df.sparkSession, _day_list(days)
    aside = os.path.join(root, f"_staging-{uuid.uuid4().hex}")
    _writer(_on_days(df, label, wanted), [label], "overwrite", files_per_value).parquet(f"{aside}/new")
    for day in wanted:
        folder = f"{label}={day}"
        if folders.exists(spark, f"{root}/{folder}"):
            folders.move(spark, f"{root}/{folder}", f"{aside}/old/{folder}")
        if folders.exists(spark, f"{aside}/new/{folder}"):
            folders.move(spark, f"{aside}/new/{folder}", f"{root}/{folder}")
    folders.delete(spark, aside)


def write_daily(df: DataFrame, root: str, mode: str = "overwrite", files_per_value: int | None = None,
                label: str = DAILY_LABEL, days: Sequence | None = None) -> None:
    """Clean trades or quotes → ``root/<label>=YYYY-MM-DD`` in one job.

    The directory label is a copy of ``trade_dt``, so the files keep their
    ``trade_dt`` column (readers of single day folders still see it).  ``days``:
    replace exactly these days; else the days that ``df`` holds."""
    out = df if label == "trade_dt" else df.withColumn(label, F.col("trade_dt"))
    if days is not None:
        replace_days(out, root, label, days, files_per_value)
    else:
        _writer(out, [label], mode, files_per_value).parquet(root)


def read_daily(spark: SparkSession, root: str, dates: list | None = None,
               label: str = DAILY_LABEL, schema: T.StructType | None = None) -> DataFrame:
    """Daily area; ``dates`` (strings or dates) filter the directory label, so
    only those day folders are listed and read.  With ``schema`` (without the label)
    an area without any day reads as empty."""
    reader = spark.read if schema is None else spark.read.schema(T.StructType(
        [*schema.fields, *([T.StructField(label, T.DateType())] if label not in schema.names else [])]))
    df = _on_days(reader.parquet(root), label, dates)
    if label != "trade_dt":
        df = df.drop(label)
    return df.withColumn("trade_dt", F.col("trade_dt").cast("date"))


def write_report(report: DataFrame, root: str, mode: str = "overwrite",
                 files_per_value: int | None = None, days: Sequence | None = None) -> None:
    """Quote report → ``root/date=YYYY-MM-DD`` (one folder per trade day); ``days``
    as in ``write_daily``."""
    out = report.withColumn(REPORT_LABEL, F.col("trade_dt"))
    if days is not None:
        replace_days(out, root, REPORT_LABEL, days, files_per_value)
    else:
        _writer(out, [REPORT_LABEL], mode, files_per_value).parquet(root)


def read_report(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop(REPORT_LABEL)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Named intermediate tables for SQL users (temporary views)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """JDBC table scan (driver jar and credentials come from the caller)."""
    return spark.read.jdbc(url, table, properties=properties or {})


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None) -> None:
    """JDBC write; overwrite truncates instead of dropping so keys and grants stay."""
    props = dict(properties or {})
    if mode == "overwrite":
        props.setdefault("truncate", "true")
    df.write.jdbc(url, table, mode=mode, properties=props)
