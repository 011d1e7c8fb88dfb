"""End-of-day job over files: ingest → landing → clean → daily → report.

Plain function calls in dependency order (no scheduler).  Each step reads
what the previous one wrote, so a failed step can be rerun alone, and every
write replaces only the days it produces (dynamic partition overwrite).
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import clean_quotes, clean_trades
from ..operators.jobs import tracked
from ..operators.trading_days import previous_trading_day, trading_days
from ..schema import COMMON_EVENT, QUOTE, QUOTE_COLUMNS, TRADE, TRADE_COLUMNS
from ..sources.ingest import ingest_csv, ingest_json
from ..sources.store import (DAILY_LABEL, mark_corrected, pending_days, read_daily, read_landing, write_daily,
                             write_landing, write_report)
from .report import quote_report, quote_report_asof

# Folder names of the storage layout under ``root``.
LANDING_DIR = "output_partitions"
DAILY_DIR = "daily_data"
ANALYTIC_DIR = "analytic_data"


def _columns(names: Sequence[str]) -> T.StructType:
    return T.StructType([COMMON_EVENT[n] for n in names])


def land(spark: SparkSession, source: str | list[str], root: str, fmt: str = "csv",
         mode: str = "append", arrival_time: Column | None = None,
         conf: dict | None = None, run_log: str | None = None, batch_id: str | None = None) -> str:
    """One batch of files into the landing area; a batch landed again under its
    ``batch_id`` replaces itself."""
    with tracked(spark, run_log, f"extract_{fmt}"):
        reader = ingest_csv if fmt == "csv" else ingest_json
        events = reader(spark, source, arrival_time=arrival_time, conf=conf)
        path = os.path.join(root, LANDING_DIR)
        write_landing(events, path, mode, batch_id=batch_id)
    return path


def correct(spark: SparkSession, root: str, run_log: str | None = None,
            dates: Sequence | None = None, pending: bool = False) -> tuple[str, str]:
    """Clean tables from everything landed, or only for ``dates``: the other days'
    landing folders are not opened, and exactly the asked-for days are replaced
    (a day whose rows are gone ends empty).  ``pending``: the days that batches have
    touched since the last such run."""
    landing = os.path.join(root, LANDING_DIR)
    batches: list[str] = []
    if pending:
        dates, batches = pending_days(spark, landing)
    roots = []
    for rec_type, clean, name in ((TRADE, clean_trades, "trade"), (QUOTE, clean_quotes, "quote")):
        roots.append(os.path.join(root, DAILY_DIR, name))
        with tracked(spark, run_log, f"clean_{name}"):
            write_daily(clean(read_landing(spark, landing, rec_type, dates)), roots[-1], days=dates)
    mark_corrected(spark, landing, batches)
    return roots[0], roots[1]


def _needed_trade_days(spark: SparkSession, trade_root: str, dates: Sequence, prev_trading_day: bool) -> list:
    """The report days and the day before each: by the calendar, or by the trading
    days that have a folder (``operators.trading_days``; a few rows reach the driver)."""
    days = [_dt.date.fromisoformat(str(d)) for d in dates]
    if not prev_trading_day:
        return sorted(set(days) | {d - _dt.timedelta(days=1) for d in days})
    listed = spark.read.parquet(trade_root).select(F.col(f"`{DAILY_LABEL}`").cast("date").alias("trade_dt"))
    asked = spark.createDataFrame([(d,) for d in days], "trade_dt date")
    before = previous_trading_day(asked, trading_days(listed)).where(F.col("trade_dt").isin(days)) \
        .where("prev_dt IS NOT NULL").collect()
    return sorted(set(days) | {r["prev_dt"] for r in before})


def report(spark: SparkSession, root: str, dates: Sequence | None = None, asof: bool = False,
           run_log: str | None = None, **kwargs) -> str:
    out = os.path.join(root, ANALYTIC_DIR + ("_asof" if asof else ""))
    with tracked(spark, run_log, "transform"):
        # Only the needed day folders are read: the report days and, for the close, the day before.
        trade_root, trade_days = os.path.join(root, DAILY_DIR, "trade"), None
        if dates is not None:
            trade_days = _needed_trade_days(spark, trade_root, dates, bool(kwargs.get("prev_trading_day")))
        trades = read_daily(spark, trade_root, trade_days, schema=_columns(TRADE_COLUMNS))
        quotes = read_daily(spark, os.path.join(root, DAILY_DIR, "quote"), dates, schema=_columns(QUOTE_COLUMNS))
        build = quote_report_asof if asof else quote_report
        write_report(build(trades, quotes, dates, **kwargs), out, days=dates)
    return out


def run_all(spark: SparkSession, source: str | list[str], root: str, fmt: str = "csv",
            dates: Sequence | None = None, asof: bool = False, run_log: str | None = None) -> str:
    """All stages in order; with ``run_log`` every stage appends its status
    (``success`` / ``failed``) and a failure stops the run."""
    land(spark, source, root, fmt, run_log=run_log)
    correct(spark, root, run_log=run_log)
    return report(spark, root, dates, asof, run_log=run_log)
