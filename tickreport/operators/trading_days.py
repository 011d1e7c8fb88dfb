"""Trading-day calendar: the days with trades, looked up as-of.

``trading_days`` has one row per day that traded.  ``previous_trading_day`` gives each
asked-for day the latest trading day before it, so Monday sees Friday, and a day
with quotes only takes no close away from the next one.  Both tables have one row
per date of the feed (a few thousand for decades), whatever the number of trades.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trading_days(trades: DataFrame) -> DataFrame:
    return trades.select("trade_dt").where("trade_dt IS NOT NULL").distinct()


def previous_trading_day(days: DataFrame, traded: DataFrame) -> DataFrame:
    """``days`` (trade_dt; distinct, null left out) and ``traded`` days: every one of
    both with ``prev_dt``, the latest of ``traded`` before it (null if there is none)."""
    own = traded.select("trade_dt", F.col("trade_dt").alias("_own"))
    listed = own.unionByName(days.select("trade_dt"), allowMissingColumns=True) \
        .where("trade_dt IS NOT NULL").groupBy("trade_dt").agg(F.max("_own").alias("_own"))
    before = Window.orderBy("trade_dt").rowsBetween(Window.unboundedPreceding, -1)
    return listed.select("trade_dt", F.last("_own", ignorenulls=True).over(before).alias("prev_dt"))
