"""Last-of-day values: day-last trade and closing price.

Both are ``max_by`` aggregates over the series' total order: partial
aggregation on every map task, one small row per (trade_dt, symbol) after the
shuffle.  No window sorts a whole day of a symbol.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SERIES_KEY, SERIES_ORDER
from .trading_days import previous_trading_day, trading_days


def day_last(df: DataFrame, values: Sequence[str], outs: Sequence[str] | None = None,
             partition: Sequence[str] = SERIES_KEY, order: Sequence[str] = SERIES_ORDER) -> DataFrame:
    """A5: one row per series with the ``values`` of its last row."""
    outs = list(outs or values)
    agg = df.groupBy(*partition).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    return agg.select(*partition, *[F.col(f"_last.{v}").alias(o) for v, o in zip(values, outs)])


def close_per_venue(close: DataFrame, trades: DataFrame) -> DataFrame:
    """Replicate a per-symbol close (trade_dt, symbol, close_price) to every
    exchange the symbol traded on that day."""
    venues = trades.select("trade_dt", "symbol", "exchange").distinct()
    return venues.join(close, ["trade_dt", "symbol"]).select("trade_dt", "symbol", "exchange", "close_price")


def day_close(trades: DataFrame, rows: int = 3) -> DataFrame:
    """Per (trade_dt, symbol): the last trade price and the last ``rows``-row
    moving average (the value W1 has on the day's last trade), both from the
    series' last ``rows`` rows: one scan, one shuffle of a few rows per task."""
    from .windows import rows_avg_at_series_end
    return rows_avg_at_series_end(trades, "trade_price", rows, "last_avg_trade_price", last="last_trade_price") \
        .select("trade_dt", "symbol", "last_trade_price", "last_avg_trade_price")


def with_next_day(df: DataFrame, prev_trading_day: bool = False, days: DataFrame | None = None,
                  out: str = "_next") -> DataFrame:
    """Every row with the day(s) ``out`` it is the *previous* day for.

    Default: the next calendar day.  With ``prev_trading_day`` a day serves every
    day of ``days`` (one column ``trade_dt``) up to and including the next day
    that ``df`` has, so Monday sees Friday's rows, and so does a day without
    trades of its own in between; a day that serves none has a null ``out``.
    The list of days has one row per date.
    """
    if not prev_trading_day:
        return df.withColumn(out, F.date_add(F.col("trade_dt"), 1))
    if days is None:
        raise ValueError("prev_trading_day needs the table of days")
    served = previous_trading_day(days, trading_days(df)).where("prev_dt IS NOT NULL").select(
        F.col("trade_dt").alias(out), F.col("prev_dt").alias("trade_dt"))
    return df.join(served, "trade_dt", "left")


def shift_to_next_day(close: DataFrame, prev_trading_day: bool = False,
                      days: DataFrame | None = None) -> DataFrame:
    """Re-key a close table to the day(s) it is the previous close for."""
    tagged = with_next_day(close, prev_trading_day, days)
    return tagged.where("_next IS NOT NULL").withColumn("trade_dt", F.col("_next")).drop("_next")
