"""Set operations: the trade/quote union on a common schema, exchange overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import QUOTE_UNION


def _to_union_schema(df: DataFrame) -> DataFrame:
    cols = []
    for f in QUOTE_UNION.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def quote_union(trades_with_avg: DataFrame, quotes: DataFrame, avg_col: str = "avg_trade_price",
                distinct: bool = True, dates: list | None = None) -> DataFrame:
    """Trades (with moving average) and quotes on one 12-column schema.

    Trades carry ``rec_type='T'``, price and moving average and NULL quote
    fields (their sequence number too); quotes carry ``rec_type='Q'`` and NULL
    trade fields.  ``distinct`` gives SQL ``UNION`` semantics; ``dates``
    restricts both sides to those trade days.
    """
    if dates is not None:
        days = [F.lit(str(d)).cast("date") for d in dates]
        trades_with_avg = trades_with_avg.where(F.col("trade_dt").isin(days))
        quotes = quotes.where(F.col("trade_dt").isin(days))
    t = _to_union_schema(trades_with_avg.select(
        "trade_dt", F.lit("T").alias("rec_type"), "symbol", "event_time", "exchange",
        "trade_price", F.col(avg_col).alias("mov_avg_pr")))
    q = _to_union_schema(quotes.select(
        "trade_dt", F.lit("Q").alias("rec_type"), "symbol", "event_time", "event_seq_num",
        "exchange", "bid_price", "bid_size", "ask_price", "ask_size"))
    u = t.unionByName(q)
    return u.distinct() if distinct else u


def exchange_overlap(trades: DataFrame, quotes: DataFrame) -> DataFrame:
    """Exchanges present in both trades and quotes (each side reduced first,
    so the join sees a row per exchange)."""
    return trades.select("exchange").distinct().intersect(quotes.select("exchange").distinct())
