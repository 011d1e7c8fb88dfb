"""Joins of quotes with trade-derived tables.

* ``quote_last_trade`` (J1): every quote with its symbol's day-last trade price
  and moving average (equi-join on trade_dt, symbol after reducing trades to
  one row per symbol and day).
* ``attach_prev_close`` (J2): inner join with the previous day's close on
  (trade_dt, symbol, exchange); ``attach_prev_close_broadcast`` (J4) broadcasts the
  close table if its measured bytes are few, and sorts and merges otherwise.
* ``asof_join`` (J3): for every left row, the latest right row of the same
  series at or before (or strictly before) its time.  Built as union + forward
  fill, split into time buckets so a hot symbol never sits in one task.
* ``same_time_join`` (J5): quotes with a same-time trade (semi join, no pairs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import SERIES_KEY
from ..session import materialize
from .windows import DEFAULT_SPLIT, Split, forward_fill


def quote_last_trade(quotes: DataFrame, day_last_trades: DataFrame) -> DataFrame:
    """Quotes ⋈ one-row-per-(trade_dt, symbol) day-last table."""
    return quotes.join(day_last_trades, ["trade_dt", "symbol"])


BROADCAST_BYTES = 64 << 20


def attach_prev_close(quotes: DataFrame, prev_close: DataFrame) -> DataFrame:
    """Inner join with the close re-keyed to the day it serves.  Quotes
    on an exchange without a previous close are dropped (inner join)."""
    return quotes.join(prev_close, ["trade_dt", "symbol", "exchange"])


def attach_prev_close_broadcast(quotes: DataFrame, prev_close: DataFrame,
                                most: int = BROADCAST_BYTES) -> DataFrame:
    """The join of ``attach_prev_close`` with the close table broadcast, if its
    measured size allows.  The reduced table (one row per day, symbol and exchange) is
    written once; its rows times their width are at most ``most`` bytes, or the join
    sorts and merges, so a large calendar of symbols never reaches one task whole."""
    written = materialize(prev_close)
    width = sum(36 if f.dataType == T.StringType() else 16 for f in written.schema)  # bytes of a row in memory
    size = written.count() * width
    side = F.broadcast(written) if size <= most else written.hint("merge")
    return quotes.join(side, ["trade_dt", "symbol", "exchange"])


def asof_join(left: DataFrame, right: DataFrame, values: Sequence[str],
              by: Sequence[str] = SERIES_KEY, time_col: str = "event_time",
              right_order: Sequence[str] = ("event_seq_num", "exchange"),
              outs: Sequence[str] | None = None, inclusive: bool = True,
              split: Split | None = DEFAULT_SPLIT) -> DataFrame:
    """Left rows with the ``values`` of the latest right row of the same ``by``
    group whose ``time_col`` is <= (``inclusive``) or < the left row's time.
    Left rows without such a right row get NULLs (left outer semantics).

    Among right rows at the same time the last by ``right_order`` wins.  The
    cost is one shuffle of left+right by (by, time bucket) plus a table of one
    row per group and bucket; it is linear, unlike an inequality join.
    """
    outs = list(outs or values)
    # Tie-break columns the right side does not have are skipped.
    right_order = [c for c in right_order if c in right.columns]
    # At equal time, inclusive puts right rows first so the left row sees them.
    r_rank, l_rank = (0, 1) if inclusive else (1, 0)
    order_cols = [f"_o{i}" for i in range(len(right_order))]
    lcols = left.columns
    l = left.select(
        *[F.col(c) for c in lcols],
        F.col(time_col).alias("_t"),
        F.lit(l_rank).alias("_side"),
        *[F.lit(None).cast(right.schema[o].dataType).alias(n) for o, n in zip(right_order, order_cols)],
    )
    r_struct = F.struct(*[F.col(v).alias(o) for v, o in zip(values, outs)])
    r = right.select(
        *[F.col(c) for c in by],
        F.col(time_col).alias("_t"),
        F.lit(r_rank).alias("_side"),
        *[F.col(o).alias(n) for o, n in zip(right_order, order_cols)],
        r_struct.alias("_r"),
    )
    l = l.withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType))
    u = l.unionByName(r, allowMissingColumns=True)
    filled = forward_fill(u, "_r", "_r", partition=list(by),
                          order=["_t", "_side", *order_cols], time_col="_t", split=split)
    res = filled.where(F.col("_side") == l_rank)
    return res.select(*[F.col(c) for c in lcols], *[F.col(f"_r.{o}").alias(o) for o in outs])


def same_time_join(quotes: DataFrame, trades: DataFrame) -> DataFrame:
    """Quotes that have a trade of the same symbol at the same event_time.

    The equality variant of the day-last join is followed by DISTINCT over the
    quote's columns, which collapses the (quote, trade) pairs; a left semi
    join against the distinct trade times gives the same rows without ever
    forming the pairs (a busy minute would otherwise fan out M x N).
    """
    times = trades.select("trade_dt", "symbol", "event_time").distinct()
    return quotes.join(times, ["trade_dt", "symbol", "event_time"], "left_semi")
