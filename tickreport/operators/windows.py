"""Window operators over one (trade_dt, symbol) price series.

Each operator has two physical forms with identical results:

* ``split=None`` - one window partitioned by the series key.  One shuffle, but
  a hot symbol's whole day lands in one task.
* ``split=Split(...)`` (default) - the series is cut into ordered time buckets
  so that no task ever holds more than one bucket of one series (plus halo
  rows: n-1 rows for row frames).  Results stay exact: what crosses a bucket edge is carried
  by a small per-bucket table (one row per series and bucket), or by
  duplicating the boundary rows into the next bucket or chunk.

All orders are total (``SERIES_ORDER`` = event_time, event_seq_num, exchange),
so results never depend on the physical row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SERIES_KEY, SERIES_ORDER
from .ranges import ranged


@dataclass(frozen=True)
class Split:
    """How to cut a hot series.

    bucket_minutes: width of a time bucket for ranking, forward fill and the
      series tail; one task sees at most one bucket of one series.  The
      per-bucket tables have at most 24 * 60 / bucket_minutes rows per series
      and day, so fine buckets stay cheap.
    chunk_rows: rows per chunk for row-count frames (ranked series are cut
      into chunks of this many rows plus the frame's halo).
    by_range: rank and fill over ranges of the full order (``operators.ranges``)
      instead of time buckets.  Costs one written copy, and cuts a series anywhere,
      also inside one minute or one timestamp.
    """

    bucket_minutes: int = 5
    chunk_rows: int = 1 << 20
    by_range: bool = False


DEFAULT_SPLIT = Split()


def minute_index(c: Column) -> Column:
    """Whole minutes since 1970-01-01 of a wall-clock timestamp (no zone
    involved, non-decreasing in the timestamp)."""
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 1440 + F.hour(c) * 60 + F.minute(c)


def time_bucket(c: Column, minutes: int) -> Column:
    return F.floor(minute_index(c) / F.lit(minutes)).cast("bigint")


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet null keys, as rows of one window
    partition do; the result has the left side's key columns."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _w(partition: Sequence, order: Sequence):
    return Window.partitionBy(*partition).orderBy(*order)


# --------------------------------------------------------------------------
# Ranking a series (row number in the series' total order), split-safe.
# --------------------------------------------------------------------------

def series_rank(df: DataFrame, partition: Sequence[str] = SERIES_KEY,
                order: Sequence[str] = SERIES_ORDER, time_col: str = "event_time",
                split: Split | None = DEFAULT_SPLIT, out: str = "_rank") -> DataFrame:
    """Adds ``out`` = 1-based position of the row in its series."""
    if split is None:
        return df.withColumn(out, F.row_number().over(_w(partition, order)))
    if split.by_range:
        rows = ranged(df, [*partition, *order])
        local = rows.withColumn("_rn", F.row_number().over(_w([*partition, "_part"], ["_at"])))
        return _with_offsets(local, rows, partition, "_part", out).drop("_at")
    b = "_bucket"
    with_b = df.withColumn(b, time_bucket(F.col(time_col), split.bucket_minutes))
    local = with_b.withColumn("_rn", F.row_number().over(_w([*partition, b], order)))
    return _with_offsets(local, with_b, partition, b, out)


def _with_offsets(local: DataFrame, rows: DataFrame, partition: Sequence[str], b: str, out: str) -> DataFrame:
    """``out`` = ``_rn`` plus the rows of the series in earlier buckets ``b``.  The
    table of counts has one row per (series, bucket), its window one series' buckets."""
    counts = rows.groupBy(*partition, b).agg(F.count(F.lit(1)).alias("_n"))
    before = _w(partition, [b]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*partition, b, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ranked = join_same(local, offsets, [*partition, b])
    return ranked.withColumn(out, F.col("_off") + F.col("_rn")).drop("_rn", "_off", b)


# --------------------------------------------------------------------------
# Moving average over the last n rows.
# --------------------------------------------------------------------------

def moving_avg_rows(df: DataFrame, value: str = "trade_price", n: int = 3,
                    out: str = "avg_trade_price", partition: Sequence[str] = SERIES_KEY,
                    order: Sequence[str] = SERIES_ORDER, split: Split | None = DEFAULT_SPLIT
                    ) -> DataFrame:
    """``AVG(value)`` over the current row and the ``n-1`` rows before it."""
    if n < 1:
        raise ValueError("n must be >= 1")
    if split is None:
        return df.withColumn(out, F.avg(value).over(_w(partition, order).rowsBetween(-(n - 1), 0)))
    ranked = series_rank(df, partition, order, split=split, out="_rank")
    c = split.chunk_rows
    halo = n - 1
    pos = F.col("_rank") - 1
    chunk = F.floor(pos / F.lit(c)).cast("bigint")
    # Each row lives in its chunk and is also sent, as halo, to every later
    # chunk whose frames reach back to it (those starting within n-1 rows
    # after it), so every frame is complete inside one chunk.
    last_chunk = F.floor((pos + F.lit(halo)) / F.lit(c)).cast("bigint")
    spread = ranked.withColumn("_chunk", F.explode(F.sequence(chunk, last_chunk))).withColumn(
        "_halo", F.col("_chunk") != chunk)
    w = _w([*partition, "_chunk"], ["_rank"]).rowsBetween(-halo, 0)
    res = spread.withColumn(out, F.avg(value).over(w)).where(~F.col("_halo"))
    return res.drop("_chunk", "_halo", "_rank")


# --------------------------------------------------------------------------
# Moving average over a time range (true 30-minute window).
# --------------------------------------------------------------------------

def moving_avg_range(df: DataFrame, value: str = "trade_price", minutes: int = 30,
                     out: str = "avg_trade_price", partition: Sequence[str] = SERIES_KEY,
                     time_col: str = "event_time", split: Split | None = DEFAULT_SPLIT
                     ) -> DataFrame:
    """``AVG(value)`` over rows with time in ``[t - minutes, t]`` (RANGE frame:
    rows at the same time are peers and see each other)."""
    def frame(parts: Sequence[str]) -> Column:
        p = ", ".join(f"`{c}`" for c in parts)
        return F.expr(
            f"avg(`{value}`) over (partition by {p} order by `{time_col}` "
            f"range between interval {int(minutes)} minutes preceding and current row)")

    if split is None:
        return df.withColumn(out, frame(partition))
    # Buckets of the largest width that divides the frame, so the frame starts
    # ``back`` buckets before its row's: sum = the earlier bucket's rows from the
    # frame's start + the whole buckets in between + the own bucket's rows up to
    # the row.  Every part is a running sum: linear in the rows, no subtraction.
    width = next(w for w in range(min(split.bucket_minutes, minutes), 0, -1) if minutes % w == 0)
    back = minutes // width
    keys, t = list(partition), F.col(time_col)
    rows = df.withColumn("_b", time_bucket(t, width))
    upto = _w([*keys, "_b"], [time_col]).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_s", F.sum(value).over(upto)).withColumn("_n", F.count(value).over(upto))
    totals = df.groupBy(*keys, time_bucket(t, width).alias("_b")).agg(
        F.sum(value).alias("_bs"), F.count(value).alias("_bn"))
    between = _w(keys, ["_b"]).rangeBetween(-(back - 1), -1)
    if back > 1:
        middle = totals.where("_b IS NOT NULL").select(
            *keys, "_b", F.sum("_bs").over(between).alias("_ms"), F.sum("_bn").over(between).alias("_mn"))
        rows = join_same(rows, middle, [*keys, "_b"], "left")
    else:
        rows = rows.withColumn("_ms", F.lit(None).cast("double")).withColumn("_mn", F.lit(None).cast("bigint"))
    # A row asks its frame's first bucket at the frame's start; rows there at that
    # time or later come before it in descending order (peers included).
    asks = rows.withColumn("_t", t - F.expr(f"INTERVAL {int(minutes)} MINUTES")).withColumn("_b", F.col("_b") - back)
    asks = asks.withColumn("_v", F.lit(None).cast(df.schema[value].dataType)).withColumn("_ask", F.lit(True))
    there = df.where(t.isNotNull()).select(
        *keys, time_bucket(t, width).alias("_b"), t.alias("_t"), F.col(value).alias("_v"), F.lit(False).alias("_ask"))
    since = Window.partitionBy(*keys, "_b").orderBy(F.col("_t").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    both = asks.unionByName(there, allowMissingColumns=True).withColumn(
        "_ss", F.sum("_v").over(since)).withColumn("_sn", F.count("_v").over(since))
    parts = lambda *names: sum((F.coalesce(F.col(c), F.lit(0)) for c in names), F.lit(0))
    n = F.when(t.isNull(), F.col("_n")).otherwise(parts("_n", "_mn", "_sn"))
    total = F.when(t.isNull(), F.col("_s")).otherwise(parts("_s", "_ms", "_ss"))
    return both.where("_ask").withColumn(out, F.when(n > 0, total / n)).select(*df.columns, out)


def rows_avg_at_series_end(df: DataFrame, value: str = "trade_price", n: int = 3,
                           out: str = "avg_trade_price", partition: Sequence[str] = SERIES_KEY,
                           order: Sequence[str] = SERIES_ORDER, last: str | None = None) -> DataFrame:
    """W1 evaluated at the last row of each series: the average of its last
    ``n`` rows, and with ``last`` the last row's value under that name.

    ``row_number() <= n`` over the descending order is planned with a group
    limit below the shuffle: each task sends at most ``n`` rows of a series.
    """
    rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*[F.col(o).desc() for o in order]))
    tail = df.withColumn("_rk", rank).where(F.col("_rk") <= n)
    found = [F.avg(value).alias(out)]
    if last:
        found.append(F.max(F.when(F.col("_rk") == 1, F.col(value))).alias(last))
    return tail.groupBy(*partition).agg(*found)


def range_avg_at_series_end(df: DataFrame, value: str = "trade_price", minutes: int = 30,
                            out: str = "avg_trade_price", partition: Sequence[str] = SERIES_KEY,
                            time_col: str = "event_time") -> DataFrame:
    """W2 evaluated at the last row of each series, without a window.

    The last row's RANGE frame is every row within ``minutes`` of the series'
    latest time (its peers included), so: latest time per series (partial
    aggregate), join back, keep rows inside the frame, average (partial
    aggregate).  No task ever holds a whole series.
    """
    end = df.groupBy(*partition).agg(F.max(time_col).alias("_end"))
    inside = df.join(end, list(partition)).where(
        F.col(time_col) >= F.col("_end") - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    return inside.groupBy(*partition).agg(F.avg(value).alias(out))


# --------------------------------------------------------------------------
# Last value of the whole series, on every row.
# --------------------------------------------------------------------------

def last_value_per_series(df: DataFrame, values: Sequence[str], outs: Sequence[str] | None = None,
                          partition: Sequence[str] = SERIES_KEY, order: Sequence[str] = SERIES_ORDER
                          ) -> DataFrame:
    """Every row plus the series' last ``values`` (``LAST_VALUE`` over the
    unbounded frame).  Computed as a partial aggregate joined back, so no
    window ever sorts a whole series; AQE broadcasts the per-series table or
    splits a hot series' join partition."""
    outs = list(outs or [f"last_{v}" for v in values])
    last = df.groupBy(*partition).agg(
        F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    last = last.select(*partition, *[F.col(f"_last.{v}").alias(o) for v, o in zip(values, outs)])
    return join_same(df, last, list(partition), "left")


# --------------------------------------------------------------------------
# Forward fill (last non-null value up to the current row).
# --------------------------------------------------------------------------

def forward_fill(df: DataFrame, value: str, out: str | None = None,
                 partition: Sequence[str] = SERIES_KEY, order: Sequence[str] = SERIES_ORDER,
                 time_col: str = "event_time", split: Split | None = DEFAULT_SPLIT) -> DataFrame:
    """``out`` = last non-null ``value`` at or before each row of the series."""
    out = out or value
    if split is None:
        w = _w(partition, order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(w))
    b, columns = "_ffb", df.columns
    if split.by_range:
        with_b = ranged(df, [*partition, *order], part=b)
        order = ["_at"]
    else:
        with_b = df.withColumn(b, time_bucket(F.col(time_col), split.bucket_minutes))
    w_in = _w([*partition, b], order).rowsBetween(Window.unboundedPreceding, 0)
    local = with_b.withColumn("_local", F.last(value, ignorenulls=True).over(w_in))
    # Last non-null value of each bucket (one row per series and bucket; rows
    # with a null value get a null ordering and are ignored by max_by) ...
    per_bucket = with_b.groupBy(*partition, b).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_blast"))
    # ... carried into later buckets: the last non-null of all earlier buckets.
    carry = per_bucket.select(
        *partition, b,
        F.last("_blast", ignorenulls=True).over(
            _w(partition, [b]).rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    res = join_same(local, carry, [*partition, b], "left")
    return res.withColumn(out, F.coalesce(F.col("_local"), F.col("_carry"))).select(*dict.fromkeys([*columns, out]))
