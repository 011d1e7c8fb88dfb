"""Trade/quote feeds derived from the generic driver tables.

The benchmark tables carry no market data, so the model is mapped onto them
(every step a Spark projection, so work grows with the tables):

* ``events``: ``purchase`` rows are trades, ``view`` rows are quotes, other
  types are unusable records.  symbol = 'S' || user_id % 10, exchange =
  'X' || user_id % 3, event_time = ts, event_seq_num = event_id,
  k = props.k; trade price/size = value/k; quote bid = value/k, ask =
  value + k/100 and 100 - k.
* text feeds: the same events rendered as comma-separated or JSON lines
  (event time cut to minutes), plus malformed lines from the other types.
* ``lineitem``: versioned records keyed by (l_orderkey, l_linenumber).
* ``orders``: job status updates (name = o_orderpriority, status =
  o_orderstatus, time = o_orderdate, tie-break o_orderkey).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import QUOTE_COLUMNS, TRADE_COLUMNS

# Fixed value: arrival stamp injected into text ingests so results are
# reproducible (the live default is the current time).
FIXED_ARRIVAL = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its splits follow the session's file settings."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fixed_arrival() -> Column:
    return F.lit(FIXED_ARRIVAL).cast("timestamp_ntz")


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("bigint")


def _symbol() -> Column:
    return F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string"))


def _exchange() -> Column:
    return F.concat(F.lit("X"), (F.col("user_id") % 3).cast("string"))


def trades_from_events(events: DataFrame) -> DataFrame:
    """Trade table (clean-trade columns); arrival_time = ts."""
    return events.where(F.col("event_type") == "purchase").select(
        F.col("ts").alias("arrival_time"),
        F.col("ts").cast("date").alias("trade_dt"),
        _symbol().alias("symbol"),
        _exchange().alias("exchange"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("event_seq_num"),
        F.col("value").alias("trade_price"),
        _k().alias("trade_size"),
    ).select(*TRADE_COLUMNS)


def quotes_from_events(events: DataFrame) -> DataFrame:
    """Quote table (clean-quote columns); arrival_time = ts."""
    k = _k()
    return events.where(F.col("event_type") == "view").select(
        F.col("ts").alias("arrival_time"),
        F.col("ts").cast("date").alias("trade_dt"),
        _symbol().alias("symbol"),
        _exchange().alias("exchange"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("event_seq_num"),
        F.col("value").alias("bid_price"),
        k.alias("bid_size"),
        (F.col("value") + k / F.lit(100.0)).alias("ask_price"),
        (F.lit(100) - k).alias("ask_size"),
    ).select(*QUOTE_COLUMNS)


def _text_parts():
    d = F.date_format("ts", "yyyy-MM-dd")
    tmin = F.date_format("ts", "yyyy-MM-dd HH:mm")
    eid = F.col("event_id").cast("string")
    k = _k()
    ks = k.cast("string")
    price = F.col("value").cast("string")
    ask = (F.col("value") + k / F.lit(100.0)).cast("string")
    return d, tmin, eid, k, ks, price, ask


def csv_lines_from_events(events: DataFrame) -> DataFrame:
    """One comma-separated line per event (``value``) with its feed position
    (``ingest_seq``).  purchase → trade line, view → quote line, click →
    unknown record type, error → trade line missing fields, signup → quote
    line with a non-numeric sequence number."""
    d, tmin, eid, k, ks, price, ask = _text_parts()
    sym, exch = _symbol(), _exchange()
    et = F.col("event_type")
    line = (
        F.when(et == "purchase", F.concat_ws(",", d, F.lit("T"), sym, eid, tmin, eid, exch, price, ks))
        .when(et == "view", F.concat_ws(",", d, F.lit("Q"), sym, tmin, eid, exch, price, ks, ask,
                                        (F.lit(100) - k).cast("string")))
        .when(et == "click", F.concat_ws(",", d, F.lit("C"), sym, tmin, eid, exch))
        .when(et == "error", F.concat_ws(",", d, F.lit("T"), sym, eid, tmin, eid, exch))
        .otherwise(F.concat_ws(",", d, F.lit("Q"), sym, tmin, F.lit("n/a"), exch, ks, ks, ks, ks))
    )
    return events.select(line.alias("value"), _feed_position())


# The batches of the file feed.  Every event; then corrections of every
# fourth one, same arrival; then older versions of every eighth that come in last.
FILE_BATCHES = [(1, 0, "2024-02-01 00:00:00"), (4, 1, "2024-02-01 00:00:00"), (8, 2, "2024-01-31 00:00:00")]


def batch_events(events: DataFrame, every: int, add: int) -> DataFrame:
    """Events of one file batch: each ``every``-th id, its value raised by ``add``."""
    return events.where(F.col("event_id") % every == 0).withColumn("value", F.col("value") + F.lit(float(add)))


def on_weekdays(df: DataFrame) -> DataFrame:
    """Rows of Monday to Friday (no trading at weekends)."""
    return df.where(F.weekday("trade_dt") < 5)


def _feed_position() -> Column:
    """Place of a derived line in the feed (``read_lines`` gives files a
    similar tag): the event id, unique, so later events win version ties."""
    return F.struct(F.col("event_id").alias("pos")).alias("ingest_seq")


def json_lines_from_events(events: DataFrame) -> DataFrame:
    """One JSON object per event; prices as strings, sizes as numbers.
    click → unknown record type, error → truncated JSON, signup → quote
    without price keys."""
    d, tmin, eid, k, ks, price, ask = _text_parts()
    sym, exch = _symbol(), _exchange()
    et = F.col("event_type")
    trade = F.to_json(F.struct(
        d.alias("trade_date"), F.lit("T").alias("record_type"), sym.alias("symbol"),
        eid.alias("executionid"), tmin.alias("event_time"), eid.alias("event_seq_num"),
        exch.alias("exchange"), price.alias("trade_price"), k.alias("trade_size")))
    quote = F.to_json(F.struct(
        d.alias("trade_date"), F.lit("Q").alias("record_type"), sym.alias("symbol"),
        tmin.alias("event_time"), eid.alias("event_seq_num"), exch.alias("exchange"),
        price.alias("bid_price"), k.alias("bid_size"), ask.alias("ask_price"),
        (F.lit(100) - k).alias("ask_size")))
    unknown = F.to_json(F.struct(d.alias("trade_date"), F.lit("C").alias("record_type"), sym.alias("symbol")))
    broken = F.concat(F.lit('{"trade_date":"'), d, F.lit('","record_type":"T"'))
    partial = F.to_json(F.struct(
        d.alias("trade_date"), F.lit("Q").alias("record_type"), sym.alias("symbol"),
        tmin.alias("event_time"), eid.alias("event_seq_num"), exch.alias("exchange")))
    line = (F.when(et == "purchase", trade).when(et == "view", quote).when(et == "click", unknown)
            .when(et == "error", broken).otherwise(partial))
    return events.select(line.alias("value"), _feed_position())


def job_updates_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderpriority").alias("job_name"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("updated_time"),
        F.col("o_orderkey").alias("_seq"),
    )


LINEITEM_KEY = ["l_orderkey", "l_linenumber"]
LINEITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]
