"""Table schemas, keys and column lists shared by every operator.

All timestamps are ``timestamp_ntz`` (wall-clock, no zone), which is what the
source feeds carry and what the parquet readers of other engines return.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Record types and landing partitions (fixed values of the data model).
TRADE = "T"
QUOTE = "Q"
BAD = "B"

# Composite event key: one logical event per key; later arrivals correct it.
EVENT_KEY = ["trade_dt", "symbol", "exchange", "event_time", "event_seq_num"]

TRADE_PAYLOAD = ["trade_price", "trade_size"]
QUOTE_PAYLOAD = ["bid_price", "bid_size", "ask_price", "ask_size"]

# Total order of events inside one (trade_dt, symbol) series.  event_time alone
# has ties (two exchanges at the same minute), so seq and exchange break them.
SERIES_KEY = ["trade_dt", "symbol"]
SERIES_ORDER = ["event_time", "event_seq_num", "exchange"]

# Columns and types of the data model's tables, here and below.
COMMON_EVENT = T.StructType(
    [
        T.StructField("trade_dt", T.DateType()),
        T.StructField("rec_type", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_seq_num", T.LongType()),
        T.StructField("arrival_time", T.TimestampNTZType()),
        T.StructField("trade_price", T.DoubleType()),
        T.StructField("trade_size", T.LongType()),
        T.StructField("bid_price", T.DoubleType()),
        T.StructField("bid_size", T.LongType()),
        T.StructField("ask_price", T.DoubleType()),
        T.StructField("ask_size", T.LongType()),
        T.StructField("partition", T.StringType()),
        T.StructField("original_line", T.StringType()),
    ]
)
COMMON_EVENT_COLUMNS = [f.name for f in COMMON_EVENT.fields]

TRADE_COLUMNS = [
    "arrival_time", "trade_dt", "symbol", "exchange", "event_time",
    "event_seq_num", "trade_price", "trade_size",
]
QUOTE_COLUMNS = [
    "arrival_time", "trade_dt", "symbol", "exchange", "event_time",
    "event_seq_num", "bid_price", "bid_size", "ask_price", "ask_size",
]

# Fields of one JSON-lines record; every value is read as text and typed by
# the same rules as a CSV field (fixed key names of the feed format).
JSON_TRADE_KEYS = [
    "trade_date", "record_type", "symbol", "executionid", "event_time",
    "event_seq_num", "exchange", "trade_price", "trade_size",
]
JSON_QUOTE_KEYS = [
    "trade_date", "record_type", "symbol", "event_time", "event_seq_num",
    "exchange", "bid_price", "bid_size", "ask_price", "ask_size",
]
JSON_LINE = T.StructType(
    [T.StructField(k, T.StringType()) for k in dict.fromkeys(JSON_TRADE_KEYS + JSON_QUOTE_KEYS)]
)

QUOTE_UNION = T.StructType(
    [
        T.StructField("trade_dt", T.DateType()),
        T.StructField("rec_type", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_seq_num", T.LongType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("bid_price", T.DoubleType()),
        T.StructField("bid_size", T.LongType()),
        T.StructField("ask_price", T.DoubleType()),
        T.StructField("ask_size", T.LongType()),
        T.StructField("trade_price", T.DoubleType()),
        T.StructField("mov_avg_pr", T.DoubleType()),
    ]
)

REPORT_COLUMNS = [
    "trade_dt", "symbol", "event_time", "event_seq_num", "exchange",
    "bid_price", "bid_size", "ask_price", "ask_size",
    "last_trade_price", "last_avg_trade_price", "bid_pr_mv", "ask_pr_mv",
]

JOB_TRACKER = T.StructType(
    [
        T.StructField("job_id", T.LongType(), False),
        T.StructField("job_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("updated_time", T.TimestampNTZType(), False),
    ]
)
