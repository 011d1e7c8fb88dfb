"""Typed parsing of text fields with the acceptance rules of the feed format.

Every helper returns a Column that is NULL when the text is not acceptable, so
a record is bad exactly when one of its required typed fields is NULL.  All of
them are native expressions (no Python per row) and never raise under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text formats of the feed.
DATE_FORMAT = "yyyy-M-d"          # 2021-01-02 or 2021-1-2; 4-digit year
EVENT_TIME_FORMAT = "yyyy-M-d H:m"  # minutes resolution, no seconds
# Integer text: optional blanks and sign, digits with single '_' separators.
INT_PATTERN = r"^\s*[+-]?\d+(_\d+)*\s*$"
# Float text: decimal or exponent form (no type suffix such as '1d'), or
# inf / infinity / nan in any letter case.
FLOAT_PATTERN = (
    r"^\s*[+-]?("
    r"((\d+(_\d+)*)?\.\d+(_\d+)*|\d+(_\d+)*\.?)([eE][+-]?\d+(_\d+)*)?"
    r"|(?i:inf|infinity|nan)"
    r")\s*$"
)


def _clean_number(c: Column) -> Column:
    # The cast itself trims blanks; only digit separators need removing.
    return F.translate(c, "_", "")


def parse_long(c: Column) -> Column:
    return F.when(c.rlike(INT_PATTERN), _clean_number(c).try_cast("bigint"))


def parse_double(c: Column) -> Column:
    return F.when(c.rlike(FLOAT_PATTERN), _clean_number(c).try_cast("double"))


def parse_date(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(DATE_FORMAT)).cast("date")


def parse_event_time(c: Column) -> Column:
    # try_to_timestamp decides validity without raising; the wall-clock value
    # is then read as timestamp_ntz, so no session time zone (or daylight
    # saving gap) can shift it.
    fmt = F.lit(EVENT_TIME_FORMAT)
    return F.when(F.try_to_timestamp(c, fmt).isNotNull(), F.to_timestamp_ntz(c, fmt))


def field(parts: Column, i: int) -> Column:
    """0-based field i of a split line; NULL when the line is too short."""
    return F.get(parts, i)


def spread(ask: Column, bid: Column) -> Column:
    """quoted spread (ask minus bid)."""
    return ask - bid


def event_text() -> Column:
    """Printable form of a common_event row.

    Good records print their typed fields in a parenthesised list (dates as
    yyyy-MM-dd); bad records print their original line.
    """
    d = lambda c: F.date_format(F.col(c), "yyyy-MM-dd")
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    good = F.concat(
        F.lit("("),
        F.concat_ws(
            ", ",
            d("trade_dt"), s("rec_type"), s("symbol"), d("event_time"),
            s("exchange"), s("event_seq_num"), d("arrival_time"),
            s("trade_price"), s("trade_size"), s("bid_price"), s("bid_size"),
            s("ask_price"), s("ask_size"),
        ),
        F.lit(")"),
    )
    return F.when(F.col("rec_type").isin("T", "Q"), good).otherwise(F.col("original_line"))
