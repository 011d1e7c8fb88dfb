"""Ingest of mixed trade/quote lines into the common_event table.

``read_lines`` scans text files (one row per line, blank lines kept) and tags
each line with its place in the feed; ``parse_csv_lines`` / ``parse_json_lines``
type the fields with native column expressions.  A line whose record type is
unknown, that lacks a field, or whose typed field does not parse goes to
partition ``B`` with the untouched text in ``original_line``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import field, parse_date, parse_double, parse_event_time, parse_long
from ..schema import BAD, COMMON_EVENT, COMMON_EVENT_COLUMNS, JSON_LINE, QUOTE, TRADE

# Field positions of the comma-separated feed (0-based).
CSV_TRADE_FIELDS = {"trade_dt": 0, "rec_type": 1, "symbol": 2, "event_time": 4,
                    "event_seq_num": 5, "exchange": 6, "trade_price": 7, "trade_size": 8}
CSV_QUOTE_FIELDS = {"trade_dt": 0, "rec_type": 1, "symbol": 2, "event_time": 3,
                    "event_seq_num": 4, "exchange": 5, "bid_price": 6, "bid_size": 7,
                    "ask_price": 8, "ask_size": 9}
CSV_TRADE_WIDTH = 9
CSV_QUOTE_WIDTH = 10

REASON_BLANK = "blank_line"
REASON_TYPE = "unknown_record_type"
REASON_MISSING = "missing_field"
REASON_VALUE = "bad_value"
REASON_JSON = "bad_json"


def read_lines(spark: SparkSession, path: str | list[str], options: dict | None = None) -> DataFrame:
    """Text scan: ``value`` plus ``ingest_seq``, the line's place in the feed.

    ``ingest_seq`` orders lines by file modification time, file, split and
    position in the split, so later files and later lines win a version tie.
    It is taken at the scan, before any shuffle, so it is stable under task
    retries.  ``options`` go to the reader (e.g. ``lineSep``, cloud keys are set
    on the session by the caller).
    """
    reader = spark.read
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.text(path)
    return df.select(
        "value",
        F.struct(
            F.col("_metadata.file_modification_time").alias("file_time"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        ).alias("ingest_seq"),
    )


# Generic slots of a record: the text of each slot is picked by record type
# first, so every slot is parsed once whatever the type.
#   slot      trade field     quote field
#   dt        trade_dt        trade_dt
#   sym       symbol          symbol
#   time      event_time      event_time
#   seq       event_seq_num   event_seq_num
#   exch      exchange        exchange
#   p1, s1    trade price/size  bid price/size
#   p2, s2    -               ask price/size
_SLOT_T = {"dt": "trade_dt", "sym": "symbol", "time": "event_time", "seq": "event_seq_num",
           "exch": "exchange", "p1": "trade_price", "s1": "trade_size"}
_SLOT_Q = {"dt": "trade_dt", "sym": "symbol", "time": "event_time", "seq": "event_seq_num",
           "exch": "exchange", "p1": "bid_price", "s1": "bid_size", "p2": "ask_price", "s2": "ask_size"}
_SLOT_PARSE = {"dt": parse_date, "sym": None, "time": parse_event_time, "seq": parse_long,
               "exch": None, "p1": parse_double, "s1": parse_long, "p2": parse_double, "s2": parse_long}


def _pick(rt: Column, t: Column | None, q: Column | None) -> Column:
    """Raw text of a slot for the line's record type (unknown types are
    rejected by the verdict, so their slot text does not matter)."""
    if q is None:
        return F.when(rt == F.lit(TRADE), t)
    if t is None:
        return F.when(rt == F.lit(QUOTE), q)
    if str(t) == str(q):
        return t
    return F.when(rt == F.lit(TRADE), t).otherwise(q)


def _parse_records(df: DataFrame, rt: Column, raw_t: dict[str, Column], raw_q: dict[str, Column],
                   complete_t: Column, complete_q: Column, arrival_time: Column | None,
                   keep_reason: bool, unreadable: Column | None = None) -> DataFrame:
    """Raw text per field (by record type) → typed common_event rows.

    Built as a chain of projections that each compute an expression once;
    Catalyst keeps them apart because the later ones reuse the earlier
    results more than once.
    """
    seq_col = F.col("ingest_seq") if "ingest_seq" in df.columns else F.struct(
        F.monotonically_increasing_id().alias("pos"))
    # Null-safe: a line without a type field has _rt = NULL.
    is_t = F.coalesce(F.col("_rt") == F.lit(TRADE), F.lit(False))
    is_q = F.coalesce(F.col("_rt") == F.lit(QUOTE), F.lit(False))
    # 1. record type and raw slot text
    raw = {}
    for slot in _SLOT_PARSE:
        t = raw_t.get(_SLOT_T.get(slot, ""))
        q = raw_q.get(_SLOT_Q.get(slot, ""))
        raw[slot] = (t, q)
    staged = df.select(
        F.col("value").alias("_line"), seq_col.alias("ingest_seq"), rt.alias("_rt"),
        complete_t.alias("_ct"), complete_q.alias("_cq"),
        (F.lit(False) if unreadable is None else unreadable).alias("_unread"),
        *[_pick(rt, t, q).alias(f"_raw_{slot}") for slot, (t, q) in raw.items()],
    )
    # 2. typed slots, each parsed once
    typed = staged.select(
        "_line", "ingest_seq", "_rt", "_ct", "_cq", "_unread",
        *[(conv(F.col(f"_raw_{s}")) if conv else F.col(f"_raw_{s}")).alias(f"_v_{s}")
          for s, conv in _SLOT_PARSE.items()],
    )
    # 3. verdict: every slot is named once; ask slots are needed only by quotes
    known = is_t | is_q
    complete = F.when(is_t, F.col("_ct")).otherwise(F.col("_cq"))
    common = [f"_v_{s}" for s in _SLOT_T]
    quote_only = [f"_v_{s}" for s in _SLOT_Q if s not in _SLOT_T]
    ok = known & complete
    for c in common:
        ok = ok & F.col(c).isNotNull()
    q_ok = F.lit(True)
    for c in quote_only:
        q_ok = q_ok & F.col(c).isNotNull()
    ok = ok & (is_t | q_ok)
    judged = typed.select(
        "*",
        F.coalesce(ok, F.lit(False)).alias("_valid"),
        F.when(F.trim(F.col("_line")) == "", F.lit(REASON_BLANK))
        .when(F.col("_unread"), F.lit(REASON_JSON))
        .when(~known, F.lit(REASON_TYPE))
        .when(~complete, F.lit(REASON_MISSING))
        .otherwise(F.lit(REASON_VALUE)).alias("_reason"),
    )
    # 4. output in schema order; bad rows keep only partition and line
    arrival = (arrival_time if arrival_time is not None else F.localtimestamp()).cast("timestamp_ntz")
    v = F.col("_valid")
    zero_d, zero_l = F.lit(0.0), F.lit(0).cast("bigint")
    vt, vq = v & is_t, v & is_q
    cols = {
        "trade_dt": F.when(v, F.col("_v_dt")),
        "rec_type": F.when(v, F.col("_rt")),
        "symbol": F.when(v, F.col("_v_sym")),
        "exchange": F.when(v, F.col("_v_exch")),
        "event_time": F.when(v, F.col("_v_time")),
        "event_seq_num": F.when(v, F.col("_v_seq")),
        "arrival_time": F.when(v, arrival),
        "trade_price": F.when(vt, F.col("_v_p1")).when(vq, zero_d),
        "trade_size": F.when(vt, F.col("_v_s1")).when(vq, zero_l),
        "bid_price": F.when(vq, F.col("_v_p1")).when(vt, zero_d),
        "bid_size": F.when(vq, F.col("_v_s1")).when(vt, zero_l),
        "ask_price": F.when(vq, F.col("_v_p2")).when(vt, zero_d),
        "ask_size": F.when(vq, F.col("_v_s2")).when(vt, zero_l),
        "partition": F.when(v, F.col("_rt")).otherwise(F.lit(BAD)),
        "original_line": F.when(v, F.lit("")).otherwise(F.col("_line")),
    }
    out = [cols[f.name].cast(f.dataType).alias(f.name) for f in COMMON_EVENT.fields]
    out.append(F.col("ingest_seq"))
    if keep_reason:
        out.append(F.when(~v, F.col("_reason")).alias("bad_reason"))
    # The record leaves through a one-element generator: filters on its
    # columns (partition = 'T', ...) stay above it instead of being pushed
    # into the parser, which would then run twice per line (and overflow the
    # generated code).
    return judged.select(F.inline(F.array(F.struct(*out))))


def parse_csv_lines(df: DataFrame, arrival_time: Column | None = None,
                    keep_reason: bool = False) -> DataFrame:
    """Comma-separated lines (column ``value``) → common_event (+ ``ingest_seq``).

    Extra trailing fields are accepted; no quoting; blanks around numbers are
    accepted, blanks in text fields are kept.
    """
    split = df.select("*", F.split(F.col("value"), ",", -1).alias("_parts"))
    parts = F.col("_parts")
    n = F.size(parts)
    raw_t = {k: field(parts, i) for k, i in CSV_TRADE_FIELDS.items()}
    raw_q = {k: field(parts, i) for k, i in CSV_QUOTE_FIELDS.items()}
    return _parse_records(split, field(parts, 1), raw_t, raw_q,
                          n >= CSV_TRADE_WIDTH, n >= CSV_QUOTE_WIDTH, arrival_time, keep_reason)


def parse_json_lines(df: DataFrame, arrival_time: Column | None = None,
                     keep_reason: bool = False) -> DataFrame:
    """JSON-lines records (column ``value``) → common_event (+ ``ingest_seq``).

    Every key is read as text and typed like a CSV field; malformed JSON, text
    after the object or a missing key makes the line bad.
    """
    # As an array, a line must be one whole record: nothing may follow it.
    records = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), T.ArrayType(JSON_LINE))
    rec_df = df.select("*", records.alias("_recs")).select(
        "*", F.when(F.size("_recs") == 1, F.get(F.col("_recs"), 0)).alias("_rec")).drop("_recs")
    get = lambda k: F.col("_rec").getField(k)
    common = {"trade_dt": get("trade_date"), "symbol": get("symbol"), "event_time": get("event_time"),
              "event_seq_num": get("event_seq_num"), "exchange": get("exchange")}
    raw_t = {**common, "trade_price": get("trade_price"), "trade_size": get("trade_size")}
    raw_q = {**common, "bid_price": get("bid_price"), "bid_size": get("bid_size"),
             "ask_price": get("ask_price"), "ask_size": get("ask_size")}
    present_t = F.lit(True)
    for c in raw_t.values():
        present_t = present_t & c.isNotNull()
    present_q = F.lit(True)
    for c in raw_q.values():
        present_q = present_q & c.isNotNull()
    return _parse_records(rec_df, get("record_type"), raw_t, raw_q, present_t, present_q,
                          arrival_time, keep_reason, F.col("_rec").isNull())


def ingest_csv(spark: SparkSession, path: str | list[str], arrival_time: Column | None = None,
               options: dict | None = None, conf: dict | None = None) -> DataFrame:
    """E1 for CSV files: scan + parse.  ``conf`` is applied to the session first
    (for instance a cloud storage account key)."""
    for k, v in (conf or {}).items():
        spark.conf.set(k, v)
    return parse_csv_lines(read_lines(spark, path, options), arrival_time)


def ingest_json(spark: SparkSession, path: str | list[str], arrival_time: Column | None = None,
                options: dict | None = None, conf: dict | None = None) -> DataFrame:
    for k, v in (conf or {}).items():
        spark.conf.set(k, v)
    return parse_json_lines(read_lines(spark, path, options), arrival_time)


def common_event_columns(df: DataFrame) -> DataFrame:
    """Only the common_event columns, in schema order (drops ``ingest_seq``)."""
    return df.select(*COMMON_EVENT_COLUMNS)


def bad_records(events: DataFrame) -> DataFrame:
    """Quarantined lines with the reason they failed (needs ``keep_reason``)."""
    return events.where(F.col("partition") == BAD).select("original_line", "bad_reason")


def ingest_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows"))


def ingest_summary(events: DataFrame) -> DataFrame:
    """Data-quality summary per partition in one aggregation pass: rows, distinct
    symbols and days, the span of event times, lines kept, nulls of every column and
    prices that are not finite."""
    nulls = [F.count_if(F.col(f.name).isNull()).alias(f"null_{f.name}") for f in COMMON_EVENT if f.name != "partition"]
    odd = [F.count_if(F.isnan(f.name) | (F.abs(f.name) == float("inf"))).alias(f"nonfinite_{f.name}")
           for f in COMMON_EVENT if isinstance(f.dataType, T.DoubleType)]
    return events.groupBy("partition").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("symbol").alias("n_symbols"),
        F.count_distinct("trade_dt").alias("n_dates"),
        F.min("event_time").alias("min_event_time"),
        F.max("event_time").alias("max_event_time"),
        F.sum(F.when(F.col("original_line") != "", 1).otherwise(0)).alias("n_with_line"),
        *nulls, *odd,
    )
