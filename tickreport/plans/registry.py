"""Registered queries over the driver tables, each with an equivalent SQL.

Every query reads whole tables (events, lineitem, orders) through the mapping
in ``feeds``; the SQL next to it computes the same rows with plain SQL so the
two can be compared.  Computed doubles are rounded to 6 places on both sides
(aggregation order differs between engines); names are aliased alike.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import close as CL
from ..operators import jobs as J
from ..operators import joins as JN
from ..operators import setops as S
from ..operators import windows as W
from ..schema import COMMON_EVENT_COLUMNS, QUOTE_COLUMNS, REPORT_COLUMNS, TRADE_COLUMNS
from ..session import materialize, scratch_dir
from ..sources import ingest as I
from ..sources import store as ST
from ..functions.parse import event_text, spread
from . import daily_job as DJ
from . import feeds as FD
from . import report as R

SLICE_DATE = "2024-01-15"   # the day read back by ``daily_slice``
STATUS_JOB_ID = 4           # the job looked up by ``job_status``
PREVIEW_ROWS = 20


def _r(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or (c if isinstance(c, str) else None))


def _events(spark, d):
    return FD.table(spark, d, "events")


def _trades(spark, d):
    return FD.trades_from_events(_events(spark, d))


def _quotes(spark, d):
    return FD.quotes_from_events(_events(spark, d))


def _csv_events(spark, d, keep_reason=False):
    return I.parse_csv_lines(FD.csv_lines_from_events(_events(spark, d)),
                             arrival_time=FD.fixed_arrival(), keep_reason=keep_reason)


def _json_events(spark, d):
    return I.parse_json_lines(FD.json_lines_from_events(_events(spark, d)), arrival_time=FD.fixed_arrival())


def _with_avg(trades: DataFrame) -> DataFrame:
    return W.moving_avg_rows(trades.select(*R.TRADE_FIELDS), "trade_price", 3, "avg_trade_price")


def _r0(c: str | Column, name: str | None = None) -> Column:
    """Rounded difference with the sign of zero normalised (-0.0 + 0.0 =
    +0.0): two engines may land on either side of zero for a difference of
    equal prices."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.round(col, 6) + F.lit(0.0)).alias(name or (c if isinstance(c, str) else None))


def _round_report(df: DataFrame) -> DataFrame:
    return df.select(*[_r(c) if c == "last_avg_trade_price" else _r0(c) if c in ("bid_pr_mv", "ask_pr_mv")
                       else F.col(c) for c in REPORT_COLUMNS])


# ---------------------------------------------------------------- queries ---

def q_ingest_csv(spark, d):
    return _csv_events(spark, d).select(*COMMON_EVENT_COLUMNS)


def q_ingest_json(spark, d):
    return _json_events(spark, d).select(*COMMON_EVENT_COLUMNS)


def q_bad_records(spark, d):
    return I.bad_records(_csv_events(spark, d, keep_reason=True))


def q_bad_json_records(spark, d):
    return I.bad_records(I.parse_json_lines(FD.json_lines_from_events(_events(spark, d)),
                                            arrival_time=FD.fixed_arrival(), keep_reason=True))


def _landed_files(spark, d) -> str:
    """The file feed: each batch written as text files and landed from them."""
    root = scratch_dir(spark, "file-feed")
    for n, (every, add, arrival) in enumerate(FD.FILE_BATCHES):
        lines = FD.csv_lines_from_events(FD.batch_events(_events(spark, d), every, add))
        lines.select("value").write.text(f"{root}/feed/batch{n}")
        DJ.land(spark, f"{root}/feed/batch{n}", root, arrival_time=F.lit(arrival).cast("timestamp_ntz"))
    return root


def q_ingest_files(spark, d):
    return ST.read_landing(spark, f"{_landed_files(spark, d)}/{DJ.LANDING_DIR}").select(*COMMON_EVENT_COLUMNS)


def q_clean_versions(spark, d):
    trades, quotes = DJ.correct(spark, _landed_files(spark, d), pending=True)
    t, q = ST.read_daily(spark, trades), ST.read_daily(spark, quotes)
    both = t.withColumn("rec_type", F.lit("T")).unionByName(q.withColumn("rec_type", F.lit("Q")), True)
    return both.select(*[c for c in COMMON_EVENT_COLUMNS if c in both.columns])


def q_ingest_counts(spark, d):
    return I.ingest_counts(_csv_events(spark, d))


def q_ingest_summary(spark, d):
    return I.ingest_summary(_csv_events(spark, d))


def q_trade_select(spark, d):
    return C.select_trades(_csv_events(spark, d)).select(*TRADE_COLUMNS)


def q_quote_select(spark, d):
    return C.select_quotes(_csv_events(spark, d)).select(*QUOTE_COLUMNS)


def q_event_text(spark, d):
    return _csv_events(spark, d).select("partition", event_text().alias("event_text"))


def q_quote_spread(spark, d):
    q = _quotes(spark, d)
    return q.select("trade_dt", "symbol", "exchange", "event_time", "event_seq_num",
                    _r0(spread(q["ask_price"], q["bid_price"]), "spread"))


def q_distinct_dates(spark, d):
    return C.distinct_values(_trades(spark, d), "trade_dt")


def q_latest_trade_version(spark, d):
    t = _trades(spark, d)
    return C.latest_version(t, ["trade_dt", "symbol", "exchange"],
                            ["arrival_time", "event_time", "event_seq_num", "trade_price", "trade_size"],
                            ["arrival_time", "event_seq_num"])


def q_latest_quote_version(spark, d):
    q = _quotes(spark, d)
    return C.latest_version(q, ["trade_dt", "symbol", "exchange"],
                            ["arrival_time", "event_time", "event_seq_num", "bid_price", "bid_size",
                             "ask_price", "ask_size"],
                            ["arrival_time", "event_seq_num"])


def q_dedup_lineitem(spark, d):
    li = FD.table(spark, d, "lineitem")
    payload = [c for c in li.columns if c not in FD.LINEITEM_KEY]
    return C.latest_version(li, FD.LINEITEM_KEY, payload, FD.LINEITEM_ORDER)


def q_versions_per_key(spark, d):
    return C.versions_per_key(FD.table(spark, d, "lineitem"), FD.LINEITEM_KEY, "l_shipdate")


def q_moving_avg_rows(spark, d):
    t = _with_avg(_trades(spark, d))
    return t.select(*R.TRADE_FIELDS, _r("avg_trade_price"))


def q_moving_avg_30m(spark, d):
    t = W.moving_avg_range(_trades(spark, d).select(*R.TRADE_FIELDS), "trade_price", 30, "avg_trade_price")
    return t.select(*R.TRADE_FIELDS, _r("avg_trade_price"))


def q_last_value_per_trade(spark, d):
    t = W.last_value_per_series(_with_avg(_trades(spark, d)), ["trade_price", "avg_trade_price"],
                                ["last_trade_price", "last_avg_trade_price"])
    return t.select(*R.TRADE_FIELDS, "last_trade_price", _r("last_avg_trade_price"))


def q_day_last_trade(spark, d):
    last = CL.day_close(_trades(spark, d).select(*R.TRADE_FIELDS))
    return last.select("trade_dt", "symbol", "last_trade_price", _r("last_avg_trade_price"))


def _close(spark, d):
    t = _trades(spark, d).select(*R.TRADE_FIELDS)
    close = CL.day_close(t).select("trade_dt", "symbol", F.col("last_avg_trade_price").alias("close_price"))
    return CL.close_per_venue(close, t)


def q_close_price(spark, d):
    return _close(spark, d).select("trade_dt", "symbol", "exchange", _r("close_price"))


def q_quote_last_trade(spark, d):
    last = CL.day_close(_trades(spark, d).select(*R.TRADE_FIELDS))
    j = JN.quote_last_trade(_quotes(spark, d).select(*R.QUOTE_FIELDS), last)
    return j.select("trade_dt", F.lit("Q").alias("rec_type"), *R.QUOTE_FIELDS[1:],
                    "last_trade_price", _r("last_avg_trade_price"))


def q_quote_prev_close(spark, d):
    prev = CL.shift_to_next_day(_close(spark, d))
    j = JN.attach_prev_close(_quotes(spark, d).select(*R.QUOTE_FIELDS), prev)
    return j.select(*R.QUOTE_FIELDS, _r("close_price"))


def q_quote_prev_close_broadcast(spark, d):
    prev = CL.shift_to_next_day(_close(spark, d))
    j = JN.attach_prev_close_broadcast(_quotes(spark, d).select(*R.QUOTE_FIELDS), prev)
    return j.select(*R.QUOTE_FIELDS, _r("close_price"))


def q_quote_report(spark, d):
    return _round_report(R.quote_report(_trades(spark, d), _quotes(spark, d)))


def q_quote_report_asof(spark, d):
    return _round_report(R.quote_report_asof(_trades(spark, d), _quotes(spark, d)))


def q_quote_report_trading_day(spark, d):
    """Trades on weekdays only, quotes on all days: the previous trading day's close."""
    return _round_report(R.quote_report(FD.on_weekdays(_trades(spark, d)), _quotes(spark, d), prev_trading_day=True))


def q_report_preview(spark, d):
    return R.report_preview(q_quote_report(spark, d), PREVIEW_ROWS)


def _asof(spark, d, avg: bool, inclusive: bool):
    t = _trades(spark, d).select(*R.TRADE_FIELDS)
    if avg:
        # The window output feeds both halves of the split as-of: write once.
        t = materialize(W.moving_avg_range(t, "trade_price", 30, "avg_trade_price"))
        vals, outs = ["avg_trade_price"], ["last_avg_trade_price"]
    else:
        vals, outs = ["trade_price"], ["last_trade_price"]
    j = JN.asof_join(_quotes(spark, d).select(*R.QUOTE_FIELDS), t, vals, outs=outs, inclusive=inclusive)
    return j.select(*R.QUOTE_FIELDS, *[_r(o) for o in outs])


def q_quote_asof_trade(spark, d):
    return _asof(spark, d, avg=False, inclusive=True)


def q_quote_asof_avg(spark, d):
    return _asof(spark, d, avg=True, inclusive=True)


def q_quote_asof_strict(spark, d):
    return _asof(spark, d, avg=False, inclusive=False)


def q_quote_trade_same_time(spark, d):
    ev = _csv_events(spark, d)
    trades = C.select_trades(ev).select(*R.TRADE_FIELDS)
    quotes = JN.same_time_join(C.select_quotes(ev).select(*R.QUOTE_FIELDS), trades)
    j = JN.quote_last_trade(quotes, CL.day_close(trades))
    return j.select(*R.QUOTE_FIELDS, "last_trade_price", _r("last_avg_trade_price"))


def q_quote_union(spark, d):
    u = S.quote_union(_with_avg(_trades(spark, d)), _quotes(spark, d), distinct=False)
    return u.withColumn("mov_avg_pr", F.round("mov_avg_pr", 6)).distinct()


def q_exchange_overlap(spark, d):
    return S.exchange_overlap(_trades(spark, d), _quotes(spark, d))


def q_landing_roundtrip(spark, d):
    path = scratch_dir(spark, "landing")
    ST.write_landing(_csv_events(spark, d), path, mode="overwrite")
    return ST.read_landing(spark, path).select(*COMMON_EVENT_COLUMNS)


def _daily_written(spark, d) -> str:
    root = scratch_dir(spark, "daily-trade")
    trades = C.clean_trades(C.select_trades(_csv_events(spark, d)))
    ST.write_daily(trades, root)
    return root


def q_daily_roundtrip(spark, d):
    return ST.read_daily(spark, _daily_written(spark, d)).select(*TRADE_COLUMNS)


def q_daily_slice(spark, d):
    df = ST.read_daily(spark, _daily_written(spark, d), dates=[SLICE_DATE])
    return df.select("trade_dt", "symbol", "exchange", "event_time", "event_seq_num", "trade_price")


def q_report_roundtrip(spark, d):
    root = scratch_dir(spark, "analytic")
    ST.write_report(q_quote_report(spark, d), root)
    return ST.read_report(spark, root).select(*REPORT_COLUMNS)


def q_sql_views(spark, d):
    ST.register_views({"tr_trades": _trades(spark, d), "tr_quotes": _quotes(spark, d)})
    return spark.sql(VIEW_SQL.format(trades="tr_trades", quotes="tr_quotes"))


def q_next_job_id(spark, d):
    names = FD.job_updates_from_orders(FD.table(spark, d, "orders")).select("job_name")
    return J.assign_job_ids(J.seed_tracker(spark), names)


def _job_state(spark, d):
    updates = FD.job_updates_from_orders(FD.table(spark, d, "orders"))
    return J.apply_status_updates(J.seed_tracker(spark), updates)


def q_job_upsert(spark, d):
    return _job_state(spark, d)


def q_job_status(spark, d):
    return J.job_status(_job_state(spark, d), STATUS_JOB_ID)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


# ------------------------------------------------------------------- SQL ---

_E = """(SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        'S' || CAST(user_id % 10 AS VARCHAR) AS symbol,
        'X' || CAST(user_id % 3 AS VARCHAR) AS exchange,
        strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%Y-%m-%d %H:%M') AS tmin,
        CAST(event_id AS VARCHAR) AS eid
      FROM events)"""

_TRADES = f"""(SELECT ts AS arrival_time, CAST(ts AS DATE) AS trade_dt, symbol, exchange,
        ts AS event_time, event_id AS event_seq_num, value AS trade_price, k AS trade_size
      FROM {_E} e WHERE event_type = 'purchase')"""

_QUOTES = f"""(SELECT ts AS arrival_time, CAST(ts AS DATE) AS trade_dt, symbol, exchange,
        ts AS event_time, event_id AS event_seq_num, value AS bid_price, k AS bid_size,
        value + k / 100e0 AS ask_price, 100 - k AS ask_size
      FROM {_E} e WHERE event_type = 'view')"""

_ARRIVAL = f"TIMESTAMP '{FD.FIXED_ARRIVAL}'"

_CSV_BAD = """CASE event_type
        WHEN 'click' THEN concat_ws(',', d, 'C', symbol, tmin, eid, exchange)
        WHEN 'error' THEN concat_ws(',', d, 'T', symbol, eid, tmin, eid, exchange)
        ELSE concat_ws(',', d, 'Q', symbol, tmin, 'n/a', exchange,
                       CAST(k AS VARCHAR), CAST(k AS VARCHAR), CAST(k AS VARCHAR), CAST(k AS VARCHAR))
      END"""

_JSON_BAD = """CASE event_type
        WHEN 'click' THEN '{"trade_date":"' || d || '","record_type":"C","symbol":"' || symbol || '"}'
        WHEN 'error' THEN '{"trade_date":"' || d || '","record_type":"T"'
        ELSE '{"trade_date":"' || d || '","record_type":"Q","symbol":"' || symbol
             || '","event_time":"' || tmin || '","event_seq_num":"' || eid
             || '","exchange":"' || exchange || '"}'
      END"""


def _common(bad_line: str) -> str:
    return f"""SELECT
  CASE WHEN good THEN CAST(ts AS DATE) END AS trade_dt,
  CASE event_type WHEN 'purchase' THEN 'T' WHEN 'view' THEN 'Q' END AS rec_type,
  CASE WHEN good THEN symbol END AS symbol,
  CASE WHEN good THEN exchange END AS exchange,
  CASE WHEN good THEN date_trunc('minute', ts) END AS event_time,
  CASE WHEN good THEN event_id END AS event_seq_num,
  CASE WHEN good THEN {_ARRIVAL} END AS arrival_time,
  CASE event_type WHEN 'purchase' THEN value WHEN 'view' THEN CAST(0 AS DOUBLE) END AS trade_price,
  CASE event_type WHEN 'purchase' THEN k WHEN 'view' THEN CAST(0 AS BIGINT) END AS trade_size,
  CASE event_type WHEN 'purchase' THEN CAST(0 AS DOUBLE) WHEN 'view' THEN value END AS bid_price,
  CASE event_type WHEN 'purchase' THEN CAST(0 AS BIGINT) WHEN 'view' THEN k END AS bid_size,
  CASE event_type WHEN 'purchase' THEN CAST(0 AS DOUBLE) WHEN 'view' THEN value + k / 100e0 END AS ask_price,
  CASE event_type WHEN 'purchase' THEN CAST(0 AS BIGINT) WHEN 'view' THEN 100 - k END AS ask_size,
  CASE event_type WHEN 'purchase' THEN 'T' WHEN 'view' THEN 'Q' ELSE 'B' END AS "partition",
  CASE WHEN good THEN '' ELSE {bad_line} END AS original_line
FROM (SELECT *, event_type IN ('purchase', 'view') AS good FROM {_E} e0) e"""


_CSV_COMMON = _common(_CSV_BAD)
_JSON_COMMON = _common(_JSON_BAD)

_TRADE_SELECT = f"""SELECT arrival_time, trade_dt, symbol, exchange, event_time, event_seq_num,
  trade_price, trade_size FROM ({_CSV_COMMON}) c WHERE "partition" = 'T'"""

_QUOTE_SELECT = f"""SELECT arrival_time, trade_dt, symbol, exchange, event_time, event_seq_num,
  bid_price, bid_size, ask_price, ask_size FROM ({_CSV_COMMON}) c WHERE "partition" = 'Q'"""

# Moving average over 3 rows, per symbol and day, in the total order.
_MA = f"""(SELECT trade_dt, symbol, exchange, event_time, event_seq_num, trade_price,
    AVG(trade_price) OVER (PARTITION BY trade_dt, symbol ORDER BY event_time, event_seq_num, exchange
                           ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS avg_trade_price
  FROM {{trades}} t0)"""

_MA30 = """(SELECT trade_dt, symbol, exchange, event_time, event_seq_num, trade_price,
    AVG(trade_price) OVER (PARTITION BY trade_dt, symbol ORDER BY event_time
                           RANGE BETWEEN INTERVAL 30 MINUTES PRECEDING AND CURRENT ROW) AS avg_trade_price
  FROM {trades} t0)"""

_LAST = """(SELECT trade_dt, symbol, trade_price AS last_trade_price, avg_trade_price AS last_avg_trade_price
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY trade_dt, symbol
                                     ORDER BY event_time DESC, event_seq_num DESC, exchange DESC) AS rn
        FROM {ma} m0) m1 WHERE rn = 1)"""

_CLOSE = """(SELECT DISTINCT m.trade_dt, m.symbol, m.exchange, l.last_avg_trade_price AS close_price
  FROM {ma} m JOIN {last} l ON m.trade_dt = l.trade_dt AND m.symbol = l.symbol)"""

# The report as SQL text over two named tables, as a plain window over each series.
REPORT_SQL_BODY = """SELECT q.trade_dt, q.symbol, q.event_time, q.event_seq_num, q.exchange,
  q.bid_price, q.bid_size, q.ask_price, q.ask_size,
  l.last_trade_price, round(l.last_avg_trade_price, 6) AS last_avg_trade_price,
  round(q.bid_price - c.close_price, 6) + CAST(0 AS DOUBLE) AS bid_pr_mv,
  round(q.ask_price - c.close_price, 6) + CAST(0 AS DOUBLE) AS ask_pr_mv
FROM {quotes} q
JOIN {last} l ON q.trade_dt = l.trade_dt AND q.symbol = l.symbol
JOIN {close} c ON c.trade_dt + 1 = q.trade_dt AND c.symbol = q.symbol AND c.exchange = q.exchange"""


def _report_sql(trades: str, quotes: str) -> str:
    ma = _MA.format(trades=trades)
    last = _LAST.format(ma=ma)
    close = _CLOSE.format(ma=ma, last=last)
    return REPORT_SQL_BODY.format(quotes=quotes, last=last, close=close)


# The report for SQL users (``sql_views``): each series' last three rows are kept by a
# group limit below the shuffle, so no task holds a whole (day, symbol).
VIEW_SQL = """WITH tail AS (
  SELECT * FROM (SELECT trade_dt, symbol, trade_price,
                        ROW_NUMBER() OVER (PARTITION BY trade_dt, symbol
                                           ORDER BY event_time DESC, event_seq_num DESC, exchange DESC) AS rn
                 FROM {trades}) WHERE rn <= 3),
last AS (
  SELECT trade_dt, symbol, max(CASE WHEN rn = 1 THEN trade_price END) AS last_trade_price,
         avg(trade_price) AS last_avg_trade_price FROM tail GROUP BY trade_dt, symbol),
venue_close AS (
  SELECT v.trade_dt, v.symbol, v.exchange, l.last_avg_trade_price AS close_price
  FROM (SELECT DISTINCT trade_dt, symbol, exchange FROM {trades}) v
  JOIN last l ON l.trade_dt = v.trade_dt AND l.symbol = v.symbol)
SELECT q.trade_dt, q.symbol, q.event_time, q.event_seq_num, q.exchange,
  q.bid_price, q.bid_size, q.ask_price, q.ask_size,
  l.last_trade_price, round(l.last_avg_trade_price, 6) AS last_avg_trade_price,
  round(q.bid_price - c.close_price, 6) + CAST(0 AS DOUBLE) AS bid_pr_mv,
  round(q.ask_price - c.close_price, 6) + CAST(0 AS DOUBLE) AS ask_pr_mv
FROM {quotes} q
JOIN last l ON q.trade_dt = l.trade_dt AND q.symbol = l.symbol
JOIN venue_close c ON c.trade_dt + 1 = q.trade_dt AND c.symbol = q.symbol AND c.exchange = q.exchange"""


def _asof_sql(value_sql: str, outs: list[str], op: str) -> str:
    sel = ", ".join(f"round(t.{o}, 6) AS {o}" for o in outs)
    return f"""SELECT q.trade_dt, q.symbol, q.event_time, q.event_seq_num, q.exchange,
  q.bid_price, q.bid_size, q.ask_price, q.ask_size, {sel}
FROM {_QUOTES} q ASOF LEFT JOIN {value_sql} t
  ON q.trade_dt = t.trade_dt AND q.symbol = t.symbol AND q.event_time {op} t.event_time"""


_REPORT = _report_sql(_TRADES, _QUOTES)
_MA_T = _MA.format(trades=_TRADES)
_LAST_T = _LAST.format(ma=_MA_T)
_CLOSE_T = _CLOSE.format(ma=_MA_T, last=_LAST_T)
_MA30_T = _MA30.format(trades=_TRADES)
_LAST30_T = _LAST.format(ma=_MA30_T)
_CLOSE30_T = _CLOSE.format(ma=_MA30_T, last=_LAST30_T)

_ASOF_REPORT = f"""SELECT a.trade_dt, a.symbol, a.event_time, a.event_seq_num, a.exchange,
  a.bid_price, a.bid_size, a.ask_price, a.ask_size,
  a.last_trade_price, round(a.last_avg_trade_price, 6) AS last_avg_trade_price,
  round(a.bid_price - c.close_price, 6) + CAST(0 AS DOUBLE) AS bid_pr_mv,
  round(a.ask_price - c.close_price, 6) + CAST(0 AS DOUBLE) AS ask_pr_mv
FROM (SELECT q.*, t.trade_price AS last_trade_price, t.avg_trade_price AS last_avg_trade_price
      FROM {_QUOTES} q ASOF LEFT JOIN {_MA30_T} t
        ON q.trade_dt = t.trade_dt AND q.symbol = t.symbol AND q.event_time >= t.event_time) a
JOIN {_CLOSE30_T} c ON c.trade_dt + 1 = a.trade_dt AND c.symbol = a.symbol AND c.exchange = a.exchange"""

_WEEKDAY_TRADES = f"(SELECT * FROM {_TRADES} w WHERE isodow(trade_dt) < 6)"
_MA_W = _MA.format(trades=_WEEKDAY_TRADES)
_LAST_W = _LAST.format(ma=_MA_W)
_CLOSE_W = _CLOSE.format(ma=_MA_W, last=_LAST_W)
_REPORT_TRADING_DAY = f"""SELECT q.trade_dt, q.symbol, q.event_time, q.event_seq_num, q.exchange,
  q.bid_price, q.bid_size, q.ask_price, q.ask_size,
  l.last_trade_price, round(l.last_avg_trade_price, 6) AS last_avg_trade_price,
  round(q.bid_price - c.close_price, 6) + CAST(0 AS DOUBLE) AS bid_pr_mv,
  round(q.ask_price - c.close_price, 6) + CAST(0 AS DOUBLE) AS ask_pr_mv
FROM (SELECT *, (SELECT max(trade_dt) FROM {_WEEKDAY_TRADES} d WHERE d.trade_dt < q0.trade_dt) AS prev_dt
      FROM {_QUOTES} q0) q
JOIN {_LAST_W} l ON q.trade_dt = l.trade_dt AND q.symbol = l.symbol
JOIN {_CLOSE_W} c ON c.trade_dt = q.prev_dt AND c.symbol = q.symbol AND c.exchange = q.exchange"""


def _file_batches() -> str:
    """All batches of the file feed, numbered."""
    return " UNION ALL ".join(
        f"SELECT *, {n} AS batch FROM ({_CSV_COMMON.replace(_ARRIVAL, f"TIMESTAMP '{arrival}'")}) c{n}".replace(
            "FROM events)", f"FROM (SELECT * REPLACE (value + {add} AS value) FROM events WHERE event_id % {every} = 0))")
        for n, (every, add, arrival) in enumerate(FD.FILE_BATCHES))


_ROWNUM_LATEST = """SELECT {cols} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {src} s0) s1
WHERE rn = 1"""

_SEED = """(SELECT * FROM (VALUES
    (CAST(1 AS BIGINT), 'job1', 'ok', TIMESTAMP '2021-01-21 12:00:00'),
    (CAST(2 AS BIGINT), 'job2', 'ok', TIMESTAMP '2021-01-21 12:10:00'),
    (CAST(3 AS BIGINT), 'job3', 'ok', TIMESTAMP '2021-01-21 12:30:00'))
  AS s(job_id, job_name, status, updated_time))"""

_NEW_IDS = f"""(SELECT job_name, CAST(job_id AS BIGINT) AS job_id, is_new FROM (
    SELECT s.job_name, s.job_id, false AS is_new
      FROM (SELECT DISTINCT o_orderpriority AS job_name FROM orders) n JOIN {_SEED} s USING (job_name)
    UNION ALL
    SELECT n.job_name,
           (SELECT coalesce(max(job_id), 0) FROM {_SEED} s2)
             + ROW_NUMBER() OVER (ORDER BY n.job_name) AS job_id,
           true AS is_new
      FROM (SELECT DISTINCT o_orderpriority AS job_name FROM orders) n
      WHERE n.job_name NOT IN (SELECT job_name FROM {_SEED} s3)) ids)"""

_JOB_STATE = f"""(SELECT i.job_id, u.job_name, u.status, u.updated_time FROM (
    SELECT * FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY job_name ORDER BY updated_time DESC, seq DESC) AS rn
      FROM (SELECT o_orderpriority AS job_name, o_orderstatus AS status, o_orderdate AS updated_time,
                   o_orderkey AS seq FROM orders) o) r
    WHERE rn = 1) u JOIN {_NEW_IDS} i USING (job_name)
  UNION ALL
  SELECT job_id, job_name, status, updated_time FROM {_SEED} s
  WHERE job_name NOT IN (SELECT o_orderpriority FROM orders))"""

ORACLES: dict[str, str] = {
    "ingest_csv": _CSV_COMMON,
    "ingest_json": _JSON_COMMON,
    "bad_records": f"""SELECT {_CSV_BAD} AS original_line,
  CASE event_type WHEN 'click' THEN 'unknown_record_type' WHEN 'error' THEN 'missing_field'
       ELSE 'bad_value' END AS bad_reason
FROM {_E} e WHERE event_type NOT IN ('purchase', 'view')""",
    "bad_json_records": f"""SELECT {_JSON_BAD} AS original_line,
  CASE event_type WHEN 'click' THEN 'unknown_record_type' WHEN 'error' THEN 'bad_json'
       ELSE 'missing_field' END AS bad_reason
FROM {_E} e WHERE event_type NOT IN ('purchase', 'view')""",
    "ingest_files": f"SELECT {', '.join(COMMON_EVENT_COLUMNS)} FROM ({_file_batches()}) f",
    "clean_versions": f"""SELECT trade_dt, rec_type, symbol, exchange, event_time, event_seq_num, arrival_time,
  CASE rec_type WHEN 'T' THEN trade_price END AS trade_price, CASE rec_type WHEN 'T' THEN trade_size END AS trade_size,
  CASE rec_type WHEN 'Q' THEN bid_price END AS bid_price, CASE rec_type WHEN 'Q' THEN bid_size END AS bid_size,
  CASE rec_type WHEN 'Q' THEN ask_price END AS ask_price, CASE rec_type WHEN 'Q' THEN ask_size END AS ask_size
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY rec_type, trade_dt, symbol, exchange, event_time, event_seq_num
                                   ORDER BY arrival_time DESC, batch DESC) AS rn
      FROM ({_file_batches()}) f WHERE "partition" <> 'B') v WHERE rn = 1""",
    "ingest_counts": f"""SELECT "partition", count(*) AS n_rows FROM ({_CSV_COMMON}) c GROUP BY 1""",
    "ingest_summary": f"""SELECT "partition", count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols,
  count(DISTINCT trade_dt) AS n_dates, min(event_time) AS min_event_time, max(event_time) AS max_event_time,
  CAST(sum(CASE WHEN original_line <> '' THEN 1 ELSE 0 END) AS BIGINT) AS n_with_line,
  {', '.join(f"count(*) - count({c}) AS null_{c}" for c in COMMON_EVENT_COLUMNS if c != "partition")},
  {', '.join(f"count(*) FILTER (NOT isfinite({c})) AS nonfinite_{c}" for c in ("trade_price", "bid_price", "ask_price"))}
FROM ({_CSV_COMMON}) c GROUP BY 1""",
    "trade_select": _TRADE_SELECT,
    "quote_select": _QUOTE_SELECT,
    "event_text": f"""SELECT "partition", CASE WHEN rec_type IN ('T', 'Q') THEN
  '(' || concat_ws(', ', strftime(trade_dt, '%Y-%m-%d'), rec_type, symbol, strftime(event_time, '%Y-%m-%d'),
     exchange, CAST(event_seq_num AS VARCHAR), strftime(arrival_time, '%Y-%m-%d'),
     CAST(trade_price AS VARCHAR), CAST(trade_size AS VARCHAR), CAST(bid_price AS VARCHAR),
     CAST(bid_size AS VARCHAR), CAST(ask_price AS VARCHAR), CAST(ask_size AS VARCHAR)) || ')'
  ELSE original_line END AS event_text
FROM ({_CSV_COMMON}) c""",
    "quote_spread": f"""SELECT trade_dt, symbol, exchange, event_time, event_seq_num,
  round(ask_price - bid_price, 6) + CAST(0 AS DOUBLE) AS spread FROM {_QUOTES} q""",
    "distinct_dates": f"SELECT DISTINCT trade_dt FROM {_TRADES} t",
    "latest_trade_version": _ROWNUM_LATEST.format(
        cols="trade_dt, symbol, exchange, arrival_time, event_time, event_seq_num, trade_price, trade_size",
        key="trade_dt, symbol, exchange", order="arrival_time DESC, event_seq_num DESC", src=_TRADES),
    "latest_quote_version": _ROWNUM_LATEST.format(
        cols="trade_dt, symbol, exchange, arrival_time, event_time, event_seq_num, bid_price, bid_size, "
             "ask_price, ask_size",
        key="trade_dt, symbol, exchange", order="arrival_time DESC, event_seq_num DESC", src=_QUOTES),
    "dedup_lineitem": _ROWNUM_LATEST.format(
        cols="l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
             "l_tax, l_returnflag, l_linestatus, l_shipdate",
        key="l_orderkey, l_linenumber", order="l_shipdate DESC, l_partkey DESC, l_suppkey DESC",
        src="lineitem"),
    "versions_per_key": """SELECT l_orderkey, l_linenumber, count(*) AS n_versions,
  count(DISTINCT l_shipdate) AS n_distinct_versions, min(l_shipdate) AS first_version,
  max(l_shipdate) AS last_version FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "moving_avg_rows": f"""SELECT trade_dt, symbol, exchange, event_time, event_seq_num, trade_price,
  round(avg_trade_price, 6) AS avg_trade_price FROM {_MA_T} m""",
    "moving_avg_30m": f"""SELECT trade_dt, symbol, exchange, event_time, event_seq_num, trade_price,
  round(avg_trade_price, 6) AS avg_trade_price FROM {_MA30_T} m""",
    "last_value_per_trade": f"""SELECT m.trade_dt, m.symbol, m.exchange, m.event_time, m.event_seq_num,
  m.trade_price, l.last_trade_price, round(l.last_avg_trade_price, 6) AS last_avg_trade_price
FROM {_MA_T} m JOIN {_LAST_T} l ON m.trade_dt = l.trade_dt AND m.symbol = l.symbol""",
    "day_last_trade": f"""SELECT trade_dt, symbol, last_trade_price,
  round(last_avg_trade_price, 6) AS last_avg_trade_price FROM {_LAST_T} l""",
    "close_price": f"""SELECT trade_dt, symbol, exchange, round(close_price, 6) AS close_price
FROM {_CLOSE_T} c""",
    "quote_last_trade": f"""SELECT DISTINCT q.trade_dt, 'Q' AS rec_type, q.symbol, q.event_time, q.event_seq_num,
  q.exchange, q.bid_price, q.bid_size, q.ask_price, q.ask_size,
  l.last_trade_price, round(l.last_avg_trade_price, 6) AS last_avg_trade_price
FROM {_QUOTES} q JOIN {_LAST_T} l ON q.trade_dt = l.trade_dt AND q.symbol = l.symbol""",
    "quote_prev_close": f"""SELECT q.trade_dt, q.symbol, q.event_time, q.event_seq_num, q.exchange,
  q.bid_price, q.bid_size, q.ask_price, q.ask_size, round(c.close_price, 6) AS close_price
FROM {_QUOTES} q JOIN {_CLOSE_T} c
  ON c.trade_dt + 1 = q.trade_dt AND c.symbol = q.symbol AND c.exchange = q.exchange""",
    "quote_report": _REPORT,
    "quote_report_trading_day": _REPORT_TRADING_DAY,
    "quote_report_asof": _ASOF_REPORT,
    "report_preview": f"""SELECT * FROM ({_REPORT}) r
ORDER BY trade_dt, symbol, event_time, event_seq_num, exchange LIMIT {PREVIEW_ROWS}""",
    "quote_asof_trade": _asof_sql(f"(SELECT *, trade_price AS last_trade_price FROM {_TRADES} t1)",
                                  ["last_trade_price"], ">="),
    "quote_asof_avg": _asof_sql(f"(SELECT *, avg_trade_price AS last_avg_trade_price FROM {_MA30_T} m)",
                                ["last_avg_trade_price"], ">="),
    "quote_asof_strict": _asof_sql(f"(SELECT *, trade_price AS last_trade_price FROM {_TRADES} t1)",
                                   ["last_trade_price"], ">"),
    "quote_trade_same_time": f"""SELECT DISTINCT q.trade_dt, q.symbol, q.event_time, q.event_seq_num,
  q.exchange, q.bid_price, q.bid_size, q.ask_price, q.ask_size,
  l.last_trade_price, round(l.last_avg_trade_price, 6) AS last_avg_trade_price
FROM ({_QUOTE_SELECT}) q
JOIN ({_TRADE_SELECT}) t ON q.trade_dt = t.trade_dt AND q.symbol = t.symbol AND q.event_time = t.event_time
JOIN {_LAST.format(ma=_MA.format(trades=f"({_TRADE_SELECT})"))} l
  ON q.trade_dt = l.trade_dt AND q.symbol = l.symbol""",
    "quote_union": f"""SELECT trade_dt, 'T' AS rec_type, symbol, event_time, CAST(NULL AS BIGINT) AS event_seq_num,
  exchange, CAST(NULL AS DOUBLE) AS bid_price, CAST(NULL AS BIGINT) AS bid_size,
  CAST(NULL AS DOUBLE) AS ask_price, CAST(NULL AS BIGINT) AS ask_size, trade_price,
  round(avg_trade_price, 6) AS mov_avg_pr
FROM {_MA_T} m
UNION
SELECT trade_dt, 'Q', symbol, event_time, event_seq_num, exchange, bid_price, bid_size, ask_price,
  ask_size, NULL, NULL FROM {_QUOTES} q""",
    "exchange_overlap": f"""SELECT exchange FROM {_TRADES} t INTERSECT SELECT exchange FROM {_QUOTES} q""",
    "landing_roundtrip": _CSV_COMMON,
    "daily_roundtrip": _TRADE_SELECT,
    "daily_slice": f"""SELECT trade_dt, symbol, exchange, event_time, event_seq_num, trade_price
FROM ({_TRADE_SELECT}) t WHERE trade_dt = DATE '{SLICE_DATE}'""",
    "report_roundtrip": _REPORT,
    "sql_views": _REPORT,
    "next_job_id": f"SELECT * FROM {_NEW_IDS} n",
    "job_upsert": f"SELECT * FROM {_JOB_STATE} s",
    "job_status": f"SELECT job_id, status FROM {_JOB_STATE} s WHERE job_id = {STATUS_JOB_ID}",
}
# ``quote_prev_close_broadcast`` is another join of the same rows.
ORACLES["quote_prev_close_broadcast"] = ORACLES["quote_prev_close"]
