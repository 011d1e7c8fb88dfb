import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import SAMPLE
from tickreport.sources.ingest import (bad_records, ingest_counts, parse_csv_lines, parse_json_lines,
                                       read_lines)

def _arrival():
    return F.lit("2021-01-03 00:00:00").cast("timestamp_ntz")


def _parse(spark, lines, fn=parse_csv_lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return fn(df, arrival_time=_arrival(), keep_reason=True).collect()


def test_sample_counts(spark):
    ev = parse_csv_lines(read_lines(spark, SAMPLE))
    counts = {r["partition"]: r["n_rows"] for r in ingest_counts(ev).collect()}
    assert counts == {"T": 30, "Q": 24, "B": 6}
    per_day = ev.where("partition != 'B'").groupBy("trade_dt", "partition").count().collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in per_day) == [
        ("2021-01-01", "Q", 12), ("2021-01-01", "T", 15), ("2021-01-02", "Q", 12), ("2021-01-02", "T", 15)]


def test_trade_and_quote_fields(spark):
    t, q = _parse(spark, [
        "2021-01-01,T,Symbol1,1,2021-01-01 12:00,1,Exchange1,59.970001,12",
        "2021-01-01,Q,Symbol1,2021-01-01 10:00,1,Exchange1,58.62,22,59.63,15",
    ])
    assert t["partition"] == "T" and t["rec_type"] == "T" and t["original_line"] == ""
    assert t["trade_dt"] == dt.date(2021, 1, 1)
    assert t["event_time"] == dt.datetime(2021, 1, 1, 12, 0)
    assert (t["trade_price"], t["trade_size"], t["bid_price"], t["bid_size"]) == (59.970001, 12, 0.0, 0)
    assert t["arrival_time"] == dt.datetime(2021, 1, 3)
    assert q["partition"] == "Q"
    assert (q["bid_price"], q["bid_size"], q["ask_price"], q["ask_size"]) == (58.62, 22, 59.63, 15)
    assert (q["trade_price"], q["trade_size"]) == (0.0, 0)


def test_edge_lines(spark):
    cases = {
        "2021-01-01,T,S,1,2021-01-01 12:00,1,E,59.9": ("B", "missing_field"),
        "2021-01-01,T,S,1,2021-01-01 12:00,1,E,59.9,12,extra": ("T", None),
        "2021-1-2,T,S,1,2021-1-2 9:05,1,E,59.9,12": ("T", None),
        "2021-02-30,T,S,1,2021-02-28 12:00,1,E,59.9,12": ("B", "bad_value"),
        "21-01-01,T,S,1,2021-01-01 12:00,1,E,59.9,12": ("B", "bad_value"),
        "2021-01-01,T,S,1,2021-01-01 12:00:30,1,E,59.9,12": ("B", "bad_value"),
        "2021-01-01,T,S,1,2021-01-01 12:00,1,E,59.9,12.0": ("B", "bad_value"),
        "2021-01-01,T,S,1,2021-01-01 12:00,1,E,1d,12": ("B", "bad_value"),
        "2021-01-01,T,S,1,2021-01-01 12:00, 7 ,E, 59.9 , 12 ": ("T", None),
        "2021-01-01,t,S,1,2021-01-01 12:00,1,E,59.9,12": ("B", "unknown_record_type"),
        "": ("B", "blank_line"),
        "# comment": ("B", "unknown_record_type"),
        "2021-01-01,Q,S,2021-01-01 10:00,1,E,58.62,22,59.63": ("B", "missing_field"),
    }
    rows = _parse(spark, list(cases))
    for line, row in zip(cases, rows):
        assert (row["partition"], row["bad_reason"]) == cases[line], line
        if row["partition"] == "B":
            assert row["original_line"] == line
            assert row["symbol"] is None and row["trade_dt"] is None and row["arrival_time"] is None
    blanks = rows[8]
    assert (blanks["event_seq_num"], blanks["trade_price"], blanks["trade_size"]) == (7, 59.9, 12)
    assert rows[2]["event_time"] == dt.datetime(2021, 1, 2, 9, 5)


def test_json_lines(spark):
    good_t = {"trade_date": "2021-01-01", "record_type": "T", "symbol": "S", "executionid": "1",
              "event_time": "2021-01-01 12:00", "event_seq_num": "1", "exchange": "E",
              "trade_price": "59.9", "trade_size": 12}
    good_q = {"trade_date": "2021-01-01", "record_type": "Q", "symbol": "S",
              "event_time": "2021-01-01 10:00", "event_seq_num": 2, "exchange": "E",
              "bid_price": 58.62, "bid_size": "22", "ask_price": "59.63", "ask_size": 15}
    missing = dict(good_t)
    del missing["trade_size"]
    lines = [json.dumps(good_t), json.dumps(good_q), '{"trade_date": "2021-01-01", ',
             json.dumps(missing), json.dumps({**good_t, "record_type": "X"})]
    rows = _parse(spark, lines, parse_json_lines)
    assert [r["partition"] for r in rows] == ["T", "Q", "B", "B", "B"]
    assert [r["bad_reason"] for r in rows] == [None, None, "bad_json", "missing_field", "unknown_record_type"]
    assert rows[0]["trade_size"] == 12 and rows[1]["bid_price"] == 58.62 and rows[1]["event_seq_num"] == 2
    assert rows[2]["original_line"] == lines[2]


def test_bad_records_keep_line(spark):
    ev = parse_csv_lines(read_lines(spark, SAMPLE), keep_reason=True)
    bad = bad_records(ev).collect()
    assert len(bad) == 6
    assert sum(1 for r in bad if r["original_line"].startswith("#")) == 2
    assert sum(1 for r in bad if r["bad_reason"] == "blank_line") == 4


def test_ingest_seq_orders_lines_within_file(spark):
    ev = parse_csv_lines(read_lines(spark, SAMPLE)).where("partition = 'Q'")
    # The duplicate quote key: the later line must carry the greater tag.
    dup = ev.where("symbol = 'CORE' AND event_seq_num = 27").orderBy("ingest_seq").collect()
    assert [r["bid_price"] for r in dup] == [200.4, 200.1, 198.2, 198.7]


def test_filters_stay_above_the_parser(spark):
    ev = parse_csv_lines(read_lines(spark, SAMPLE)).where("partition = 'T'").select("symbol")
    plan = ev._jdf.queryExecution().optimizedPlan().toString()
    # The filter on the parsed label sits above the generator that emits the
    # records; nothing of the parser is evaluated inside it.
    filt = [line for line in plan.split("\n") if "Filter" in line]
    assert filt and all("split(" not in line and "gettimestamp" not in line for line in filt)
    assert ev.count() == 30


def test_later_file_wins_within_one_batch(spark, tmp_path):
    import os
    from tickreport.operators.clean import clean_trades, select_trades
    old = tmp_path / "a_late_name_but_older.csv"
    new = tmp_path / "b_newer.csv"
    old.write_text("2021-01-01,T,S,1,2021-01-01 12:00,1,E,10.0,1\n2021-01-01,T,S,2,2021-01-01 12:05,2,E,20.0,2\n")
    new.write_text("2021-01-01,T,S,1,2021-01-01 12:00,1,E,11.0,9\n")
    os.utime(old, (1_600_000_000, 1_600_000_000))
    os.utime(new, (1_700_000_000, 1_700_000_000))
    ev = parse_csv_lines(read_lines(spark, str(tmp_path)), arrival_time=_arrival())
    got = {r["event_seq_num"]: (r["trade_price"], r["trade_size"]) for r in clean_trades(select_trades(ev)).collect()}
    assert got == {1: (11.0, 9), 2: (20.0, 2)}
    # Reversing the modification times reverses the winner.
    os.utime(old, (1_800_000_000, 1_800_000_000))
    ev = parse_csv_lines(read_lines(spark, str(tmp_path)), arrival_time=_arrival())
    got = {r["event_seq_num"]: (r["trade_price"], r["trade_size"]) for r in clean_trades(select_trades(ev)).collect()}
    assert got == {1: (10.0, 1), 2: (20.0, 2)}


def test_json_files_through_daily_job(spark, tmp_path):
    import json as _json
    from tickreport.plans import daily_job
    src = tmp_path / "feed.json"
    recs = []
    for line in open(SAMPLE):
        f = line.rstrip("\n").split(",")
        if len(f) > 1 and f[1] == "T":
            recs.append(dict(zip(["trade_date", "record_type", "symbol", "executionid", "event_time",
                                  "event_seq_num", "exchange", "trade_price", "trade_size"], f)))
        elif len(f) > 1 and f[1] == "Q":
            recs.append(dict(zip(["trade_date", "record_type", "symbol", "event_time", "event_seq_num",
                                  "exchange", "bid_price", "bid_size", "ask_price", "ask_size"], f)))
        else:
            recs.append(line.rstrip("\n"))
    src.write_text("\n".join(_json.dumps(r) if isinstance(r, dict) else r for r in recs) + "\n")
    out = daily_job.run_all(spark, str(src), str(tmp_path / "root"), fmt="json", dates=["2021-01-02"])
    assert spark.read.parquet(out).count() == 10


def test_json_line_is_one_whole_record(spark):
    good = ('{"trade_date":"2021-01-01","record_type":"T","symbol":"S","executionid":"1",'
            '"event_time":"2021-01-01 12:00","event_seq_num":1,"exchange":"E","trade_price":"1.5","trade_size":2}')
    lines = [good, good + " trailing", good + good, good + "," + good, "[" + good + "]", good[:-1], ""]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, ingest_seq int")
    got = {r["ingest_seq"]: r["partition"] for r in parse_json_lines(df).collect()}
    assert got == {0: "T", 1: "B", 2: "B", 3: "B", 4: "B", 5: "B", 6: "B"}
