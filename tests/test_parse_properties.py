"""Typed field parsing agrees with Python's own int() / float() / strptime()
acceptance (the feed's rules) on generated text."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickreport.functions.parse import parse_date, parse_double, parse_event_time, parse_long

NUMBERISH = st.text(alphabet="0123456789+-._eE dfinaty\t", min_size=0, max_size=8)
DATEISH = st.builds(
    lambda y, m, d, sep, pad: f"{y}{sep}{str(m).zfill(2) if pad else m}{sep}{str(d).zfill(2) if pad else d}",
    st.sampled_from(["2021", "21", "0999", "2020"]), st.integers(0, 13), st.integers(0, 32),
    st.sampled_from(["-", "/"]), st.booleans())
TIMEISH = st.builds(lambda d, h, mi, extra: f"{d} {h}:{mi}{extra}",
                    DATEISH, st.integers(0, 25), st.integers(0, 61), st.sampled_from(["", ":00", " "]))


def _py_int(s):
    try:
        return int(s)
    except ValueError:
        return None


def _py_float(s):
    try:
        v = float(s)
    except ValueError:
        return None
    return "nan" if math.isnan(v) else v


def _py_time(s, fmt):
    try:
        return dt.datetime.strptime(s, fmt)
    except ValueError:
        return None


def _spark(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(NUMBERISH, min_size=1, max_size=60))
def test_numbers_match_python(spark, values):
    # Python also accepts non-ASCII digits and a few whitespace characters the
    # feed never carries; the generated alphabet is the feed's.
    longs = _spark(spark, values, parse_long)
    doubles = _spark(spark, values, parse_double)
    for v, got_l, got_d in zip(values, longs, doubles):
        want_l = _py_int(v)
        if want_l is not None and abs(want_l) >= 2 ** 63:
            want_l = None  # out of bigint range: rejected
        assert got_l == want_l, repr(v)
        want_d = _py_float(v)
        got = "nan" if isinstance(got_d, float) and math.isnan(got_d) else got_d
        assert got == want_d, repr(v)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(DATEISH, min_size=1, max_size=40), st.lists(TIMEISH, min_size=1, max_size=40))
def test_dates_and_times_match_python(spark, dates, times):
    got_d = _spark(spark, dates, parse_date)
    for v, got in zip(dates, got_d):
        want = _py_time(v, "%Y-%m-%d")
        assert got == (want.date() if want else None), repr(v)
    got_t = _spark(spark, times, parse_event_time)
    for v, got in zip(times, got_t):
        assert got == _py_time(v, "%Y-%m-%d %H:%M"), repr(v)
