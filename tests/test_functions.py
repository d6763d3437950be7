from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.config import Settings
from cellflux.functions import field_value, record_line, repaired, strip_line
from cellflux.operators import decode_lines, encode_records, with_event_time
from cellflux.schema import RECORD_SCHEMA
from cellflux.session import scoped_conf

from helpers import lines_df


def parts(spark, *millis):
    df = spark.createDataFrame([(m,) for m in millis], "timestamp long")
    timed = with_event_time(df).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS"),
        F.date_format("date", "yyyy-MM-dd"),
        "hour",
    )
    return [tuple(r) for r in timed.collect()]


def test_event_time_keeps_milliseconds(spark):
    assert parts(spark, 1383260400123) == [("2013-10-31 23:00:00.123", "2013-10-31", 23)]


def test_event_time_of_null_is_null(spark):
    assert parts(spark, None) == [(None, None, None)]


def test_event_time_before_1970_goes_down(spark):
    assert parts(spark, -500) == [("1969-12-31 23:59:59.500", "1969-12-31", 23)]


@pytest.mark.parametrize("session_zone", ["UTC", "Europe/Rome", "Asia/Kolkata"])
def test_date_and_hour_are_in_the_settings_zone(spark, session_zone):
    millis = [1383260400000, 1382830200000, 1382833800000, -1]  # two of them when Rome's clock repeats an hour
    df = spark.createDataFrame([(m,) for m in millis], "timestamp long")
    with scoped_conf(spark, {"spark.sql.session.timeZone": session_zone}):
        for zone in ("UTC", "Europe/Rome", "+05:30"):
            timed = with_event_time(df, Settings(time_zone=zone)).select("timestamp", "date", "hour")
            local = timezone(timedelta(hours=5, minutes=30)) if zone[0] == "+" else ZoneInfo(zone)
            for row in timed.collect():
                want = datetime.fromtimestamp(row.timestamp / 1000, local)
                assert (row.date, row.hour) == (want.date(), want.hour)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_event_time_out_of_range_is_null_and_does_not_fail(spark, ansi):
    with scoped_conf(spark, {"spark.sql.ansi.enabled": ansi}):
        assert parts(spark, 2**63 - 1, -(2**63)) == [(None, None, None)] * 2


def test_event_time_types(spark):
    df = with_event_time(spark.createDataFrame([(0,)], "timestamp long"))
    assert dict(df.dtypes) == {
        "timestamp": "bigint",
        "event_time": "timestamp",
        "date": "date",
        "hour": "int",
    }


def test_repair(spark):
    values = [None, -1.0, 0.0, 2.5, float("nan"), float("inf"), float("-inf"), -0.0]
    df = spark.createDataFrame([(v,) for v in values], "m double")
    got = [r[0] for r in df.select(repaired("m")).collect()]
    assert got[:4] == [0.0, 0.0, 0.0, 2.5]
    assert math.isnan(got[4])
    assert got[5:7] == [math.inf, 0.0]
    assert got[7] == 0.0 and math.copysign(1, got[7]) == -1  # minus zero is kept


FIELDS = [
    # text, as int, as double
    ("7", 7, 7.0),
    (" 7", 7, 7.0),
    ("7 ", 7, 7.0),
    ("+7", 7, 7.0),
    ("-7", -7, -7.0),
    ("7.9", 7, 7.9),
    ("-7.9", -7, -7.9),
    (" 7. ", 7, 7.0),
    (".5", 0, 0.5),
    ("-.5", 0, -0.5),
    ("7.x", None, None),
    ("1e3", None, 1000.0),
    ("2147483647", 2147483647, 2147483647.0),
    ("2147483648", None, 2147483648.0),
    ("2147483648.5", None, 2147483648.5),
    ("", None, None),
    (" ", None, None),
    ("bad", None, None),
    ('"7"', None, None),
    ("NaN", None, math.nan),
    ("Infinity", None, math.inf),
    ("-Inf", None, -math.inf),
    (None, None, None),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_field_value(spark, ansi):
    with scoped_conf(spark, {"spark.sql.ansi.enabled": ansi}):
        rows = (
            lines_df(spark, [text for text, _, _ in FIELDS])
            .select(
                field_value(F.col("value"), T.IntegerType()),
                field_value(F.col("value"), T.LongType()),
                field_value(F.col("value"), T.DoubleType()),
            )
            .collect()
        )
    for (text, whole, number), (as_int, as_long, as_double) in zip(FIELDS, rows, strict=True):
        assert as_int == whole, text
        if text not in ("2147483648", "2147483648.5"):
            assert as_long == whole, text
        else:
            assert as_long == 2147483648
        if number is not None and math.isnan(number):
            assert math.isnan(as_double)
        else:
            assert as_double == number, text


def test_strip_matches_python(spark):
    lines = [
        "a\tb", "a\tb\t\t", " a ", "\x1c\x1fa\x85\xa0", "　a b ", "", "\t \t",
        "﻿a", "a​", " a    ",
    ]
    got = [r[0] for r in lines_df(spark, lines).select(strip_line("value")).collect()]
    assert got == [line.strip() for line in lines]


def test_strip_set_is_what_python_strips():
    from cellflux.functions.wire import STRIPPED

    assert sorted(STRIPPED) == [c for c in map(chr, range(0x110000)) if c.isspace()]


def test_line_has_an_empty_field_for_null(spark):
    df = spark.createDataFrame([(1, None, 39, 0.5, None, -1.0, None, None)], RECORD_SCHEMA)
    assert df.select(record_line()).first()[0] == "1\t\t39\t0.5\t\t-1.0\t\t"


INTS = st.none() | st.integers(-(2**31), 2**31 - 1)
LONGS = st.none() | st.integers(-(2**63), 2**63 - 1)
DOUBLES = st.none() | st.floats(allow_nan=False)
ROWS = st.lists(st.tuples(INTS, LONGS, INTS, *[DOUBLES] * 5), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_encode_then_decode_is_identity(spark, rows):
    df = spark.createDataFrame(rows, RECORD_SCHEMA)
    back = decode_lines(encode_records(df))
    assert back.schema == RECORD_SCHEMA
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))
