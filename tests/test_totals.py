from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellflux import Settings
from cellflux.operators import (
    clean,
    daily_from_hourly,
    daily_totals,
    hourly_totals,
    tumbling_totals,
    valid_cells,
)
from cellflux.schema import (
    DAILY_SCHEMA,
    HOURLY_SCHEMA,
    MEASURES,
    RECORD_SCHEMA,
    TOTALS,
    WINDOWED_SCHEMA,
)
from cellflux.session import scoped_conf
from cellflux.sources.adapters import records_from_events, records_from_lineitem

from helpers import rounded

HOUR = 3_600_000


def records(spark, *rows):
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def row(cell, millis, country=39, *measures):
    return (cell, millis, country, *(measures or (1.0, 2.0, 3.0, 4.0, 5.0)))


def test_names_of_totals():
    assert TOTALS == [
        "sms_in_total", "sms_out_total", "call_in_total", "call_out_total", "internet_total",
    ]


def test_schemas(spark):
    events = clean(records(spark, row(1, 0)))
    for totals, schema in [
        (hourly_totals(events), HOURLY_SCHEMA),
        (daily_totals(events), DAILY_SCHEMA),
        (daily_from_hourly(hourly_totals(events)), DAILY_SCHEMA),
        (tumbling_totals(events), WINDOWED_SCHEMA),
    ]:
        assert [(f.name, f.dataType) for f in totals.schema] == [
            (f.name, f.dataType) for f in schema
        ]


def test_cell_bounds(spark):
    df = records(spark, *[row(c, 0) for c in (None, -1, 0, 1, 10000, 10001)])
    assert sorted(r.cell_id for r in valid_cells(df).collect()) == [1, 10000]
    wider = valid_cells(df, Settings(min_cell=0, max_cell=10001))
    assert sorted(r.cell_id for r in wider.collect()) == [0, 1, 10000, 10001]


def test_countries_are_added_together(spark):
    events = clean(records(spark, row(1, 0, 39), row(1, 5, 0), row(1, 9, None)))
    (total,) = hourly_totals(events).collect()
    assert [total[t] for t in TOTALS] == [3.0, 6.0, 9.0, 12.0, 15.0]


def test_rows_without_time(spark):
    events = clean(records(spark, row(1, None), row(1, None), row(1, 0)))
    by_date = {str(r.date): r.sms_in_total for r in daily_totals(events).collect()}
    assert by_date == {"None": 2.0, "1970-01-01": 1.0}
    by_hour = {r.hour: r.sms_in_total for r in hourly_totals(events).collect()}
    assert by_hour == {None: 2.0, 0: 1.0}
    assert [r.sms_in_total for r in tumbling_totals(events).collect()] == [1.0]


def test_totals_are_never_null_and_nan_is_kept(spark):
    nan = float("nan")
    events = clean(records(spark, row(1, 0, 39, None, -5.0, nan, 1.0, None), row(1, 0)))
    (total,) = hourly_totals(events).collect()
    assert (total.sms_in_total, total.sms_out_total) == (1.0, 2.0)
    assert math.isnan(total.call_in_total)
    assert (total.call_out_total, total.internet_total) == (5.0, 5.0)


def test_windows_close_on_the_hour(spark):
    events = clean(records(spark, row(1, 0), row(1, HOUR - 1), row(1, HOUR), row(2, HOUR)))
    windows = tumbling_totals(events).select(
        F.date_format("window_start", "HH:mm"),
        F.date_format("window_end", "HH:mm"),
        "cell_id",
        "hour",
        "sms_in_total",
    )
    assert sorted(map(tuple, windows.collect())) == [
        ("00:00", "01:00", 1, 0, 2.0),
        ("01:00", "02:00", 1, 1, 1.0),
        ("01:00", "02:00", 2, 1, 1.0),
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("sign", [1, -1])
def test_extreme_timestamps_fail_nothing(spark, ansi, sign):
    """Next to the largest instants, windows would overflow; those rows have no time."""
    largest = (2**63 - 1) // 1000
    far, farther = largest - 367 * 24 * HOUR, largest - HOUR // 2
    with scoped_conf(spark, {"spark.sql.ansi.enabled": ansi}):
        events = clean(records(spark, row(1, sign * far), row(2, sign * farther), row(3, 0)))
        windows = tumbling_totals(events).select(
            "cell_id", F.col("window_end").cast("long") - F.col("window_start").cast("long")
        )
        assert sorted(map(tuple, windows.collect())) == [(1, 3600), (3, 3600)]
        hours = hourly_totals(events).select("cell_id", F.col("date").isNull())
        assert sorted(map(tuple, hours.collect())) == [(1, False), (2, True), (3, False)]


def test_zone_decides_the_day(spark):
    df = records(spark, row(1, 1383260400000))
    assert [str(r.date) for r in daily_totals(clean(df)).collect()] == ["2013-10-31"]
    rome = daily_totals(clean(df, Settings(time_zone="Europe/Rome")))
    assert [str(r.date) for r in rome.collect()] == ["2013-11-01"]
    hours = tumbling_totals(clean(df), Settings(time_zone="Europe/Rome")).select("date", "hour")
    assert [(str(d), h) for d, h in hours.collect()] == [("2013-11-01", 0)]


@pytest.mark.parametrize("adapter", [records_from_events, records_from_lineitem])
def test_daily_equals_sum_of_hourly(spark, sf_dir, adapter):
    events = clean(adapter(spark, sf_dir))
    assert rounded(daily_from_hourly(hourly_totals(events))) == rounded(daily_totals(events))


@pytest.mark.parametrize("adapter", [records_from_events, records_from_lineitem])
def test_nothing_is_lost_between_events_and_totals(spark, sf_dir, adapter):
    events = clean(adapter(spark, sf_dir))
    whole = events.agg(*[F.round(F.sum(m), 2) for m in MEASURES]).first()
    for totals in (hourly_totals(events), daily_totals(events), tumbling_totals(events)):
        assert tuple(totals.agg(*[F.round(F.sum(t), 2) for t in TOTALS]).first()) == tuple(whole)


def test_clean_is_idempotent(spark, sf_dir):
    once = clean(records_from_events(spark, sf_dir))
    assert rounded(clean(once)) == rounded(once)


def test_clean_rows_are_valid(spark, sf_dir):
    events = clean(records_from_lineitem(spark, sf_dir))
    bad = F.lit(False)
    for m in MEASURES:
        bad = bad | F.col(m).isNull() | (F.col(m) < 0)
    assert events.filter(bad | ~F.col("cell_id").between(1, 10000)).isEmpty()


def test_a_hot_cell_and_hour_is_added_up_whole(spark, sf_dir):
    """A third of all rows on one key."""
    base = records_from_events(spark, sf_dir, valid_only=True)
    n = base.count()
    hot = base.withColumns({"cell_id": F.lit(7), "timestamp": F.lit(0).cast("long")})
    skewed = clean(base.unionByName(hot.limit(n // 2)).repartition(4))
    totals = hourly_totals(skewed)
    hot_total = totals.filter("cell_id = 7 AND date = '1970-01-01'").collect()
    assert len(hot_total) == 1
    expected = hot.limit(n // 2).agg(*[F.sum(m) for m in MEASURES]).first()
    for got, want in zip([hot_total[0][t] for t in TOTALS], expected, strict=True):
        assert got == pytest.approx(want or 0.0)


CELLS = st.none() | st.integers(-2, 10003)
TIMES = st.none() | st.integers(-3 * HOUR, 50 * HOUR)
VALUES = st.none() | st.integers(-100, 100).map(float)
ROWS = st.lists(st.tuples(CELLS, TIMES, st.none(), *[VALUES] * 5), min_size=1, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_hourly_matches_brute_force(spark, rows):
    want: dict = {}
    for cell, millis, _, *measures in rows:
        if cell is None or not 1 <= cell <= 10000:
            continue
        key = (cell, None if millis is None else millis // HOUR)
        sums = want.setdefault(key, [0.0] * 5)
        for i, m in enumerate(measures):
            sums[i] += m if m is not None and m >= 0 else 0.0
    slot = F.datediff("date", F.lit("1970-01-01").cast("date")) * 24 + F.col("hour")
    got = hourly_totals(clean(records(spark, *rows))).withColumn("slot", slot).collect()
    assert {(r.cell_id, r.slot): [r[t] for t in TOTALS] for r in got} == want
