"""Totals per cell and day, hour or event-time window.

Every total is a plain sum, so Spark adds up within each input task first and
shuffles one row per task and key: a cell or a day that holds a large share of
the rows does not make a large shuffle partition. No task ever holds a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux.config import Settings
from cellflux.functions import event_day, event_hour, total_columns, windowed_instant
from cellflux.schema import DAILY_SCHEMA, HOURLY_SCHEMA, TOTALS, WINDOWED_SCHEMA


def hourly_totals(events: DataFrame) -> DataFrame:
    totals = events.groupBy("date", "hour", "cell_id").agg(*total_columns())
    return totals.select(HOURLY_SCHEMA.fieldNames())


def daily_totals(events: DataFrame) -> DataFrame:
    totals = events.groupBy("date", "cell_id").agg(*total_columns())
    return totals.select(DAILY_SCHEMA.fieldNames())


def daily_from_hourly(hourly: DataFrame) -> DataFrame:
    """Daily totals from (unrounded) hourly ones: at most 24 rows per cell and day."""
    totals = hourly.groupBy("date", "cell_id").agg(*total_columns(of=TOTALS))
    return totals.select(DAILY_SCHEMA.fieldNames())


def tumbling_totals(events: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Totals per cell and event-time window; rows without event time have no window."""
    settings = settings or Settings()
    span = F.window("event_time", settings.window).alias("span")
    timed = events.filter(windowed_instant("event_time").isNotNull())
    totals = timed.groupBy(span, "cell_id").agg(*total_columns())
    return totals.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        "cell_id",
        *TOTALS,
        event_day("span.start", settings.time_zone).alias("date"),
        event_hour("span.start", settings.time_zone).alias("hour"),
    ).select(WINDOWED_SCHEMA.fieldNames())
