"""The cleaning policy, shared by batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux.config import Settings
from cellflux.functions import event_day, event_hour, event_instant, repaired
from cellflux.schema import MEASURES, RECORD_FIELDS


def with_event_time(records: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Add `event_time`, and `date` and `hour` in the settings' zone; all NULL where the timestamp is."""
    zone = (settings or Settings()).time_zone
    return records.withColumn("event_time", event_instant("timestamp")).withColumns(
        {"date": event_day("event_time", zone), "hour": event_hour("event_time", zone)}
    )


def repair_measures(records: DataFrame, measures: list[str] = MEASURES) -> DataFrame:
    return records.withColumns({m: repaired(m) for m in measures})


def valid_cells(records: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Rows of a known cell. A NULL cell is not one."""
    settings = settings or Settings()
    return records.filter(F.col("cell_id").between(settings.min_cell, settings.max_cell))


def clean(records: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Records of valid cells, with repaired measures and event time."""
    cleaned = with_event_time(repair_measures(valid_cells(records, settings)), settings)
    return cleaned.select(*RECORD_FIELDS, "event_time", "date", "hour")
