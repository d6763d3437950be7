"""Epoch milliseconds to event time, date and hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark keeps timestamps as 64-bit microseconds; milliseconds beyond this cannot be held
# and would make `timestamp_millis` fail the whole job. Two days are left for the shift to
# a zone's local time.
_DAY_MICROS = 24 * 3_600_000_000
_MAX_MILLIS = (2**63 - 1 - 2 * _DAY_MICROS) // 1000
# The window around an instant must be held too.
_MAX_WINDOWED = 2**63 - 1 - 366 * _DAY_MICROS


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def event_instant(millis: str | Column) -> Column:
    """Timestamp with milliseconds kept; NULL where it cannot be represented."""
    millis = _column(millis)
    return F.when(millis.between(-_MAX_MILLIS, _MAX_MILLIS), F.timestamp_millis(millis))


def windowed_instant(instant: str | Column) -> Column:
    """The instant, or NULL where a window of up to a year around it cannot be represented."""
    instant = _column(instant)
    return F.when(F.unix_micros(instant).between(-_MAX_WINDOWED, _MAX_WINDOWED), instant)


def _local_micros(instant: str | Column, zone: str) -> Column:
    """Microseconds of the zone's local time, whatever the session's zone is."""
    instant = _column(instant)
    return F.unix_micros(instant if zone == "UTC" else F.from_utc_timestamp(instant, zone))


def _whole(micros: Column, unit: int) -> Column:
    """Full units before the instant, in whole numbers."""
    unit = F.lit(unit)
    return F.call_function("div", micros - F.pmod(micros, unit), unit)


def event_day(instant: str | Column, zone: str = "UTC") -> Column:
    return F.date_from_unix_date(_whole(_local_micros(instant, zone), _DAY_MICROS).cast("int"))


def event_hour(instant: str | Column, zone: str = "UTC") -> Column:
    hours = _whole(_local_micros(instant, zone), _DAY_MICROS // 24)
    return F.pmod(hours, F.lit(24)).cast("int")
