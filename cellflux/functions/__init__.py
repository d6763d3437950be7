"""Column expressions; all of them Spark built-ins that stay in generated code."""

from cellflux.functions.event_time import event_day, event_hour, event_instant, windowed_instant
from cellflux.functions.measures import repaired, total_columns
from cellflux.functions.wire import field_value, record_line, strip_line

__all__ = [
    "event_day",
    "event_hour",
    "event_instant",
    "field_value",
    "record_line",
    "repaired",
    "strip_line",
    "total_columns",
    "windowed_instant",
]
