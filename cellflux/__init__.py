"""Activity totals per cell on PySpark: batch and streaming."""

from cellflux.config import Settings, StreamSettings, object_store_conf
from cellflux.operators import (
    clean,
    daily_from_hourly,
    daily_totals,
    decode_lines,
    encode_records,
    hourly_totals,
    tumbling_totals,
)
from cellflux.session import build_session

__all__ = [
    "Settings",
    "StreamSettings",
    "build_session",
    "clean",
    "daily_from_hourly",
    "daily_totals",
    "decode_lines",
    "encode_records",
    "hourly_totals",
    "object_store_conf",
    "tumbling_totals",
]
