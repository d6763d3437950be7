"""Readers: record files, message topics, and the datasets the jobs write."""

from cellflux.sources.datasets import read_daily, read_events, read_hourly, read_sorted, read_windowed
from cellflux.sources.records import read_lines, read_records
from cellflux.sources.streams import kafka_options, stream_kafka_lines, stream_text_lines

__all__ = [
    "kafka_options",
    "read_daily",
    "read_events",
    "read_hourly",
    "read_lines",
    "read_records",
    "read_sorted",
    "read_windowed",
    "stream_kafka_lines",
    "stream_text_lines",
]
