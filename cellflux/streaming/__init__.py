"""Structured Streaming: windowed totals, the two queries, and their supervision."""

from cellflux.streaming.drain import drain_windows, open_windows, read_drained
from cellflux.streaming.queries import (
    hourly_checkpoint,
    in_reach,
    start_both,
    start_events,
    start_hourly,
    start_sorted,
    streamed_hourly_totals,
)
from cellflux.streaming.shared import Compaction, finish_open, read_shared, start_shared
from cellflux.streaming.supervise import Outcome, supervise

__all__ = [
    "Compaction",
    "Outcome",
    "drain_windows",
    "finish_open",
    "hourly_checkpoint",
    "in_reach",
    "open_windows",
    "read_drained",
    "read_shared",
    "start_both",
    "start_events",
    "start_hourly",
    "start_shared",
    "start_sorted",
    "streamed_hourly_totals",
    "supervise",
]
