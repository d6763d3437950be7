"""The three jobs as functions of a session."""

from cellflux.plans.batch import BatchPaths, run_batch, run_sorted_batch
from cellflux.plans.incremental import Refresh, read_incremental, refresh_daily
from cellflux.plans.replay import replay_lines, replay_numbered, run_replay
from cellflux.plans.stream import StreamPaths, run_shared, run_stream

__all__ = [
    "BatchPaths",
    "Refresh",
    "StreamPaths",
    "read_incremental",
    "refresh_daily",
    "replay_lines",
    "replay_numbered",
    "run_batch",
    "run_replay",
    "run_shared",
    "run_sorted_batch",
    "run_stream",
]
