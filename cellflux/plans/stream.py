"""Record lines as a stream to cleaned events and finished hourly windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cellflux.config import Settings, StreamSettings
from cellflux.operators import clean, decode_lines
from cellflux.streaming import (
    Outcome,
    drain_windows,
    finish_open,
    hourly_checkpoint,
    start_both,
    start_shared,
    supervise,
)


@dataclass(frozen=True)
class StreamPaths:
    """Dataset names under the output folder.

    The hourly dataset has a name of its own. If it shared the batch job's folder,
    its commit log would hide the batch files from readers.
    """

    output: str

    def _under(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}"

    @property
    def events(self) -> str:
        return self._under("streamed_events")

    @property
    def hourly(self) -> str:
        return self._under("streamed_hourly_aggregates")

    @property
    def open(self) -> str:
        return self._under("open_hourly_aggregates")

    @property
    def shared(self) -> str:
        return self._under("shared_stream")


def run_stream(
    lines: DataFrame,
    output: str,
    checkpoints: str,
    settings: Settings | None = None,
    stream: StreamSettings | None = None,
    *,
    drain: bool = False,
) -> Outcome:
    """Run both queries on a streaming `value` column until they end or the time is up.

    `drain` then writes the windows that are still open, as a dataset of their own; see `read_drained`.
    """
    stream = stream or StreamSettings()
    paths = StreamPaths(output)
    queries = start_both(
        clean(decode_lines(lines), settings),
        events_path=paths.events,
        hourly_path=paths.hourly,
        checkpoints=checkpoints,
        settings=settings,
        stream=stream,
    )
    outcome = supervise(
        queries,
        time_limit_seconds=stream.time_limit_seconds,
        until_all_end=stream.available_now,
    )
    if drain:
        drain_windows(lines.sparkSession, hourly_checkpoint(checkpoints), paths.open, settings)
    return outcome


def run_shared(
    lines: DataFrame,
    output: str,
    checkpoints: str,
    settings: Settings | None = None,
    stream: StreamSettings | None = None,
    *,
    drain: bool = False,
) -> Outcome:
    """Events, finished windows and late rows by one query over one read; see `read_shared`.

    `drain` counts the windows that are open at the end as finished.
    """
    stream = stream or StreamSettings()
    root = StreamPaths(output).shared
    query = start_shared(
        clean(decode_lines(lines), settings), root, f"{checkpoints.rstrip('/')}/shared", settings, stream
    )
    outcome = supervise(
        [query], time_limit_seconds=stream.time_limit_seconds, until_all_end=stream.available_now
    )
    if drain:
        finish_open(lines.sparkSession, root)
    return outcome
