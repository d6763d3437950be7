"""Record files to cleaned events, hourly totals and daily totals.

Each step reads what the step before has written: the text is parsed once, the
hourly totals come from a pruned Parquet scan, and the daily totals add up the
far smaller hourly ones. A step that is run again replaces its own dataset only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession

from cellflux.config import Settings
from cellflux.operators import (
    clean,
    daily_from_hourly,
    hourly_totals,
    kept_events,
    line_counts,
    sorted_lines,
)
from cellflux.sinks import write_daily, write_events, write_hourly, write_sorted
from cellflux.sources import read_events, read_hourly, read_lines, read_records, read_sorted


@dataclass(frozen=True)
class BatchPaths:
    """Dataset names under the output folder."""

    output: str

    def _under(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}"

    @property
    def events(self) -> str:
        return self._under("raw_events")

    @property
    def sorted(self) -> str:
        return self._under("sorted_lines")

    @property
    def hourly(self) -> str:
        return self._under("hourly_aggregates")

    @property
    def daily(self) -> str:
        return self._under("daily_aggregates")


def run_sorted_batch(
    spark: SparkSession, input_path: str, output: str, settings: Settings | None = None
) -> tuple[BatchPaths, dict[str, int]]:
    """Events and rejected lines from one parse, and how many lines were read, kept and rejected.

    Lines are taken as the file reader takes them: short ones are padded, long ones cut. The totals follow from the
    events, which are one kind of the rows of `sorted_lines`.
    """
    paths, counts = BatchPaths(output), Observation("lines")
    rows = sorted_lines(read_lines(spark, input_path), settings, "pad")
    write_sorted(line_counts(rows, counts), paths.sorted)
    events = kept_events(read_sorted(spark, paths.sorted))
    write_hourly(hourly_totals(events), paths.hourly)
    write_daily(daily_from_hourly(read_hourly(spark, paths.hourly)), paths.daily)
    return paths, counts.get


def run_batch(
    spark: SparkSession,
    input_path: str,
    output: str,
    settings: Settings | None = None,
    *,
    regroup_events: bool = False,
    any_width: bool = False,
) -> BatchPaths:
    """`regroup_events` is for input files that mix many dates; see `write_events`.

    `any_width` is for files with lines of more than a million fields; see `read_records`.
    """
    paths = BatchPaths(output)
    events = clean(read_records(spark, input_path, any_width=any_width), settings)
    write_events(events, paths.events, regroup=regroup_events)
    write_hourly(hourly_totals(read_events(spark, paths.events)), paths.hourly)
    write_daily(daily_from_hourly(read_hourly(spark, paths.hourly)), paths.daily)
    return paths
