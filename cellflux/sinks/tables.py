"""Batch Parquet sinks. Each write replaces the whole dataset at its path, or, if it fails, nothing of it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cellflux.commits import replace_dataset
from cellflux.schema import (
    DAILY_PARTITIONS,
    EVENTS_PARTITIONS,
    HOURLY_PARTITIONS,
    SORTED_PARTITIONS,
)
from cellflux.session import scoped_conf


def _regrouped(df: DataFrame, path: str, keys: list[str], task_bytes: str) -> None:
    """Write with the rows of each folder together, in tasks of about `task_bytes`.

    Adaptive execution merges small folders into one task and splits one that is larger over
    several, whatever the cluster's size and whichever folder is hot.
    """
    adaptive = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": task_bytes,
    }
    with scoped_conf(df.sparkSession, adaptive):
        replace_dataset(df.hint("rebalance", *keys), path, keys)


def write_events(
    events: DataFrame, path: str, *, regroup: bool = False, task_bytes: str = "256m"
) -> None:
    """Cleaned events by date, without a shuffle: each scan task writes its own files.

    That suits input whose files hold a date or two each. Where dates are mixed in every
    file, each task would leave a small file for every date; `regroup` then brings the
    rows of a date together in one shuffle, in tasks of about `task_bytes`. Adaptive
    execution splits a date that is larger over several tasks and merges smaller ones.
    """
    if regroup:
        _regrouped(events, path, EVENTS_PARTITIONS, task_bytes)
    else:
        replace_dataset(events, path, EVENTS_PARTITIONS)


# Totals are small and their folders many. What takes time is the count of files, not the
# bytes, so tasks are small; a usual folder (10,000 cells) still fits into one.
_TOTALS_TASK = "1m"


def write_daily(daily: DataFrame, path: str, *, task_bytes: str = _TOTALS_TASK) -> None:
    _regrouped(daily, path, DAILY_PARTITIONS, task_bytes)


def write_hourly(hourly: DataFrame, path: str, *, task_bytes: str = _TOTALS_TASK) -> None:
    _regrouped(hourly, path, HOURLY_PARTITIONS, task_bytes)


def write_sorted(sorted_rows: DataFrame, path: str) -> None:
    """Events and rejected lines of one parse, by kind and date, without a shuffle."""
    replace_dataset(sorted_rows, path, SORTED_PARTITIONS)
