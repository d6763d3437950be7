"""Lines of record files to a topic, as a source for the stream job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellflux.functions import strip_line
from cellflux.operators import file_order, head_of_files, numbered_lines
from cellflux.sources import read_lines


def replay_lines(
    spark: SparkSession,
    path: str,
    *,
    max_lines: int | None = None,
    ordered: bool = False,
    strip: bool = False,
) -> DataFrame:
    """All lines of the files, or the first `max_lines` in the order of their paths.

    `ordered` brings them into one task in the order of the files; otherwise as many tasks as read them
    have them in no order. The lines are the same.
    """
    lines = read_lines(spark, path)
    if max_lines is not None:
        lines = head_of_files(lines, max_lines)
    if ordered:
        lines = lines.orderBy(*file_order(lines)).coalesce(1)
    value = strip_line("value") if strip else lines["value"]
    return lines.select(value.alias("value"))


def replay_numbered(spark: SparkSession, path: str, *, strip: bool = False) -> DataFrame:
    """All lines with their `number` in the order of the files, from as many tasks as read them.

    Published, the number is the message's key: a reader can restore the order that no writer had to keep.
    """
    lines = numbered_lines(read_lines(spark, path))
    return lines.withColumn("value", strip_line("value")) if strip else lines


def run_replay(
    spark: SparkSession,
    path: str,
    publish: Callable[[DataFrame], None],
    *,
    max_lines: int | None = None,
    ordered: bool = False,
    strip: bool = False,
    numbered: bool = False,
) -> None:
    """`numbered` publishes all lines with their numbers; it goes with no head and no order."""
    if numbered:
        if max_lines is not None or ordered:
            raise ValueError("numbered lines are all lines, in any order")
        publish(replay_numbered(spark, path, strip=strip))
        return
    publish(replay_lines(spark, path, max_lines=max_lines, ordered=ordered, strip=strip))
