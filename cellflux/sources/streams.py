"""Streaming scans of record lines: a message topic, or text files as they arrive."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


_ANY_AGE = "36500d"


def kafka_options(
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = 10_000_000,
    max_records_per_task: int | None = 1_000_000,
    fail_on_data_loss: bool = False,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of the topic reader.

    `max_offsets_per_trigger` bounds one micro-batch, so that a long backlog is
    taken in steps. `max_records_per_task` splits a topic partition over several
    tasks, so one full partition does not hold the batch up.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if max_records_per_task is not None:
        options["maxRecordsPerPartition"] = str(max_records_per_task)
    return {**options, **(extra or {})}


def stream_kafka_lines(
    spark: SparkSession, options: Mapping[str, str], *, connector: str = "kafka"
) -> DataFrame:
    """Messages of a topic as a binary `value`. Needs Spark's Kafka connector, or another
    connector that takes the same options.
    """
    return spark.readStream.format(connector).options(**options).load().select("value")


def stream_text_lines(
    spark: SparkSession,
    path: str,
    *,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Lines of the text files in a folder as `value`, oldest file first.

    However old a file is, it is read: Spark would by default leave out files a week older than
    the newest it has seen. The price is a log of all files ever seen, which is kept in the checkpoint.
    """
    options = {
        "maxFileAge": _ANY_AGE,
        "maxFilesPerTrigger": max_files_per_trigger,
        "maxBytesPerTrigger": max_bytes_per_trigger,
    }
    given = {name: str(value) for name, value in options.items() if value is not None}
    return spark.readStream.options(**given).text(path)
