"""Publish record lines, one message or one text line each, from all tasks at once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_sink_options(
    servers: str,
    topic: str,
    *,
    batch_bytes: int = 16_384,
    linger_ms: int = 10,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of the topic writer. Gzip, batches of 16 KiB, 10 ms to fill one."""
    options = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.compression.type": "gzip",
        "kafka.batch.size": str(batch_bytes),
        "kafka.linger.ms": str(linger_ms),
    }
    return {**options, **(extra or {})}


def messages(lines: DataFrame) -> DataFrame:
    """Lines as UTF-8 message bodies; the key of a numbered line is its number."""
    body = F.encode("value", "UTF-8").alias("value")
    if "number" not in lines.columns:
        return lines.select(body)
    return lines.select(F.encode(F.col("number").cast("string"), "UTF-8").alias("key"), body)


def publish_to_kafka(
    lines: DataFrame, options: Mapping[str, str], *, connector: str = "kafka"
) -> None:
    """Needs Spark's Kafka connector, or another connector that takes the same options."""
    messages(lines).write.format(connector).options(**options).mode("append").save()


def publish_to_text(lines: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Lines as text files; the stand-in for a topic where there is none."""
    lines.select("value").write.mode(mode).text(path)
