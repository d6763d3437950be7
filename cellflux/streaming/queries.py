"""The cleaned-event query and the hourly query.

Each is exactly-once: the checkpoint holds the source position and the window
state, and the file sink commits each micro-batch once, so a query that lost an
executor or was stopped goes on where it was. Readers of the datasets should use
Spark, which follows the sink's commit log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cellflux.config import Settings, StreamSettings
from cellflux.operators import tumbling_totals
from cellflux.schema import EVENTS_PARTITIONS, HOURLY_PARTITIONS, SORTED_PARTITIONS
from cellflux.session import scoped_conf

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def in_reach(events: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Events without an event time where it is further ahead of their arrival than the settings allow.

    The time of arrival is that of the micro-batch, which a restart repeats.
    """
    settings = settings or Settings()
    if settings.max_ahead is None:
        return events
    latest = F.current_timestamp() + F.expr(f"INTERVAL {settings.max_ahead}")
    return events.withColumn("event_time", F.when(F.col("event_time") <= latest, F.col("event_time")))


def streamed_hourly_totals(events: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Windowed totals under a watermark.

    The state is one row per open window and cell. A window is emitted once, when
    the watermark passes its end; rows for an already emitted window are dropped
    and counted in the query's progress. Rows too far ahead of the clock have no window and do not move the watermark.
    """
    settings = settings or Settings()
    reached = in_reach(events, settings)
    return tumbling_totals(reached.withWatermark("event_time", settings.watermark), settings)


def _writer(
    df: DataFrame, path: str, checkpoint: str, keys: list[str], trigger: dict
) -> DataStreamWriter:
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*keys)
        .outputMode("append")
        .trigger(**trigger)
    )


def start_sorted(
    sorted_rows: DataFrame, path: str, checkpoint: str, stream: StreamSettings | None = None
) -> StreamingQuery:
    """Append events and rejected lines of one parse, by kind and date."""
    stream = stream or StreamSettings()
    trigger = stream.trigger(stream.events_trigger)
    return _writer(sorted_rows, path, checkpoint, SORTED_PARTITIONS, trigger).start()


def start_events(
    events: DataFrame, path: str, checkpoint: str, stream: StreamSettings | None = None
) -> StreamingQuery:
    """Append cleaned events by date. No shuffle: each source task writes its own files."""
    stream = stream or StreamSettings()
    trigger = stream.trigger(stream.events_trigger)
    if stream.events_tasks:
        events = events.coalesce(stream.events_tasks)
    return _writer(events, path, checkpoint, EVENTS_PARTITIONS, trigger).start()


def start_hourly(
    events: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings | None = None,
    stream: StreamSettings | None = None,
) -> StreamingQuery:
    """Append finished hourly windows by date and hour.

    The closed windows of a micro-batch are regrouped so that each folder gets
    `stream.files_per_window` files per batch. That shuffle has a width of its own: it carries a row
    per closed window and cell, far less than the state.
    """
    stream = stream or StreamSettings()
    totals = streamed_hourly_totals(events, settings)
    keys = [F.col(c) for c in HOURLY_PARTITIONS]
    if stream.files_per_window > 1:
        keys.append(F.pmod(F.xxhash64("cell_id"), F.lit(stream.files_per_window)))
    totals = totals.repartition(stream.hourly_tasks, *keys)
    conf = {}
    if stream.rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = _ROCKSDB
        conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    if stream.state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(stream.state_partitions)
    trigger = stream.trigger(stream.hourly_trigger)
    with scoped_conf(events.sparkSession, conf):
        return _writer(totals, path, checkpoint, HOURLY_PARTITIONS, trigger).start()


def hourly_checkpoint(checkpoints: str) -> str:
    """Where `start_both` keeps the hourly query's progress and state."""
    return f"{checkpoints.rstrip('/')}/hourly"


def start_both(
    events: DataFrame,
    *,
    events_path: str,
    hourly_path: str,
    checkpoints: str,
    settings: Settings | None = None,
    stream: StreamSettings | None = None,
) -> list[StreamingQuery]:
    """Start both queries on one cleaned stream, each with its own checkpoint.

    If the second cannot start, the first is stopped and the error goes on.
    """
    root = checkpoints.rstrip("/")
    first = start_events(events, events_path, f"{root}/events", stream)
    try:
        second = start_hourly(events, hourly_path, hourly_checkpoint(checkpoints), settings, stream)
    except BaseException:
        first.stop()
        raise
    return [first, second]
