"""Events, finished windows and late rows from one read of a stream.

Each micro-batch is read and parsed once and written as events; everything else starts from what was written. One
commit then makes the batch's events, its finished windows, its late rows, the totals of the windows still open and the
watermark the current state, all together: a batch that fails anywhere is done again from the start, and one
that is offered again after its commit is passed over. The log holds partition folders only. Folders of a date that
have become many are rewritten as one in the same commit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cellflux.commits import CommitLog, delete_parts, folder_key, read_parts, stage
from cellflux.config import Settings, StreamSettings
from cellflux.functions import event_day, windowed_instant
from cellflux.operators import tumbling_totals
from cellflux.schema import EVENTS_PARTITIONS, EVENTS_SCHEMA, HOURLY_PARTITIONS, TOTALS, WINDOWED_SCHEMA
from cellflux.session import scoped_conf
from cellflux.streaming.queries import in_reach

_TABLES: dict[str, tuple[StructType, list[str]]] = {
    "events": (EVENTS_SCHEMA, EVENTS_PARTITIONS),
    "hourly": (WINDOWED_SCHEMA, HOURLY_PARTITIONS),
    "late": (EVENTS_SCHEMA, EVENTS_PARTITIONS),
    "open": (WINDOWED_SCHEMA, HOURLY_PARTITIONS),
}
_EMPTY = {"batch": -1, "watermark": None, **{table: [] for table in _TABLES}}


@dataclass(frozen=True)
class Compaction:
    """When folders of one partition are rewritten as one.

    A date (for `hourly` an hour) that the watermark has left has one folder; one that is still open has
    up to `open_folders`.
    """

    open_folders: int = 60
    task_bytes: str = "256m"


def read_shared(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The committed rows of `events`, `hourly` (finished windows), `late` or `open` (windows still open)."""
    schema, _ = _TABLES[table]
    state = CommitLog(spark, root).latest() or _EMPTY
    return read_parts(spark, root, table, schema, state[table])


def _micros(instant: str) -> Column:
    return F.unix_micros(instant)


def _added_up(windows: DataFrame) -> DataFrame:
    keys = [c for c in windows.columns if c not in TOTALS]
    return windows.groupBy(*keys).agg(*[F.sum(t).alias(t) for t in TOTALS]).select(windows.columns)


def _compacted(
    spark: SparkSession, root: str, table: str, folders: list[str], name: str, left: str, how: Compaction
) -> list[str]:
    """The folders of a table after those of crowded partitions are one each. `left`: dates before are closed."""
    schema, keys = _TABLES[table]
    by_key: dict[str, list[str]] = {}
    for folder in folders:
        by_key.setdefault(folder_key(folder), []).append(folder)
    crowded = [
        key for key, own in by_key.items() if len(own) > (1 if _date(key) < left else how.open_folders)
    ]
    if not crowded:
        return folders
    some = [folder for key in crowded for folder in by_key[key]]
    rows = read_parts(spark, root, table, schema, some)
    conf = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": how.task_bytes}
    with scoped_conf(spark, conf):
        made = stage(rows.hint("rebalance", *keys), root, table, f"{name}-compact", keys)
    return [f for f in folders if folder_key(f) not in set(crowded)] + made


def _date(key: str) -> str:
    """The date of a partition folder; that of rows without one is never left."""
    value = key.split("/")[0].split("=", 1)[1]
    return value if value[:1].isdigit() else "~"


def _take(root: str, settings: Settings, how: Compaction | None):
    delay = f"INTERVAL {settings.watermark}"

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        log = CommitLog(spark, root)
        state = {**_EMPTY, **(log.latest() or {})}
        if number <= state["batch"]:
            return
        name = f"{number:012d}"
        written = stage(batch.select(EVENTS_SCHEMA.fieldNames()), root, "events", name, EVENTS_PARTITIONS)
        events = in_reach(read_parts(spark, root, "events", EVENTS_SCHEMA, written), settings)
        timed = events.filter(windowed_instant("event_time").isNotNull())
        before = state["watermark"]
        window_end = F.window("event_time", settings.window).getField("end")
        is_late = F.lit(False) if before is None else _micros(window_end) <= before
        judged = timed.withColumn("is_late", is_late)
        seen = judged.agg(
            F.max(_micros(F.col("event_time") - F.expr(delay))).alias("reached"),
            F.count_if("is_late").alias("late"),
        ).first()
        late = []
        if seen.late:
            rows = judged.filter("is_late").select(EVENTS_SCHEMA.fieldNames())
            late = stage(rows, root, "late", name, EVENTS_PARTITIONS)
        reached = [w for w in (before, seen.reached) if w is not None]
        watermark = max(reached) if reached else None

        totals = tumbling_totals(judged.filter(~F.col("is_late")), settings)
        held = read_parts(spark, root, "open", WINDOWED_SCHEMA, state["open"])
        windows = _added_up(held.unionByName(totals))
        closed = F.lit(False) if watermark is None else _micros("window_end") <= watermark
        sides = windows.withColumn("closed", closed)
        # Few rows, written twice from one small shuffle each: what is finished and what stays open.
        hourly = stage(_by_folder(sides.filter("closed").drop("closed")), root, "hourly", name, HOURLY_PARTITIONS)
        still = stage(_by_folder(sides.filter(~F.col("closed")).drop("closed")), root, "open", name, HOURLY_PARTITIONS)

        after = {
            "batch": number,
            "watermark": watermark,
            "events": state["events"] + written,
            "hourly": state["hourly"] + hourly,
            "late": state["late"] + late,
            "open": still,
        }
        if how and watermark is not None:
            left = _day_of(spark, watermark, settings)
            for table in ("events", "hourly", "late"):
                after[table] = _compacted(spark, root, table, after[table], name, left, how)
        log.commit(after)
        for table in _TABLES:
            if set(state[table]) - set(after[table]):
                delete_parts(spark, root, table, but=after[table])

    return take


def _by_folder(windows: DataFrame) -> DataFrame:
    return windows.hint("rebalance", *HOURLY_PARTITIONS)


def _day_of(spark: SparkSession, micros: int, settings: Settings) -> str:
    day = event_day(F.timestamp_micros(F.lit(micros)), settings.time_zone)
    return str(spark.range(1).select(day.alias("day")).first().day)


def start_shared(
    events: DataFrame,
    root: str,
    checkpoint: str,
    settings: Settings | None = None,
    stream: StreamSettings | None = None,
    compaction: Compaction | None = Compaction(),
) -> StreamingQuery:
    """One query for all outputs under `root`; see `read_shared`.

    The totals are those of the hourly query: a window is finished once the watermark has passed its end. A row of a window
    that an earlier batch has finished is late; it is an event like all others, in no total, and kept in
    `late`. The state between batches is a table of a row per open window and cell.
    """
    settings, stream = settings or Settings(), stream or StreamSettings()
    return (
        events.writeStream.foreachBatch(_take(root, settings, compaction))
        .option("checkpointLocation", checkpoint)
        .trigger(**stream.trigger(stream.events_trigger))
        .start()
    )


def finish_open(spark: SparkSession, root: str) -> None:
    """Count the open windows of an ended stream as finished: their rows are handed out with the others.

    Rows that arrive for them afterwards are late.
    """
    log = CommitLog(spark, root)
    state = log.latest()
    if not state or not state["open"]:
        return
    rows = read_parts(spark, root, "open", WINDOWED_SCHEMA, state["open"])
    last = rows.agg(F.max(_micros("window_end")).alias("last")).first().last
    name = f"{state['batch']:012d}-open"
    made = stage(_by_folder(rows), root, "hourly", name, HOURLY_PARTITIONS)
    watermark = max(w for w in (state["watermark"], last) if w is not None)
    log.commit({**state, "hourly": state["hourly"] + made, "open": [], "watermark": watermark})
    delete_parts(spark, root, "open", but=[])
