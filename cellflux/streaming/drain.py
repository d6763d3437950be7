"""Windows that are still open when a stream has ended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.config import Settings
from cellflux.functions import event_day, event_hour
from cellflux.commits import replace_dataset
from cellflux.schema import HOURLY_PARTITIONS, TOTALS, WINDOWED_SCHEMA
from cellflux.sources.datasets import read_windowed


def open_windows(spark: SparkSession, checkpoint: str, settings: Settings | None = None) -> DataFrame:
    """Totals so far of the windows that a stopped hourly query holds in its state.

    The state is read through Spark's state source, at the last committed batch and in as many tasks as it has
    partitions. The query must not run meanwhile; its checkpoint stays as it is.
    """
    settings = settings or Settings()
    state = spark.read.format("statestore").load(checkpoint)
    # The sums have no names of their own in the state, only their order.
    sums = "struct<" + ",".join(f"{t}:double" for t in TOTALS) + ">"
    rows = state.select("key", F.col("value").cast(sums).alias("sums"))
    start = F.col("key").getField("window").getField("start")
    return rows.select(
        start.alias("window_start"),
        F.col("key").getField("window").getField("end").alias("window_end"),
        F.col("key").getField("cell_id").alias("cell_id"),
        "sums.*",
        event_day(start, settings.time_zone).alias("date"),
        event_hour(start, settings.time_zone).alias("hour"),
    ).select(WINDOWED_SCHEMA.fieldNames())


def drain_windows(
    spark: SparkSession, checkpoint: str, path: str, settings: Settings | None = None
) -> None:
    """Write the open windows as a dataset of their own, which the next drain replaces."""
    replace_dataset(open_windows(spark, checkpoint, settings).coalesce(1), path, HOURLY_PARTITIONS)


def read_drained(spark: SparkSession, closed_path: str, open_path: str) -> DataFrame:
    """Finished windows and, of those drained, the ones that have not been finished since."""
    closed, drained = read_windowed(spark, closed_path), read_windowed(spark, open_path)
    finished = closed.select("window_start", "cell_id")
    return closed.unionByName(drained.join(finished, ["window_start", "cell_id"], "left_anti"))
