"""Activity records from the `events` and `lineitem` tables.

Call under a UTC session: both tables hold zone-less timestamps. Keys beyond the
integer range become NULL, which the cell filter rejects, instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.config import Settings
from cellflux.schema import MEASURES

# Which event type carries which measure.
EVENT_TYPE_OF = {
    "sms_in": "view",
    "sms_out": "click",
    "call_in": "signup",
    "call_out": "error",
    "internet": "purchase",
}


def _millis(local: str) -> Column:
    return F.unix_millis(F.col(local).cast("timestamp"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _of_valid_cells(table: DataFrame, key: str) -> DataFrame:
    """The cell filter on the table's own key column.

    Cleaning repeats it on `cell_id`, but a filter on the narrowed column stops at
    the cast. This one reaches the Parquet scan and skips row groups there.
    """
    settings = Settings()
    return table.filter(F.col(key).between(settings.min_cell, settings.max_cell))


def records_from_events(
    spark: SparkSession, sf_dir: str, value: Column | None = None, *, valid_only: bool = False
) -> DataFrame:
    """`event_id` and one record per event; four of the five measures are NULL."""
    value = F.col("value") if value is None else value
    events = read_table(spark, sf_dir, "events")
    if valid_only:
        events = _of_valid_cells(events, "user_id")
    return events.select(
        "event_id",
        F.col("user_id").try_cast("int").alias("cell_id"),
        _millis("ts").alias("timestamp"),
        (F.col("event_id") % 5).cast("int").alias("country_code"),
        *[
            F.when(F.col("event_type") == EVENT_TYPE_OF[m], value).alias(m)
            for m in MEASURES
        ],
    )


def records_from_lineitem(
    spark: SparkSession, sf_dir: str, *, valid_only: bool = False
) -> DataFrame:
    """One record per line item, keyed by its order."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    if valid_only:
        lineitem = _of_valid_cells(lineitem, "l_orderkey")
    return lineitem.select(
        F.col("l_orderkey").try_cast("int").alias("cell_id"),
        _millis("l_shipdate").alias("timestamp"),
        F.col("l_linenumber").alias("country_code"),
        F.col("l_quantity").alias("sms_in"),
        F.col("l_extendedprice").alias("sms_out"),
        F.col("l_discount").alias("call_in"),
        F.col("l_tax").alias("call_out"),
        F.col("l_linenumber").cast("double").alias("internet"),
    )
