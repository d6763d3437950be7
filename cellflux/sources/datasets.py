"""Readers of the written Parquet datasets, with declared schemas.

They read the files that the last finished write has committed. Filters on `date` and `hour` prune partition folders before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellflux.commits import read_dataset
from cellflux.schema import DAILY_SCHEMA, EVENTS_SCHEMA, HOURLY_SCHEMA, SORTED_SCHEMA, WINDOWED_SCHEMA


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_dataset(spark, path, EVENTS_SCHEMA)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return read_dataset(spark, path, DAILY_SCHEMA)


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return read_dataset(spark, path, HOURLY_SCHEMA)


def read_windowed(spark: SparkSession, path: str) -> DataFrame:
    return read_dataset(spark, path, WINDOWED_SCHEMA)


def read_sorted(spark: SparkSession, path: str) -> DataFrame:
    return read_dataset(spark, path, SORTED_SCHEMA)
