"""Session set-up, scoped settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Values for the jobs where the submitter has given none.
_JOB_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    # Larger splits than the usual 128 MB: fewer tasks, and fewer, larger event files.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Open up to this many partition writers per task before Spark falls back to
    # sorting the task's rows by partition. Day-sized input files hold one or two
    # dates, so the sort is almost never needed.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Unlike Spark's default type, this one has statistics that filters can use.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Adaptive execution merges small shuffle partitions but cannot split a total's large
    # ones. This does not depend on the cores that have registered so far.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
}



def build_session(
    app_name: str, extra: Mapping[str, str] | None = None
) -> SparkSession:
    """A session for the jobs. What spark-submit sets, cluster size and memory above all, stays."""
    builder = SparkSession.builder.appName(app_name)
    submitted = SparkConf()  # with the properties that spark-submit gave to this process
    for key, value in (extra or {}).items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in _JOB_DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


@contextmanager
def scoped_conf(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Set session values, then put back what was there before.

    A streaming query copies its session when it starts, so values set around
    ``start()`` belong to that query alone.
    """
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cellflux-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
