"""Settings shared by the batch and the streaming jobs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """What the results depend on. The defaults are fixed values."""

    time_zone: str = "UTC"  # decides `date` and `hour`
    min_cell: int = 1
    max_cell: int = 10_000
    window: str = "1 hour"
    watermark: str = "10 minutes"
    # How far event time may run ahead of the clock. A row beyond it stays an event but has no window, so that a
    # wrong clock does not close the windows of all others. None: any time counts.
    max_ahead: str | None = "1 day"


@dataclass(frozen=True)
class StreamSettings:
    """How the streaming queries run; none of this changes a finished window.

    The trigger intervals are fixed values.
    """

    events_trigger: str = "30 seconds"
    hourly_trigger: str = "1 minute"
    available_now: bool = False  # drain what is there, then stop
    # Merge the source tasks of the event query into this many, each of which writes one
    # file per date and trigger. For topics of many partitions and short triggers.
    events_tasks: int | None = None
    # Shuffle partitions of the stateful query. Spark fixes the number in the
    # checkpoint at the first start, so choose it for the cluster's full size.
    state_partitions: int | None = None
    rocksdb_state: bool = True
    # Tasks that write closed windows, and files per window and batch. With many more cells than
    # 10,000, raise both.
    hourly_tasks: int = 8
    files_per_window: int = 1
    time_limit_seconds: float | None = None

    def trigger(self, interval: str) -> dict:
        return {"availableNow": True} if self.available_now else {"processingTime": interval}


def object_store_conf(
    endpoint: str | None = None,
    *,
    path_style: bool = True,
    ssl: bool = True,
    committer: str = "magic",
) -> dict[str, str]:
    """Spark settings for ``s3a://`` paths on an S3-compatible store.

    The S3A committer avoids the copy that a rename costs on an object store;
    it needs Spark's ``spark-hadoop-cloud`` module on the class path. Use
    ``committer="directory"`` where magic paths are off. Credentials come from
    the S3A provider chain (environment, instance role), never from here.
    """
    # The public setting names of S3A and of Spark's cloud committers.
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.committer.name": committer,
        "spark.hadoop.fs.s3a.committer.magic.enabled": str(committer == "magic").lower(),
        "spark.hadoop.mapreduce.outputcommitter.factory.scheme.s3a": (
            "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory"
        ),
        "spark.sql.sources.commitProtocolClass": (
            "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol"
        ),
        "spark.sql.parquet.output.committer.class": (
            "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter"
        ),
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    return conf
