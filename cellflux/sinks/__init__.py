"""Writers: partitioned Parquet, and record lines to a topic or to text files."""

from cellflux.sinks.publish import kafka_sink_options, publish_to_kafka, publish_to_text
from cellflux.sinks.tables import write_daily, write_events, write_hourly, write_sorted

__all__ = [
    "kafka_sink_options",
    "publish_to_kafka",
    "publish_to_text",
    "write_daily",
    "write_events",
    "write_hourly",
    "write_sorted",
]
