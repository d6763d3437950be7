"""The activity record: field order on the wire, measures, and output schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, order and types of one record.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("cell_id", T.IntegerType()),
        T.StructField("timestamp", T.LongType()),  # epoch milliseconds
        T.StructField("country_code", T.IntegerType()),
        T.StructField("sms_in", T.DoubleType()),
        T.StructField("sms_out", T.DoubleType()),
        T.StructField("call_in", T.DoubleType()),
        T.StructField("call_out", T.DoubleType()),
        T.StructField("internet", T.DoubleType()),
    ]
)

# Field separator of a record line.
SEPARATOR = "\t"

RECORD_FIELDS = RECORD_SCHEMA.fieldNames()
MEASURES = [f.name for f in RECORD_SCHEMA if f.dataType == T.DoubleType()]
TOTALS = [f"{m}_total" for m in MEASURES]

DATE = T.StructField("date", T.DateType())
HOUR = T.StructField("hour", T.IntegerType())
EVENT_TIME = T.StructField("event_time", T.TimestampType())

_CELL = RECORD_SCHEMA["cell_id"]
_TOTAL_FIELDS = [T.StructField(t, T.DoubleType()) for t in TOTALS]

# Schemas as read back from disk: partition columns come last.
EVENTS_SCHEMA = T.StructType([*RECORD_SCHEMA, EVENT_TIME, HOUR, DATE])
DAILY_SCHEMA = T.StructType([_CELL, *_TOTAL_FIELDS, DATE])
HOURLY_SCHEMA = T.StructType([_CELL, *_TOTAL_FIELDS, DATE, HOUR])
WINDOWED_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        *HOURLY_SCHEMA,
    ]
)

# Events and rejected lines in one dataset.
SORTED_SCHEMA = T.StructType(
    [
        *RECORD_SCHEMA,
        EVENT_TIME,
        HOUR,
        T.StructField("line", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("kind", T.StringType()),
        DATE,
    ]
)

EVENTS_PARTITIONS = ["date"]
DAILY_PARTITIONS = ["date"]
HOURLY_PARTITIONS = ["date", "hour"]
SORTED_PARTITIONS = ["kind", "date"]
