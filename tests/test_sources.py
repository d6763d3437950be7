from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cellflux.schema import RECORD_FIELDS, RECORD_SCHEMA
from cellflux.sources import (
    kafka_options,
    read_lines,
    read_records,
    stream_kafka_lines,
    stream_text_lines,
)
from cellflux.sources.adapters import records_from_events, records_from_lineitem

LINE = "{}\t1383260400000\t39\t1\t2\t3\t4\t5"


def test_schema_is_declared(spark, line_file):
    records = read_records(spark, line_file([LINE.format(1)]))
    assert records.schema == RECORD_SCHEMA
    assert RECORD_FIELDS == [
        "cell_id", "timestamp", "country_code",
        "sms_in", "sms_out", "call_in", "call_out", "internet",
    ]


def test_folder_means_all_its_txt_files(spark, line_file):
    line_file([LINE.format(1)], name="a.txt")
    line_file([LINE.format(2)], name="b.txt")
    folder = line_file([LINE.format(3)], name="c.csv")
    for path in (folder, folder + "/", folder + "/*.txt", folder + "/[ab].txt"):
        assert sorted(r.cell_id for r in read_records(spark, path).collect()) == [1, 2]
    assert [r.cell_id for r in read_records(spark, folder + "/b.txt").collect()] == [2]
    assert read_lines(spark, folder).count() == 2


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_records(spark, str(tmp_path))


def test_kafka_options():
    assert kafka_options("h1:9092,h2:9092", "activity") == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "activity",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10000000",
        "maxRecordsPerPartition": "1000000",
    }
    options = kafka_options(
        "h:1",
        "t",
        starting_offsets="latest",
        max_offsets_per_trigger=1000,
        max_records_per_task=None,
        fail_on_data_loss=True,
        extra={"kafka.security.protocol": "SSL"},
    )
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "true"
    assert options["kafka.security.protocol"] == "SSL"
    assert "maxRecordsPerPartition" not in options
    assert "maxOffsetsPerTrigger" not in kafka_options("h:1", "t", max_offsets_per_trigger=None)


def test_missing_kafka_connector_is_reported(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        stream_kafka_lines(spark, kafka_options("h:1", "t"))


def test_text_stream_has_the_value_column(spark, line_file):
    lines = stream_text_lines(spark, line_file([]), max_files_per_trigger=1)
    assert lines.isStreaming
    assert lines.dtypes == [("value", "string")]


@pytest.mark.parametrize("adapter", [records_from_events, records_from_lineitem])
def test_valid_only_keeps_exactly_the_valid_cells(spark, sf_dir, adapter):
    whole = adapter(spark, sf_dir).filter(F.col("cell_id").between(1, 10000))
    pruned = adapter(spark, sf_dir, valid_only=True)
    assert pruned.count() == whole.count()
    assert pruned.exceptAll(whole).isEmpty()
