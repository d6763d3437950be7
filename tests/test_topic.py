"""Replay to a topic and stream from it, through the topic source and sink."""

from __future__ import annotations

from functools import partial

import pytest
from pyspark import cloudpickle

import topic
from cellflux import StreamSettings
from cellflux.operators import clean, decode_lines, encode_records, hourly_totals
from cellflux.plans import StreamPaths, run_replay
from cellflux.sinks import kafka_sink_options, publish_to_kafka, publish_to_text
from cellflux.sources import kafka_options, read_events, read_hourly, stream_kafka_lines
from cellflux.sources.adapters import records_from_events
from cellflux.streaming import start_both, supervise

from helpers import rounded

CONNECTOR = topic.FolderTopic.name()


@pytest.fixture
def servers(spark, tmp_path):
    cloudpickle.register_pickle_by_value(topic)
    spark.dataSource.register(topic.FolderTopic)
    (tmp_path / "activity").mkdir()
    yield str(tmp_path)
    cloudpickle.unregister_pickle_by_value(topic)


def test_replayed_table_streams_back_whole(spark, sf_dir, servers, tmp_path):
    source = str(tmp_path / "records")
    publish_to_text(encode_records(records_from_events(spark, sf_dir)), source)
    publish = partial(
        publish_to_kafka, options=kafka_sink_options(servers, "activity"), connector=CONNECTOR
    )
    run_replay(spark, source, publish)
    assert len(topic.messages_in(f"{servers}/activity")) == 1000

    options = kafka_options(servers, "activity", max_offsets_per_trigger=300)
    lines = stream_kafka_lines(spark, options, connector=CONNECTOR)
    assert lines.dtypes == [("value", "binary")]
    paths = StreamPaths(str(tmp_path / "out"))
    queries = start_both(
        clean(decode_lines(lines)),
        events_path=paths.events,
        hourly_path=paths.hourly,
        checkpoints=str(tmp_path / "cp"),
        stream=StreamSettings(
            events_trigger="1 second", hourly_trigger="1 second", state_partitions=2
        ),
    )
    for query in queries:
        query.processAllAvailable()
        assert sorted(p["numInputRows"] for p in query.recentProgress)[-4:] == [100, 300, 300, 300]
    assert supervise(queries, time_limit_seconds=0) == "time_limit"

    events = clean(records_from_events(spark, sf_dir))
    back = read_events(spark, paths.events)
    assert rounded(back.select(events.columns)) == rounded(events)
    hours = rounded(hourly_totals(events))
    streamed = rounded(read_hourly(spark, paths.hourly))
    assert set(streamed) <= set(hours) and len(hours) - len(streamed) < 10


def test_stripping_before_publishing_loses_lines_with_trailing_empty_fields(
    spark, sf_dir, servers, tmp_path
):
    source = str(tmp_path / "records")
    publish_to_text(encode_records(records_from_events(spark, sf_dir)), source)
    publish = partial(
        publish_to_kafka, options=kafka_sink_options(servers, "activity"), connector=CONNECTOR
    )
    run_replay(spark, source, publish, strip=True)
    messages = topic.messages_in(f"{servers}/activity")
    whole = [m for m in messages if m.count(b"\t") == 7]
    assert len(messages) == 1000
    purchases = records_from_events(spark, sf_dir).filter("internet IS NOT NULL").count()
    assert len(whole) == purchases
