from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cellflux.operators import clean, daily_totals, encode_records, hourly_totals
from cellflux.schema import DAILY_SCHEMA, EVENTS_SCHEMA, HOURLY_SCHEMA, RECORD_SCHEMA, TOTALS
from cellflux.session import scoped_conf
from cellflux.sinks import (
    kafka_sink_options,
    publish_to_kafka,
    publish_to_text,
    write_daily,
    write_events,
    write_hourly,
)
from cellflux.sinks.publish import messages
from cellflux.sources import kafka_options, read_daily, read_events, read_hourly
from cellflux.sources.adapters import records_from_events

from helpers import lines_df, parquet_files, plan_of, rounded


@pytest.fixture
def events(spark, sf_dir):
    return clean(records_from_events(spark, sf_dir))


def test_events_round_trip(spark, events, tmp_path):
    path = str(tmp_path / "events")
    write_events(events, path)
    back = read_events(spark, path)
    assert back.schema == EVENTS_SCHEMA
    assert {p.parent.name.split("=")[0] for p in parquet_files(path)} == {"date"}
    assert rounded(back.select(events.columns)) == rounded(events)


def test_hourly_round_trip_with_one_file_per_folder(spark, events, tmp_path):
    path, totals = str(tmp_path / "hourly"), hourly_totals(events)
    write_hourly(totals, path)
    back = read_hourly(spark, path)
    assert back.schema == HOURLY_SCHEMA
    assert rounded(back) == rounded(totals)
    files = parquet_files(path)
    assert len(files) == totals.select("date", "hour").distinct().count()
    assert len({f.parent for f in files}) == len(files)


def test_daily_round_trip(spark, events, tmp_path):
    path, totals = str(tmp_path / "daily"), daily_totals(events)
    write_daily(totals, path)
    back = read_daily(spark, path)
    assert back.schema == DAILY_SCHEMA
    assert rounded(back) == rounded(totals)


def test_readers_prune_partitions(spark, events, tmp_path):
    path = str(tmp_path / "hourly")
    write_hourly(hourly_totals(events), path)
    some = read_hourly(spark, path).select("date", "hour").first()
    one = read_hourly(spark, path).filter(
        (F.col("date") == F.lit(some.date)) & (F.col("hour") == some.hour)
    )
    used = {r[0] for r in one.select(F.input_file_name()).collect()}
    assert used and all(f"date={some.date}/hour={some.hour}/" in name for name in used)
    assert "PartitionFilters: [isnotnull(date" in plan_of(one)


@pytest.fixture
def eight_tasks(spark, tmp_path):
    """Rows spread over eight files, each of which is read by a task of its own."""

    def spread(df):
        path = str(tmp_path / "spread")
        df.repartition(8).write.parquet(path)
        return spark.read.parquet(path)

    with scoped_conf(spark, {"spark.sql.files.openCostInBytes": "1g"}):
        yield spread


def test_mixed_dates_make_few_files_when_regrouped(spark, events, eight_tasks, tmp_path):
    mixed = eight_tasks(events)
    write_events(mixed, str(tmp_path / "plain"))
    write_events(mixed, str(tmp_path / "grouped"), regroup=True)
    days = events.select("date").distinct().count()
    assert len(parquet_files(tmp_path / "plain")) > 4 * days
    assert len(parquet_files(tmp_path / "grouped")) <= 2 * days
    back = read_events(spark, str(tmp_path / "grouped"))
    assert rounded(back.select(events.columns)) == rounded(events)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_hot_date_is_split_over_tasks_when_regrouped(
    spark, events, eight_tasks, tmp_path, adaptive
):
    """A third of the rows on one date, far above the task size: many files, nothing lost."""
    hot_day = F.when(F.col("cell_id") % 3 == 0, F.lit("2024-01-31").cast("date"))
    skewed = eight_tasks(events.withColumn("date", F.coalesce(hot_day, "date")))
    path = tmp_path / "grouped"
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": adaptive}):
        write_events(skewed, str(path), regroup=True, task_bytes="4k")
    assert len(list((path / "date=2024-01-31").glob("*.parquet"))) > 2
    assert rounded(read_events(spark, str(path)).select(events.columns)) == rounded(
        skewed.select(events.columns)
    )


def test_overwrite_leaves_nothing_behind(spark, events, tmp_path):
    path = str(tmp_path / "daily")
    write_daily(daily_totals(events), path)
    later = daily_totals(events.filter("date >= '2024-01-20'"))
    write_daily(later, path)
    write_daily(later, path)
    assert rounded(read_daily(spark, path)) == rounded(later)
    assert not list(Path(path).glob("date=2024-01-01"))


def test_overwrite_is_static_even_in_a_dynamic_session(spark, events, tmp_path):
    path = str(tmp_path / "daily")
    with scoped_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        write_daily(daily_totals(events), path)
        later = daily_totals(events.filter("date >= '2024-01-20'"))
        write_daily(later, path)
    assert rounded(read_daily(spark, path)) == rounded(later)


def test_rows_without_time_survive_the_round_trip(spark, tmp_path):
    rows = [(1, None, 39, 1.0, 1.0, 1.0, 1.0, 1.0), (1, 0, 39, 1.0, 1.0, 1.0, 1.0, 1.0)]
    events = clean(spark.createDataFrame(rows, RECORD_SCHEMA))
    write_events(events, str(tmp_path / "e"))
    back = read_events(spark, str(tmp_path / "e"))
    assert sorted(str(r.date) for r in back.collect()) == ["1970-01-01", "None"]
    write_hourly(hourly_totals(back), str(tmp_path / "h"))
    hours = read_hourly(spark, str(tmp_path / "h")).collect()
    assert sorted((str(r.date), str(r.hour)) for r in hours) == [
        ("1970-01-01", "0"), ("None", "None"),
    ]


def test_far_dates_survive_the_round_trip(spark, tmp_path):
    """Microseconds given as milliseconds end up in a far year; the row is kept."""
    rows = [(1, 1383260400000000, 39, 1.0, 1.0, 1.0, 1.0, 1.0)]
    events = clean(spark.createDataFrame(rows, RECORD_SCHEMA))
    write_events(events, str(tmp_path / "e"))
    back = read_events(spark, str(tmp_path / "e"))
    year = F.year("date").alias("y")
    assert back.select(year).collect() == events.select(year).collect()
    assert back.select(year).first().y > 40000


def test_text_sink_writes_one_line_per_record(spark, sf_dir, tmp_path):
    lines = encode_records(records_from_events(spark, sf_dir))
    publish_to_text(lines, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).exceptAll(lines).isEmpty()
    assert lines.count() == 1000
    with pytest.raises(AnalysisException, match="ALREADY_EXISTS"):
        publish_to_text(lines, str(tmp_path / "out"))


def test_messages_are_utf8(spark):
    out = messages(lines_df(spark, ["é\t1"]))
    assert out.dtypes == [("value", "binary")]
    assert bytes(out.first().value) == "é\t1".encode()


def test_kafka_sink_options():
    assert kafka_sink_options("h:9092", "activity") == {
        "kafka.bootstrap.servers": "h:9092",
        "topic": "activity",
        "kafka.compression.type": "gzip",
        "kafka.batch.size": "16384",
        "kafka.linger.ms": "10",
    }
    extra = kafka_sink_options("h:1", "t", extra={"kafka.acks": "all"})
    assert extra["kafka.acks"] == "all"


def test_missing_kafka_connector_is_reported(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        publish_to_kafka(lines_df(spark, ["a"]), kafka_options("h:1", "t"))


def test_a_large_folder_is_written_by_several_tasks(spark, tmp_path):
    hot = spark.range(200_000).select(
        F.lit("2013-11-01").cast("date").alias("date"),
        F.lit(5).alias("hour"),
        F.col("id").cast("int").alias("cell_id"),
        *[F.rand(i).alias(t) for i, t in enumerate(TOTALS)],
    )
    write_hourly(hot, str(tmp_path / "h"), task_bytes="256k")
    assert len(parquet_files(tmp_path / "h")) > 4
    assert read_hourly(spark, str(tmp_path / "h")).count() == 200_000
