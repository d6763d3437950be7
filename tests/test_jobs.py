from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from cellflux import object_store_conf
from cellflux.jobs import batch, options, replay, stream
from cellflux.operators import clean, daily_totals, encode_records, hourly_totals, rejected_lines
from cellflux.plans import BatchPaths, StreamPaths
from cellflux.session import build_session, scratch_path
from cellflux.sinks import publish_to_text
from cellflux.sources import read_daily, read_events, read_hourly, read_sorted
from cellflux.sources.adapters import records_from_events
from cellflux.streaming import read_drained, read_shared

from helpers import rounded


@pytest.fixture
def record_folder(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "records")
    publish_to_text(encode_records(records_from_events(spark, sf_dir)).repartition(3), folder)
    return folder


def test_batch_job(spark, sf_dir, record_folder, tmp_path):
    out = str(tmp_path / "out")
    batch.main([record_folder, out])
    batch.main([record_folder, out, "--regroup-events"])  # again, replacing everything
    paths = BatchPaths(out)
    assert [p.rsplit("/", 1)[1] for p in (paths.events, paths.hourly, paths.daily)] == [
        "raw_events", "hourly_aggregates", "daily_aggregates",
    ]
    events = clean(records_from_events(spark, sf_dir))
    assert rounded(read_events(spark, paths.events).select(events.columns)) == rounded(events)
    assert rounded(read_hourly(spark, paths.hourly)) == rounded(hourly_totals(events))
    assert rounded(read_daily(spark, paths.daily)) == rounded(daily_totals(events))


def test_batch_job_in_another_zone(spark, line_file, tmp_path):
    folder = line_file(["1\t1383260400000\t39\t1\t2\t3\t4\t5"])
    out = str(tmp_path / "out")
    batch.main([folder, out, "--time-zone", "Europe/Rome"])
    (row,) = read_hourly(spark, BatchPaths(out).hourly).collect()
    assert (str(row.date), row.hour) == ("2013-11-01", 0)


def test_batch_job_without_input_fails_and_writes_nothing(tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        batch.main([str(tmp_path / "empty"), str(tmp_path / "out")])
    assert not (tmp_path / "out").exists()


def test_replay_then_stream(spark, sf_dir, record_folder, tmp_path):
    published, out = str(tmp_path / "published"), str(tmp_path / "out")
    replay.main([record_folder, "--text-output", published])
    stream.main(
        [out, str(tmp_path / "cp"), "--text-input", published, "--available-now",
         "--state-partitions", "4"]
    )
    paths = StreamPaths(out)
    events = clean(records_from_events(spark, sf_dir))
    assert rounded(read_events(spark, paths.events).select(events.columns)) == rounded(events)
    batch_hours = set(rounded(hourly_totals(events)))
    streamed = rounded(read_hourly(spark, paths.hourly))
    assert set(streamed) <= batch_hours
    assert len(batch_hours) - len(streamed) < 10


def test_batch_job_that_keeps_rejected_lines(spark, line_file, tmp_path, capsys):
    good = "1\t1383260400000\t39\t1\t2\t3\t4\t5"
    folder, out = line_file([good, "x" + good, "", good + "\t9"]), str(tmp_path / "out")
    batch.main([folder, out, "--keep-rejected"])
    assert "read=4 kept=2 rejected=2" in capsys.readouterr().out
    rows = read_sorted(spark, BatchPaths(out).sorted)
    assert {r.reason for r in rejected_lines(rows).collect()} == {"cell is no number", "blank"}
    assert read_daily(spark, BatchPaths(out).daily).first().internet_total == 10.0
    with pytest.raises(SystemExit):
        batch.main([folder, out, "--keep-rejected", "--regroup-events"])


@pytest.mark.parametrize("shared", [False, True])
def test_stream_job_drains(spark, sf_dir, record_folder, tmp_path, shared):
    """With its last windows, the stream's totals are those of the batch, by two queries or by one."""
    out = str(tmp_path / "out")
    argv = [out, str(tmp_path / "cp"), "--text-input", record_folder, "--available-now", "--state-partitions", "4", "--drain"]
    stream.main([*argv, *(["--shared"] if shared else [])])
    paths, want = StreamPaths(out), hourly_totals(clean(records_from_events(spark, sf_dir)))
    got = read_shared(spark, paths.shared, "hourly") if shared else read_drained(spark, paths.hourly, paths.open)
    assert rounded(got.select(want.columns)) == rounded(want)


def test_max_ahead_option():
    parse = stream.parser().parse_args
    assert parse(["out", "cp"]).max_ahead == "1 day"
    assert parse(["out", "cp", "--max-ahead", "none"]).max_ahead == "none"


def test_replay_limit_and_strip(spark, line_file, tmp_path):
    folder = line_file([f"{i}\t\t" for i in range(10)])
    out = str(tmp_path / "head")
    replay.main([folder, "--max-lines", "3", "--strip", "--text-output", out])
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["0", "1", "2"]
    assert replay.parser().parse_args([folder]).max_lines is None


def test_stream_and_batch_hourly_paths_differ():
    assert BatchPaths("/x/").hourly != StreamPaths("/x").hourly
    assert StreamPaths("s3a://b/p").events == "s3a://b/p/streamed_events"


@pytest.mark.parametrize("main, argv", [
    (batch.main, []),
    (batch.main, ["only-input"]),
    (stream.main, ["out", "cp"]),
    (stream.main, ["out", "cp", "--servers", "h:1"]),
    (replay.main, ["in"]),
    (replay.main, ["in", "--topic", "t"]),
    (replay.main, ["in", "--servers", "h:1", "--topic", "t", "--kafka-option", "novalue"]),
])
def test_bad_arguments(main, argv, capsys):
    with pytest.raises(SystemExit) as stopped:
        main(argv)
    assert stopped.value.code == 2


def test_stream_defaults():
    args = stream.parser().parse_args(["out", "cp", "--servers", "h:1", "--topic", "t"])
    assert args.starting_offsets == "earliest"
    assert not args.fail_on_data_loss
    assert (args.events_trigger, args.hourly_trigger) == ("30 seconds", "1 minute")
    assert args.watermark == "10 minutes"
    assert options.object_store(args) == {}


def test_object_store_conf():
    conf = object_store_conf("http://store:9000", ssl=False, committer="directory")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.committer.name"] == "directory"
    assert conf["spark.hadoop.fs.s3a.committer.magic.enabled"] == "false"
    magic = object_store_conf()
    assert magic["spark.hadoop.fs.s3a.committer.name"] == "magic"
    assert "spark.hadoop.fs.s3a.endpoint" not in magic
    assert not [k for k in conf if "secret" in k or "access.key" in k]


def test_object_store_options_of_the_jobs():
    args = batch.parser().parse_args(["i", "o", "--s3a-endpoint", "http://h:1", "--s3a-no-ssl"])
    assert options.object_store(args) == object_store_conf("http://h:1", ssl=False)
    args = stream.parser().parse_args(["o", "c", "--s3a"])
    assert options.object_store(args) == object_store_conf(committer="directory")


def test_bounds_can_be_left_out():
    parse = stream.parser().parse_args
    bounds = ["--max-offsets-per-trigger", "none", "--max-records-per-task", "none"]
    args = parse(["o", "c", *bounds])
    assert args.max_offsets_per_trigger is args.max_records_per_task is None
    kept = parse(["o", "c", "--max-files-per-trigger", "2", "--max-bytes-per-trigger", "1g"])
    assert (kept.max_offsets_per_trigger, kept.max_files_per_trigger) == (10_000_000, 2)
    for bad in ("0", "-1"):
        with pytest.raises(SystemExit):
            parse(["o", "c", "--max-files-per-trigger", bad])


def test_replay_and_path_style_options():
    args = replay.parser().parse_args(["i", "--s3a", "--s3a-virtual-hosts", "--max-lines", "none"])
    conf = options.object_store(args)
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "false" and args.max_lines is None


def test_a_stopped_query_is_not_a_success(monkeypatch, tmp_path):
    monkeypatch.setattr(stream, "run_stream", lambda *a: "stopped")
    with pytest.raises(SystemExit) as ended:
        stream.main([str(tmp_path / "o"), str(tmp_path / "c"), "--text-input", str(tmp_path)])
    assert ended.value.code not in (0, None)


def test_submitted_settings_win_over_those_of_the_job(spark, monkeypatch):
    import cellflux.session as session

    given = []

    class Builder:
        def appName(self, _):
            return self

        def config(self, key, value):
            given.append(key)
            return self

        def getOrCreate(self):
            return spark

    class Submitted:
        def contains(self, key):
            return key == "spark.hadoop.fs.s3a.endpoint"

    monkeypatch.setattr(session, "SparkConf", Submitted)
    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    build_session("x", {"spark.hadoop.fs.s3a.endpoint": "a", "spark.x": "b"})
    assert given == ["spark.x"]


def test_runs_leave_the_session_zone(spark, line_file, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    folder = line_file(["1\t1383260400000\t39\t1\t2\t3\t4\t5"])
    batch.main([folder, str(tmp_path / "o"), "--time-zone", "Europe/Rome"])
    assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    (row,) = read_hourly(spark, BatchPaths(str(tmp_path / "o")).hourly).collect()
    assert (str(row.date), row.hour) == ("2013-11-01", 0)


def test_job_session_keeps_what_was_submitted(spark):
    session = build_session("again")
    assert session.sparkContext is spark.sparkContext
    assert session.conf.get("spark.sql.shuffle.partitions") == "8"
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "256m"


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert one.startswith(root + "/a-") and one != two


class FakeSession:
    def __init__(self, **conf):
        self.conf = conf


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession(**{"spark.master": master}), "a")
