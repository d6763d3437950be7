"""Lines sorted into events and rejected ones, file names, numbered lines."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cellflux import StreamSettings
from cellflux.jobs import replay as replay_job
from cellflux.operators import (
    clean,
    decode_lines,
    head_of_files,
    kept_events,
    line_counts,
    numbered_lines,
    rejected_lines,
    sorted_lines,
)
from cellflux.plans import replay_lines, replay_numbered, run_replay, run_sorted_batch
from cellflux.session import scoped_conf
from cellflux.sinks.publish import messages
from cellflux.sources import read_hourly, read_lines, read_sorted, stream_text_lines
from cellflux.streaming import start_sorted, supervise

from helpers import lines_df, plan_of, rounded

GOOD = "1\t1383260400000\t39\t1\t2\t3\t4\t5"
CASES = [
    (GOOD, None, None),
    ("1\tbad\t39\tx\t2\t3\t4\t5", None, None),
    ("", "blank", "blank"),
    (" \t ", "blank", "blank"),
    ("1\t2\t3", "too few fields", None),
    (GOOD + "\t9", "too many fields", None),
    ("\t" + GOOD.split("\t", 1)[1], "cell missing", "cell missing"),
    ("x" + GOOD, "cell is no number", "cell is no number"),
    ("0" + GOOD[1:], "cell out of range", "cell out of range"),
    ("10001" + GOOD[1:], "cell out of range", "cell out of range"),
    ("99999999999" + GOOD[1:], "cell is no number", "cell is no number"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("arity", ["strict", "pad"])
def test_reasons(spark, arity, ansi):
    with scoped_conf(spark, {"spark.sql.ansi.enabled": ansi}):
        rows = sorted_lines(lines_df(spark, [line for line, *_ in CASES]), arity=arity)
        got = {r.line: r.reason for r in rejected_lines(rows).collect()}
    place = 1 if arity == "strict" else 2
    assert got == {case[0]: case[place] for case in CASES if case[place]}


@pytest.mark.parametrize("arity", ["strict", "pad"])
def test_kept_lines_are_the_cleaned_events(spark, arity):
    lines = lines_df(spark, [line for line, *_ in CASES])
    events = clean(decode_lines(lines, arity=arity))
    assert rounded(kept_events(sorted_lines(lines, arity=arity)).select(events.columns)) == rounded(events)


def test_missing_lines_are_counted(spark):
    rows = sorted_lines(spark.createDataFrame([(None,), (GOOD,)], "value string"))
    assert [(r.line, r.reason) for r in rejected_lines(rows).collect()] == [("", "blank")]


def test_unknown_arity(spark):
    with pytest.raises(ValueError, match="arity"):
        sorted_lines(lines_df(spark, [GOOD]), arity="loose")


def test_counts_of_a_batch_add_up(spark, line_file, tmp_path):
    folder = line_file([line for line, *_ in CASES])
    paths, counts = run_sorted_batch(spark, folder, str(tmp_path / "out"))
    assert counts == {"read": 11, "kept": 4, "rejected": 7}
    rows = read_sorted(spark, paths.sorted)
    assert kept_events(rows).count() == 4 and rejected_lines(rows).count() == 7
    assert read_hourly(spark, paths.hourly).count() == 3


def test_the_text_is_scanned_once_and_split_once(spark, line_file):
    plan = plan_of(sorted_lines(read_lines(spark, line_file([GOOD]))), "extended")
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("FileScan text") == 1 and physical.count("split(") == 1


def test_counts_of_a_stream_are_in_its_progress(spark, line_file, tmp_path):
    folder = line_file([line for line, *_ in CASES])
    rows = line_counts(sorted_lines(stream_text_lines(spark, folder)))
    query = start_sorted(rows, str(tmp_path / "out"), str(tmp_path / "cp"), StreamSettings(available_now=True))
    supervise([query], until_all_end=True)
    seen = [json.loads(p.json)["observedMetrics"] for p in query.recentProgress]
    assert [s["lines"] for s in seen if s][0] == {"read": 11, "kept": 2, "rejected": 9}
    assert rejected_lines(read_sorted(spark, str(tmp_path / "out"))).count() == 9


def test_observation_of_a_batch(spark):
    counts = Observation("lines")
    line_counts(sorted_lines(lines_df(spark, [GOOD, "x"])), counts).write.format("noop").mode("overwrite").save()
    assert counts.get == {"read": 2, "kept": 1, "rejected": 1}


# ---- file names ----

NAMES = ["a b.txt", "p%20q.txt", "p q.txt", "x[1].txt", "y{2}.txt", "z?.txt", "é#+.txt"]


@pytest.mark.parametrize("name", NAMES)
def test_heads_of_files_of_any_name(spark, line_file, name):
    folder = line_file(["1", "2", "3"], name)
    assert [r.value for r in replay_lines(spark, folder, max_lines=2, ordered=True).collect()] == ["1", "2"]


def test_heads_of_folders_with_a_blank(spark, line_file):
    line_file(["1", "2"], "a.txt", "day one")
    folder = line_file(["3", "4"], "b.txt", "day one")
    assert [r.value for r in replay_lines(spark, folder, max_lines=3, ordered=True).collect()] == ["1", "2", "3"]


def test_names_that_look_alike_are_counted_apart(spark, line_file):
    line_file(["1"], "p%20q.txt")
    folder = line_file(["2", "3", "4"], "p q.txt")
    for limit in range(1, 5):
        head = head_of_files(read_lines(spark, folder), limit)
        assert head.count() == limit


# ---- numbered lines ----


def test_numbers_follow_files_and_blocks(spark, line_file):
    lines = [f"{n:05d}" for n in range(3001)]
    for i, name in enumerate(NAMES):
        folder = line_file([f"{name}-{x}" for x in lines[: 500 * i + 1]], name)
    with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1"}):
        got = [(r.number, r.value) for r in numbered_lines(read_lines(spark, folder)).collect()]
    got.sort()
    assert [n for n, _ in got] == list(range(1, len(got) + 1))
    by_file = {}
    for _, value in got:
        by_file.setdefault(value.rsplit("-", 1)[0], []).append(value)
    assert [v for rows in by_file.values() for v in rows] == [v for _, v in got]  # files are not mixed
    assert all(rows == sorted(rows) for rows in by_file.values())
    assert sum(map(len, by_file.values())) == sum(500 * i + 1 for i in range(len(NAMES)))


def test_numbering_has_no_single_task_stage(spark, line_file):
    plan = plan_of(numbered_lines(read_lines(spark, line_file(["1", "2"]))))
    assert "SinglePartition" not in plan


def test_no_lines_have_no_numbers(spark, line_file):
    assert numbered_lines(read_lines(spark, line_file([]))).count() == 0


def test_numbers_are_the_keys_of_messages(spark, line_file):
    published = []
    run_replay(spark, line_file(["a", " b "]), lambda df: published.append(messages(df)), numbered=True, strip=True)
    rows = sorted((bytes(r.key), bytes(r.value)) for r in published[0].collect())
    assert rows == [(b"1", b"a"), (b"2", b"b")]
    assert replay_numbered(spark, line_file(["a"])).columns == ["number", "value"]
    with pytest.raises(ValueError, match="numbered"):
        run_replay(spark, "x", published.append, numbered=True, ordered=True)


@pytest.mark.parametrize("extra", [["--ordered"], ["--max-lines", "3"], ["--text-output", "x"]])
def test_numbered_goes_with_a_topic(capsys, extra):
    argv = ["in", "--numbered", "--servers", "h:1", "--topic", "t", *extra]
    with pytest.raises(SystemExit):
        replay_job.main(argv)
    assert "--numbered" in capsys.readouterr().err


def test_number_column_is_whole(spark, line_file):
    assert dict(numbered_lines(read_lines(spark, line_file(["1"]))).dtypes)["number"] == "bigint"
    assert numbered_lines(read_lines(spark, line_file(["1"]))).agg(F.max("number")).first()[0] == 1
