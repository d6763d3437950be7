"""Writes that fail, datasets of committed parts, and daily totals that follow their files."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cellflux.commits import CommitLog, read_dataset, read_parts, replace_dataset, stage
from cellflux.operators import clean, daily_totals
from cellflux.plans import read_incremental, refresh_daily
from cellflux.plans import incremental
from cellflux.plans.catalogue import QUERIES
from cellflux.schema import DAILY_SCHEMA
from cellflux.sinks import write_daily, write_events
from cellflux.sources import read_daily, read_events, read_records
from cellflux.sources.adapters import records_from_events

from helpers import at_time, parquet_files, plan_of, rounded

HOUR = 3_600_000


@pytest.fixture
def events(spark, sf_dir):
    return clean(records_from_events(spark, sf_dir))


def failing(df, column="cell_id"):
    return df.withColumn(column, F.when(F.col(column) % 5 == 0, F.raise_error(F.lit("no")).cast("int")).otherwise(F.col(column)))


@pytest.mark.parametrize("regroup", [False, True])
def test_a_failed_write_leaves_the_events(spark, events, tmp_path, regroup):
    path = str(tmp_path / "e")
    write_events(events, path)
    before = rounded(read_events(spark, path))
    with pytest.raises(Exception, match="no"):
        write_events(failing(events), path, regroup=regroup)
    assert rounded(read_events(spark, path)) == before
    write_events(events.filter("cell_id < 50"), path)
    assert rounded(read_events(spark, path)) == [r for r in before if r[0] < 50]


def test_a_first_write_that_fails_leaves_nothing_to_read(spark, events, tmp_path):
    path = str(tmp_path / "d")
    with pytest.raises(Exception, match="no"):
        write_daily(failing(daily_totals(events)), path)
    assert CommitLog(spark, path).latest() is None
    write_daily(daily_totals(events), path)
    assert read_daily(spark, path).count() == daily_totals(events).count()


def test_files_of_a_write_without_commit_are_not_read(spark, events, tmp_path):
    """The job's driver is lost between the last file and the commit."""
    path, totals = str(tmp_path / "d"), daily_totals(events)
    write_daily(totals, path)
    before = rounded(read_daily(spark, path))
    totals.write.mode("append").option("mapreduce.output.basename", "lost").partitionBy("date").parquet(path)
    assert rounded(read_daily(spark, path)) == before
    write_daily(totals, path)
    assert rounded(read_daily(spark, path)) == before
    assert not [f for f in parquet_files(path) if f.name.startswith("lost")]


def test_a_replaced_dataset_is_its_folder(spark, events, tmp_path):
    """Other readers, which list the folder, find the current files and no others; the log stays short."""
    path = str(tmp_path / "d")
    totals = daily_totals(events)
    for day in range(20, 29):
        write_daily(totals.filter(F.dayofmonth("date") >= day), path)
    assert rounded(spark.read.schema(DAILY_SCHEMA).parquet(path)) == rounded(totals.filter(F.dayofmonth("date") >= 28))
    assert len([p for p in Path(path, "_commits").iterdir() if p.suffix == ".txt"]) == 5


def test_a_dataset_without_a_log_is_read_and_replaced(spark, events, tmp_path):
    path, totals = str(tmp_path / "d"), daily_totals(events)
    totals.write.partitionBy("date").parquet(path)
    assert rounded(read_daily(spark, path)) == rounded(totals)
    write_daily(totals.limit(5), path)
    assert read_daily(spark, path).count() == 5


def test_a_dataset_can_be_made_from_itself(spark, events, tmp_path):
    path, totals = str(tmp_path / "d"), daily_totals(events)
    write_daily(totals, path)
    write_daily(read_daily(spark, path).filter("cell_id < 20"), path)
    assert rounded(read_daily(spark, path)) == rounded(totals.filter("cell_id < 20").select(DAILY_SCHEMA.fieldNames()))


def test_empty_dataset(spark, events, tmp_path):
    path = str(tmp_path / "d")
    write_daily(daily_totals(events), path)
    write_daily(daily_totals(events.limit(0)), path)
    assert read_daily(spark, path).count() == 0


def test_parts(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(6).select(F.col("id").cast("int").alias("x"), (F.col("id") % 2).cast("string").alias("k"))
    first = stage(df, root, "t", "a", ["k"])
    second = stage(df.filter("k = '1'"), root, "t", "b", ["k"])
    assert first == ["part=a/k=0", "part=a/k=1"] and second == ["part=b/k=1"]
    schema = df.schema
    assert read_parts(spark, root, "t", schema, [first[0], second[0]]).count() == 6
    assert read_parts(spark, root, "t", schema, []).count() == 0
    assert stage(df, root, "t", "c", []) == ["part=c"]
    replace_dataset(df, str(tmp_path / "whole"), [])
    assert read_dataset(spark, str(tmp_path / "whole"), schema).count() == 6


# ---- totals by ledger ----


@pytest.fixture
def put(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    clock = iter(range(1_700_000_000, 1_800_000_000))

    def write(name, rows):
        """Rows of (cell, day, value)."""
        file = folder / name
        text = "".join(f"{c}\t{d * 24 * HOUR}\t39\t{v}\t0\t0\t0\t0\n" for c, d, v in rows)
        file.write_text(text, encoding="utf-8")
        at_time(file, next(clock))
        return str(folder)

    return write


def expected(spark, folder):
    return rounded(daily_totals(clean(read_records(spark, folder))).select(DAILY_SCHEMA.fieldNames()))


def test_added_replaced_and_removed_files(spark, put, tmp_path):
    root = str(tmp_path / "totals")
    folder = put("a.txt", [(1, 1, 1.0), (1, 2, 2.0)])
    put("b 1%20[x].txt", [(1, 2, 4.0), (2, 3, 8.0), (20_000, 9, 1.0)])
    refresh = refresh_daily(spark, folder, root)
    assert len(refresh.added) == 2 and refresh.dates == ["1970-01-02", "1970-01-03", "1970-01-04"]
    assert rounded(read_incremental(spark, root)) == expected(spark, folder)

    nothing = refresh_daily(spark, folder, root)
    assert (nothing.added, nothing.dates) == ([], [])

    put("c.txt", [(1, 3, 16.0)])
    put("a.txt", [(1, 1, 32.0)])  # its second date is gone
    refresh = refresh_daily(spark, folder, root)
    assert len(refresh.added) == len(refresh.replaced) == 1
    assert refresh.dates == ["1970-01-02", "1970-01-03", "1970-01-04"]
    assert rounded(read_incremental(spark, root)) == expected(spark, folder)

    os.remove(f"{folder}/b 1%20[x].txt")
    refresh = refresh_daily(spark, folder, root)
    assert len(refresh.removed) == 1 and refresh.dates == ["1970-01-03", "1970-01-04"]
    assert rounded(read_incremental(spark, root)) == expected(spark, folder)


def test_rows_without_a_date_and_files_without_rows(spark, put, tmp_path):
    root = str(tmp_path / "totals")
    folder = put("a.txt", [(1, 1, 1.0)])
    Path(folder, "none.txt").write_text("")
    Path(folder, "undated.txt").write_text("5\t\t39\t1\t0\t0\t0\t0\n6\tbad\t39\t1\t0\t0\t0\t0\n")
    Path(folder, "far.txt").write_text("5\t1383260400000000\t39\t1\t0\t0\t0\t0\n")
    refresh_daily(spark, folder, root)
    date = F.col("date").cast("string").alias("date")
    got = read_incremental(spark, root).select("cell_id", "sms_in_total", date)
    want = daily_totals(clean(read_records(spark, folder))).select("cell_id", "sms_in_total", date)
    assert rounded(got) == rounded(want)
    assert refresh_daily(spark, folder, root).added == []
    os.remove(f"{folder}/undated.txt")
    refresh_daily(spark, folder, root)
    assert sorted(r.cell_id for r in read_incremental(spark, root).select("cell_id", date).collect()) == [1, 5]


def test_only_touched_dates_are_read(spark, put, tmp_path, monkeypatch):
    root = str(tmp_path / "totals")
    folder = put("a.txt", [(1, day, 1.0) for day in range(1, 9)])
    refresh_daily(spark, folder, root)
    put("b.txt", [(1, 3, 2.0)])
    asked = []

    def spy(spark, root, table, schema, folders):
        asked.append((table, [f.split("/")[1] for f in folders if "/" in f]))
        return read_parts(spark, root, table, schema, folders)

    monkeypatch.setattr(incremental, "read_parts", spy)
    refresh_daily(spark, folder, root)
    assert {(t, tuple(f)) for t, f in asked if t == "ledger"} == {("ledger", ("date=1970-01-04",))}
    monkeypatch.undo()
    state = CommitLog(spark, root).latest()
    day = [f for f in state["ledger"] if f.endswith("1970-01-04")]
    plan = plan_of(read_parts(spark, root, "ledger", incremental.LEDGER_SCHEMA, day))
    assert "1 paths" in plan or day[0] in plan
    assert len({f.split("/")[0] for f in state["daily"]}) == 2  # the other dates are still those of the first part


def test_a_refresh_that_fails_changes_nothing(spark, put, tmp_path, monkeypatch):
    root = str(tmp_path / "totals")
    folder = put("a.txt", [(1, 1, 1.0)])
    refresh_daily(spark, folder, root)
    before = rounded(read_incremental(spark, root))
    put("a.txt", [(1, 1, 5.0)])

    def fail(self, state):
        raise OSError("lost")

    monkeypatch.setattr(CommitLog, "commit", fail)
    with pytest.raises(OSError):
        refresh_daily(spark, folder, root)
    monkeypatch.undo()
    assert rounded(read_incremental(spark, root)) == before
    refresh_daily(spark, folder, root)
    assert rounded(read_incremental(spark, root)) == expected(spark, folder)


def test_incremental_query_is_registered():
    assert {"daily_incremental", "sink_replace_failed"} <= QUERIES.keys()
