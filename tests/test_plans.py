"""The physical plans: what reaches the scan, how often data moves, what runs where."""

from __future__ import annotations

import re

import pytest

from cellflux.operators import (
    clean,
    daily_from_hourly,
    daily_totals,
    decode_lines,
    encode_records,
    head_lines,
    hourly_totals,
    tumbling_totals,
)
from cellflux.plans import replay_lines
from cellflux.plans.catalogue import QUERIES
from cellflux.schema import EVENTS_SCHEMA
from cellflux.session import scoped_conf
from cellflux.sinks import publish_to_text, write_events, write_hourly
from cellflux.sources import read_events, read_hourly, read_records
from cellflux.sources.adapters import records_from_events, records_from_lineitem
from cellflux.streaming import streamed_hourly_totals

from helpers import lines_df, plan_of


@pytest.fixture(scope="module")
def record_folder(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans") / "records")
    publish_to_text(encode_records(records_from_events(spark, sf_dir)), folder)
    return folder


@pytest.fixture(scope="module")
def datasets(spark, record_folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("datasets"))
    write_events(clean(read_records(spark, record_folder)), f"{root}/e")
    write_hourly(hourly_totals(read_events(spark, f"{root}/e")), f"{root}/h")
    return root


def read_schema(plan):
    return re.search(r"ReadSchema: struct<(.*)>", plan).group(1)


def exchanges(plan):
    return len(re.findall(r"^\(\d+\) Exchange", plan, re.M))


@pytest.mark.parametrize("total", [hourly_totals, daily_totals, tumbling_totals])
def test_text_totals_prune_push_and_shuffle_once(spark, record_folder, total):
    plan = plan_of(total(clean(read_records(spark, record_folder))))
    assert "country_code" not in read_schema(plan)
    assert "GreaterThanOrEqual(cell_id,1), LessThanOrEqual(cell_id,10000)" in plan
    assert exchanges(plan) == 1
    assert "partial_sum" in plan and "SortAggregate" not in plan


def test_hourly_from_events_reads_only_what_it_adds(spark, datasets):
    plan = plan_of(hourly_totals(read_events(spark, f"{datasets}/e")))
    assert read_schema(plan) == (
        "cell_id:int,sms_in:double,sms_out:double,call_in:double,call_out:double,"
        "internet:double,hour:int"
    )
    assert "Batched: true" in plan
    assert exchanges(plan) == 1


def test_daily_from_hourly_adds_before_the_shuffle(spark, datasets):
    plan = plan_of(daily_from_hourly(read_hourly(spark, f"{datasets}/h")))
    assert plan.index("partial_sum") < plan.index(") Exchange\nInput")
    assert exchanges(plan) == 1


@pytest.mark.parametrize(
    "adapter, key", [(records_from_events, "user_id"), (records_from_lineitem, "l_orderkey")]
)
def test_cell_filter_reaches_the_table_scan(spark, sf_dir, adapter, key):
    plan = plan_of(daily_totals(clean(adapter(spark, sf_dir, valid_only=True))))
    assert f"GreaterThanOrEqual({key},1), LessThanOrEqual({key},10000)" in plan
    assert "props" not in plan and "l_comment" not in plan


def test_each_line_is_split_once(spark, record_folder):
    plan = plan_of(clean(decode_lines(spark.read.text(record_folder))))
    assert len(re.findall(r"\bsplit\(value", plan)) == 1
    assert "* Generate" in plan  # within generated code
    assert exchanges(plan) == 0


def test_clean_moves_no_data(spark, record_folder):
    plan = plan_of(clean(read_records(spark, record_folder)))
    assert exchanges(plan) == 0
    assert re.findall(r"codegen id : (\d)", plan) and "codegen id : 2" not in plan


def test_head_reads_the_files_it_needs(spark, record_folder):
    plan = plan_of(replay_lines(spark, record_folder, max_lines=10))
    assert exchanges(plan) <= 2 and "TakeOrderedAndProject" not in plan


def test_totals_are_regrouped_per_folder_after_adding_up(spark, datasets):
    totals = hourly_totals(read_events(spark, f"{datasets}/e"))
    plan = plan_of(totals.hint("rebalance", "date", "hour"))
    assert exchanges(plan) == 2
    assert re.search(r"hashpartitioning\(date#\d+, hour#\d+, \d+\), REBALANCE", plan)


def test_streamed_totals_add_before_the_shuffle(spark, record_folder, tmp_path):
    events = clean(decode_lines(spark.readStream.text(record_folder)))
    totals = streamed_hourly_totals(events)
    query = (
        totals.writeStream.format("memory").queryName("plan").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.processAllAvailable()
    plan = query._jsq.explainInternal(False)
    query.stop()
    order = [plan.index(x) for x in ("merge_sum", "StateStoreRestore", "Exchange", "partial_sum")]
    assert order == sorted(order)
    assert plan.count("Exchange hashpartitioning(window") == 1


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not re.match("sink|stream|batch", n)))
def test_no_query_leaves_the_jvm_or_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    # Numbered lines meet the number of their block.
    joins = ["Join"] if name != "replay_numbered" else ["NestedLoopJoin"]
    for word in ("Python", *joins, "Cartesian", "ObjectHashAggregate", "MapPartitions"):
        assert word not in plan


@pytest.mark.parametrize("writers, sorts", [("0", True), ("8", False)])
def test_event_sink_needs_no_sort_with_open_writers(
    spark, record_folder, datasets, writers, sorts
):
    """The same write as a statement, whose plan can be shown."""
    clean(read_records(spark, record_folder)).createOrReplaceTempView("cleaned")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS_SCHEMA)
    spark.sql(
        f"CREATE TABLE event_sink ({columns}) USING parquet PARTITIONED BY (date) "
        f"LOCATION '{datasets}/e'"
    )
    with scoped_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": writers}):
        plan = spark.sql(
            "EXPLAIN INSERT OVERWRITE event_sink BY NAME SELECT * FROM cleaned"
        ).first()[0]
    spark.sql("DROP TABLE event_sink")
    assert "InsertIntoHadoopFsRelationCommand" in plan
    assert ("Sort [" in plan) == sorts
    assert "Exchange" not in plan


def test_head_takes_any_order(spark):
    lines = lines_df(spark, ["b", "c", "a"])
    assert [r.value for r in head_lines(lines, 2, [lines.value]).collect()] == ["a", "b"]
