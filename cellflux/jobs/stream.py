"""spark-submit entry point of the streaming job."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from cellflux.config import Settings, StreamSettings
from cellflux.jobs.options import (
    add_kafka,
    add_object_store,
    add_time_zone,
    number_or_none,
    object_store,
)
from cellflux.plans import run_shared, run_stream
from cellflux.session import build_session
from cellflux.sources import kafka_options, stream_kafka_lines, stream_text_lines


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Stream of record lines to events and hourly totals")
    p.add_argument("output", help="folder or URI for the datasets")
    p.add_argument("checkpoints", help="folder or URI for the checkpoints")
    p.add_argument("--text-input", help="folder of text files instead of a topic")
    add_kafka(p, required=False)
    p.add_argument("--starting-offsets", default="earliest")
    p.add_argument(
        "--max-offsets-per-trigger",
        type=number_or_none,
        default=10_000_000,
        metavar="N|none",
        help="messages of one micro-batch; N in 30 s are N/30 a second at most, so raise it, or "
        "say none, where a topic brings more (default: %(default)s)",
    )
    p.add_argument(
        "--max-records-per-task",
        type=number_or_none,
        default=1_000_000,
        metavar="N|none",
        help="messages of one task, into which a topic partition is split (default: %(default)s)",
    )
    p.add_argument("--max-files-per-trigger", type=number_or_none, metavar="N|none")
    p.add_argument("--max-bytes-per-trigger", help="of text files, such as 10g")
    p.add_argument("--fail-on-data-loss", action="store_true")
    p.add_argument("--events-trigger", default=StreamSettings.events_trigger)
    p.add_argument("--hourly-trigger", default=StreamSettings.hourly_trigger)
    p.add_argument("--available-now", action="store_true", help="drain the input, then end")
    p.add_argument("--time-limit", type=float, help="seconds to run")
    p.add_argument("--state-partitions", type=int)
    p.add_argument("--hourly-tasks", type=int, default=StreamSettings.hourly_tasks)
    p.add_argument("--files-per-window", type=int, default=StreamSettings.files_per_window)
    p.add_argument("--events-tasks", type=int, help="tasks, and so files, per event trigger")
    p.add_argument("--watermark", default=Settings.watermark)
    p.add_argument(
        "--max-ahead",
        default=Settings.max_ahead,
        metavar="INTERVAL|none",
        help="event time further ahead of the clock has no window (default: %(default)s)",
    )
    p.add_argument(
        "--shared", action="store_true", help="one query over one read; keeps late rows, compacts"
    )
    p.add_argument("--drain", action="store_true", help="write the windows still open at the end")
    add_time_zone(p)
    add_object_store(p, committer="directory")
    return p


def main(argv: Sequence[str] | None = None) -> None:
    p = parser()
    args = p.parse_args(argv)
    if not args.text_input and not (args.servers and args.topic):
        p.error("give --servers and --topic, or --text-input")
    max_ahead = None if args.max_ahead == "none" else args.max_ahead
    settings = Settings(time_zone=args.time_zone, watermark=args.watermark, max_ahead=max_ahead)
    spark = build_session("cellflux-stream", object_store(args))
    if args.text_input:
        lines = stream_text_lines(
            spark,
            args.text_input,
            max_files_per_trigger=args.max_files_per_trigger,
            max_bytes_per_trigger=args.max_bytes_per_trigger,
        )
    else:
        options = kafka_options(
            args.servers,
            args.topic,
            starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
            max_records_per_task=args.max_records_per_task,
            fail_on_data_loss=args.fail_on_data_loss,
            extra=dict(args.kafka_option),
        )
        lines = stream_kafka_lines(spark, options)
    stream = StreamSettings(
        events_trigger=args.events_trigger,
        hourly_trigger=args.hourly_trigger,
        available_now=args.available_now,
        state_partitions=args.state_partitions,
        events_tasks=args.events_tasks,
        hourly_tasks=args.hourly_tasks,
        files_per_window=args.files_per_window,
        time_limit_seconds=args.time_limit,
    )
    run = run_shared if args.shared else run_stream
    last = {"drain": True} if args.drain else {}
    outcome = run(lines, args.output, args.checkpoints, settings, stream, **last)
    if outcome == "stopped":
        sys.exit("a query was stopped that should have run on")


if __name__ == "__main__":
    main()
