"""spark-submit entry point of the batch job."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from cellflux.config import Settings
from cellflux.jobs.options import add_object_store, add_time_zone, object_store
from cellflux.plans import run_batch, run_sorted_batch
from cellflux.session import build_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Record files to cleaned events and totals")
    p.add_argument("input", help="folder of *.txt record files, or a glob")
    p.add_argument("output", help="folder or URI for the datasets")
    p.add_argument(
        "--regroup-events", action="store_true", help="for input files that mix many dates; without it each input split writes a file per date"
    )
    p.add_argument(
        "--any-width", action="store_true", help="survive lines of over a million fields; slower"
    )
    p.add_argument(
        "--keep-rejected",
        action="store_true",
        help="write events and rejected lines, with reasons, as `sorted_lines`; print the counts",
    )
    add_time_zone(p)
    add_object_store(p, committer="magic")
    return p


def main(argv: Sequence[str] | None = None) -> None:
    p = parser()
    args = p.parse_args(argv)
    if args.keep_rejected and (args.regroup_events or args.any_width):
        p.error("--keep-rejected reads lines of any width and writes them where they are read")
    settings = Settings(time_zone=args.time_zone)
    spark = build_session("cellflux-batch", object_store(args))
    if args.keep_rejected:
        _, counts = run_sorted_batch(spark, args.input, args.output, settings)
        print(" ".join(f"{name}={count}" for name, count in counts.items()))
        return
    run_batch(
        spark,
        args.input,
        args.output,
        settings,
        regroup_events=args.regroup_events,
        any_width=args.any_width,
    )


if __name__ == "__main__":
    main()
