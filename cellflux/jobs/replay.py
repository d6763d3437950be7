"""spark-submit entry point of the replay job."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from functools import partial

from cellflux.jobs.options import add_kafka, add_object_store, number_or_none, object_store
from cellflux.plans import run_replay
from cellflux.session import build_session
from cellflux.sinks import kafka_sink_options, publish_to_kafka, publish_to_text


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Publish the lines of record files")
    p.add_argument("input", help="a *.txt file, a glob, or a folder of *.txt files")
    p.add_argument("--max-lines", type=number_or_none, metavar="N|none", help="default: all lines")
    p.add_argument(
        "--ordered", action="store_true", help="publish in the order of the files, by one task"
    )
    p.add_argument(
        "--strip", action="store_true", help="strip lines; loses trailing empty fields"
    )
    p.add_argument(
        "--numbered", action="store_true", help="publish each line's number as the message key"
    )
    p.add_argument("--text-output", help="folder for text files instead of a topic")
    add_kafka(p, required=False)
    add_object_store(p, committer="magic")
    return p


def main(argv: Sequence[str] | None = None) -> None:
    p = parser()
    args = p.parse_args(argv)
    if args.numbered and (args.text_output or args.ordered or args.max_lines is not None):
        p.error("--numbered goes with a topic and all lines, in any order")
    if args.text_output:
        publish = partial(publish_to_text, path=args.text_output)
    elif args.servers and args.topic:
        options = kafka_sink_options(args.servers, args.topic, extra=dict(args.kafka_option))
        publish = partial(publish_to_kafka, options=options)
    else:
        p.error("give --servers and --topic, or --text-output")
    spark = build_session("cellflux-replay", object_store(args))
    run_replay(
        spark,
        args.input,
        publish,
        max_lines=args.max_lines,
        ordered=args.ordered,
        strip=args.strip,
        numbered=args.numbered,
    )


if __name__ == "__main__":
    main()
