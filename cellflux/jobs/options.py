"""Command-line options that several jobs share."""

from __future__ import annotations

import argparse

from cellflux.config import Settings, object_store_conf


def number_or_none(text: str) -> int | None:
    """A positive number, or `none` to leave a bound out."""
    if text == "none":
        return None
    if (value := int(text)) < 1:
        raise argparse.ArgumentTypeError(f"expected a positive number or none, got {text!r}")
    return value


def pair(text: str) -> tuple[str, str]:
    key, sign, value = text.partition("=")
    if not key or not sign:
        raise argparse.ArgumentTypeError(f"expected KEY=VALUE, got {text!r}")
    return key, value


def add_time_zone(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--time-zone", default=Settings.time_zone, help="zone of date and hour")


def add_object_store(parser: argparse.ArgumentParser, committer: str) -> None:
    group = parser.add_argument_group("object store (s3a paths)")
    group.add_argument("--s3a", action="store_true", help="set up s3a access and its committer")
    group.add_argument("--s3a-endpoint", help="for an S3-compatible store")
    group.add_argument("--s3a-committer", default=committer, choices=["magic", "directory"])
    group.add_argument("--s3a-no-ssl", action="store_true")
    group.add_argument("--s3a-virtual-hosts", action="store_true", help="no path-style access")


def object_store(args: argparse.Namespace) -> dict[str, str]:
    if not (args.s3a or args.s3a_endpoint):
        return {}
    return object_store_conf(
        args.s3a_endpoint,
        path_style=not args.s3a_virtual_hosts,
        ssl=not args.s3a_no_ssl,
        committer=args.s3a_committer,
    )


def add_kafka(parser: argparse.ArgumentParser, *, required: bool) -> None:
    parser.add_argument("--servers", required=required, help="topic bootstrap servers")
    parser.add_argument("--topic", required=required)
    parser.add_argument(
        "--kafka-option", type=pair, action="append", default=[], metavar="KEY=VALUE"
    )
