"""Record lines: encode, decode, and the head of a file."""

from __future__ import annotations

import re
from typing import Literal
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellflux.functions import field_value, record_line
from cellflux.schema import RECORD_FIELDS, RECORD_SCHEMA, SEPARATOR
from cellflux.session import scratch_path

Arity = Literal["strict", "pad"]


def encode_records(records: DataFrame) -> DataFrame:
    """One text `value` per record, as a topic message or a text file takes it."""
    return records.select(record_line().alias("value"))


def decode_lines(lines: DataFrame, arity: Arity = "strict") -> DataFrame:
    """Records from a text or binary `value` column.

    ``strict`` keeps lines of exactly eight fields. ``pad`` fills missing fields
    with NULL and ignores extra ones, as the file reader does.

    `explode` over a one-element array keeps one row per line and makes each line
    be split once: as a plain projection, Spark would push the later filters below
    it and repeat the split in each of them. One field more than a record has is enough to
    see that a line is too long.
    """
    if arity not in ("strict", "pad"):
        raise ValueError(f"arity must be 'strict' or 'pad', not {arity!r}")
    line = F.col("value").cast("string")
    if arity == "pad":
        lines = lines.filter(line.rlike(r"[^\x00-\x20]"))  # blank lines are no records
    fields = F.split(line, SEPARATOR, len(RECORD_FIELDS) + 1)
    split = lines.select(F.explode(F.array(fields)).alias("fields"))
    if arity == "strict":
        split = split.filter(F.size("fields") == len(RECORD_FIELDS))
    return split.select(
        *[
            field_value(F.get("fields", F.lit(i)), field.dataType).alias(field.name)
            for i, field in enumerate(RECORD_SCHEMA)
        ]
    )


def head_lines(lines: DataFrame, limit: int, order: list[Column]) -> DataFrame:
    """The first `limit` lines under a stated order, as a top-k: no full sort is made.

    One task merges the result, in that order. For heads of files, see `head_of_files`.
    """
    return lines.orderBy(*order).limit(limit).select("value")


_PLACE = ["path", "block", "line"]


def file_order(lines: DataFrame) -> list[Column]:
    """Sort columns that put lines of text files in the order of their files.

    Spark reads a file in blocks and gives no order among them. Within a block, ids of one scan
    increase line by line. A head has these columns from the scan that cut it.
    """
    if set(_PLACE) <= set(lines.columns):
        return [lines[c] for c in _PLACE]
    return [
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    ]


def _placed(lines: DataFrame) -> DataFrame:
    path, block, line = file_order(lines)
    return lines.select("value", path.alias("path"), block.alias("block"), line.alias("line"))


def _name(uri: str) -> str:
    """One spelling of a file's address, which Spark's listing and its scans begin differently."""
    return uri.replace(":///", ":/", 1)


def as_path(uri: str) -> str:
    """The path that reads this one file: addresses are encoded, paths are not, and have signs of a pattern escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def _read(spark: SparkSession, uris: list[str]) -> DataFrame:
    return spark.read.text([as_path(u) for u in uris])


def head_of_files(lines: DataFrame, limit: int) -> DataFrame:
    """The first `limit` lines of a scan of text files, in the order of the files' paths.

    Files are counted in groups that double, until they hold enough lines: no later file is read. All
    files but the last are taken whole. Lines of the last one, where the head ends, are written
    with their places once, to the shared folder; its blocks are counted and cut there, so that nothing depends on how
    Spark splits a file from one scan to the next. The driver gets one row per file looked at.
    """
    spark = lines.sparkSession
    uris = sorted(lines.inputFiles())
    before, at, step = 0, 0, 1
    while at < len(uris):
        group = uris[at : at + step]
        counts = {
            _name(r.path): r.lines
            for r in _read(spark, group)
            .groupBy(F.col("_metadata.file_path").alias("path"))
            .agg(F.count(F.lit(1)).alias("lines"))
            .collect()
        }
        for uri in group:
            own = counts.get(_name(uri), 0)
            if before + own >= limit:
                return _cut(spark, uris[: uris.index(uri)], uri, limit - before)
            before += own
        at, step = at + step, step * 2
    return _placed(lines)  # fewer lines than the limit


def _cut(spark: SparkSession, whole: list[str], last: str, room: int) -> DataFrame:
    """All lines of the files `whole`, and the first `room` ones of `last`."""
    path = scratch_path(spark, "head")
    _placed(_read(spark, [last])).write.parquet(path)
    placed = spark.read.parquet(path)
    blocks = placed.groupBy("block").agg(F.count(F.lit(1)).alias("lines"), F.min("line").alias("first"))
    through = F.sum("lines").over(Window.orderBy("block"))  # the blocks of one file
    starts = blocks.select(
        F.col("block").alias("_block"), "first", (through - F.col("lines")).alias("ahead")
    )
    cut = placed.join(starts, F.col("block") == F.col("_block")).filter(
        F.col("ahead") + F.col("line") - F.col("first") < room
    )
    cut = cut.select("value", *_PLACE)
    return _placed(_read(spark, whole)).unionByName(cut) if whole else cut


def numbered_lines(lines: DataFrame) -> DataFrame:
    """`number`, from 1, and `value` of all lines of a scan of text files, in the order of the files' paths.

    Lines are written once with their places. A block of a file then counts its lines; what comes before it is the sum
    of the blocks before, added up in ranges of blocks side by side. Only a sum per range, of which there are as many
    as shuffle partitions, passes the driver. No line is sorted, and none leaves its block but to
    meet the block's number.
    """
    spark = lines.sparkSession
    path = scratch_path(spark, "numbered")
    _placed(lines).write.parquet(path)
    placed = spark.read.parquet(path)
    counted = placed.groupBy("path", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("line").alias("first"))
    ranges = counted.repartitionByRange("path", "block").withColumn("range", F.spark_partition_id())
    blocks_path = scratch_path(spark, "blocks")
    ranges.write.parquet(blocks_path)
    blocks = spark.read.parquet(blocks_path)
    sums = blocks.groupBy("range").agg(F.sum("lines").alias("lines")).collect()
    own = {row["range"]: row.lines for row in sums}
    before = [0]
    for number in range(max(own, default=0)):
        before.append(before[-1] + own.get(number, 0))
    ahead = F.get(F.array(*[F.lit(lines) for lines in before]), F.col("range")).cast("long")
    within = F.sum("lines").over(Window.partitionBy("range").orderBy("path", "block")) - F.col("lines")
    starts = blocks.withColumns({"within": within, "before": ahead})
    offset = (F.col("before") + F.col("within") - F.col("first")).alias("offset")
    starts = starts.select(F.col("path").alias("_path"), F.col("block").alias("_block"), offset)
    numbered = placed.join(starts, (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block")))
    return numbered.select((F.col("offset") + F.col("line") + 1).alias("number"), "value")
