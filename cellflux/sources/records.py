"""Batch scans of tab-separated record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.schema import RECORD_SCHEMA, SEPARATOR

# Fixed value: the files of a record folder.
RECORD_FILES = "*.txt"

# Spark's file reader fails the job at a line of more fields than this, for which it holds room in
# each task. Its usual bound is 20,480.
_MAX_FIELDS = 1_000_000

# The parser of single lines has the usual bound, so that a line which may have as many fields is cut
# to its first ones. A field is quoted, with escaped signs in it, or plain.
_LONG_LINE = 20_000
_FIELD = r'(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^\t]*+|[^\t]*+)'
_FIRST_FIELDS = rf"^{_FIELD}(?:\t{_FIELD}){{0,{len(RECORD_SCHEMA) - 1}}}"


_DDL = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RECORD_SCHEMA)


def record_files(path: str) -> str:
    """A folder means its record files; a glob or a record file is taken as it is."""
    if any(c in path for c in "*?[{") or path.endswith(RECORD_FILES.lstrip("*")):
        return path
    return f"{path.rstrip('/')}/{RECORD_FILES}"


def read_records(spark: SparkSession, path: str, *, any_width: bool = False) -> DataFrame:
    """Typed scan with the declared schema; the files are never read to infer one.

    `any_width` is for files with damaged lines of more than a million fields, at which the file reader
    fails; it parses line by line instead, which takes about twice the time. All else is the same.

    Permissive: a value that does not parse is NULL, missing fields are NULL,
    extra fields are ignored. A path without files is an error.
    """
    if not any_width:
        return spark.read.csv(
            record_files(path),
            sep=SEPARATOR,
            header=False,
            schema=RECORD_SCHEMA,
            mode="PERMISSIVE",
            maxColumns=_MAX_FIELDS,
        )
    line = F.col("value")
    cut = F.when(F.length(line) > _LONG_LINE, F.regexp_extract(line, _FIRST_FIELDS, 0)).otherwise(line)
    record = F.from_csv(cut, _DDL, {"sep": SEPARATOR, "mode": "PERMISSIVE"})
    lines = read_lines(spark, path).filter(line.rlike(r"[^\x00-\x20]"))  # blank lines are no records
    # As rows of a one-element array, for else each later filter would parse the line again.
    return lines.select(F.explode(F.array(record)).alias("record")).select("record.*")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Undecoded lines, one `value` each."""
    return spark.read.text(record_files(path))
