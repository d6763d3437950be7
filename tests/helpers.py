"""Small helpers for the tests."""

from __future__ import annotations

import contextlib
import io
import os
from pathlib import Path

from pyspark.sql import functions as F


def lines_df(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def parquet_files(path):
    return [f for f in Path(path).rglob("*.parquet") if "_spark_metadata" not in f.parts]


def rounded(df, digits=4):
    """All rows as a sorted list, with doubles rounded and order-free."""
    columns = [
        F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


def at_time(path, seconds):
    """Set the files' modification time, by which a stream orders them."""
    os.utime(path, (seconds, seconds))
