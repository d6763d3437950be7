"""A small log beside a dataset that says which of its files are the current ones.

Data files are written first, under names that no reader looks at yet; then one small file in the folder
`_commits` makes them the dataset, all at once. A write that fails before that leaves what was there. One writer at a
time is assumed; readers need no lock.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOG = "_commits"
_KEPT = 5  # commits that stay in the log


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if there is no such folder."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def delete_files(spark: SparkSession, path: str, *, but: str) -> None:
    """Delete the files below a dataset's folder whose names do not start with `but`, and folders left empty.

    Hidden folders, the log among them, stay. The names come from one listing on the driver, as those of a scan do.
    """
    files, target = _file_system(spark, path)

    def clear(folder) -> bool:
        """Whether nothing is left."""
        empty = True
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if status.isDirectory():
                hidden = name.startswith(("_", ".")) and "=" not in name
                if hidden or not clear(status.getPath()):
                    empty = False
            elif name.startswith(but):
                empty = False
            elif not name.startswith(("_", ".")):
                files.delete(status.getPath(), False)
        if empty and folder != target:
            files.delete(folder, True)
        return empty

    clear(target)


class CommitLog:
    """The log of the dataset or group of datasets at `root`; a commit is a JSON document with the whole state."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.path = f"{self.root}/{LOG}"

    def _numbers(self) -> dict[int, str]:
        found = {}
        for name in names(self.spark, self.path):
            number = name.split("-")[0]
            if number.isdigit():
                found[int(number)] = name
        return found

    def latest(self) -> dict[str, Any] | None:
        """The state as committed last; None where nothing is."""
        known = self._numbers()
        if not known:
            return None
        lines = self.spark.read.schema("value string").text(f"{self.path}/{known[max(known)]}", wholetext=True)
        return json.loads(lines.first().value)

    def commit(self, state: dict[str, Any]) -> None:
        """Make `state` the current one: the rename of a single file."""
        known = self._numbers()
        number = max(known, default=0) + 1
        schema = T.StructType([T.StructField("value", T.StringType())])
        one = self.spark.createDataFrame([(json.dumps(state),)], schema).coalesce(1)
        one.write.mode("append").option("mapreduce.output.basename", f"{number:012d}").text(self.path)
        for old in sorted(known)[: max(0, len(known) - _KEPT + 1)]:
            delete(self.spark, f"{self.path}/{known[old]}")


def fresh_name() -> str:
    """A name that no earlier write has used."""
    return uuid.uuid4().hex[:16]


# ---- a dataset in one folder, replaced as a whole ----


def replace_dataset(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the dataset in a folder by `df`, partitioned by `keys`.

    The new files come to lie beside the old ones, in the same partition folders. The commit names them by
    what their names start with, which readers go by; then the old ones are deleted.
    """
    spark = df.sparkSession
    first = not exists(spark, path)
    prefix = fresh_name()
    df.write.mode("append").option("mapreduce.output.basename", prefix).partitionBy(*keys).parquet(path)
    CommitLog(spark, path).commit({"files": prefix})
    if not first:
        delete_files(spark, path, but=prefix)


def read_dataset(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The dataset in a folder: by its log, or the folder as it is where there is none."""
    reader = spark.read.schema(schema)
    state = CommitLog(spark, path).latest()
    if state:
        reader = reader.option("pathGlobFilter", f"{state['files']}-*")
    return reader.parquet(path)


# ---- tables of many parts under one root ----


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def stage(df: DataFrame, root: str, table: str, name: str, keys: list[str]) -> list[str]:
    """Write a part of a table and return its partition folders, which a commit can name; without keys, its own.

    The part replaces what an earlier attempt of the same name has left.
    """
    spark, part = df.sparkSession, f"part={name}"
    path = f"{table_path(root, table)}/{part}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(path)
    return [f"{part}/{folder}" for folder in names(spark, path) if "=" in folder] if keys else [part]


def read_parts(spark: SparkSession, root: str, table: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    """The rows of some partition folders of a table; no other folder is listed or read."""
    if not folders:
        return spark.createDataFrame([], schema)
    base = table_path(root, table)
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*[f"{base}/{folder}" for folder in folders]).select(schema.fieldNames())


def folder_key(folder: str) -> str:
    """The partition of a folder, whichever part it is of."""
    return folder.split("/", 1)[1]


def delete_parts(spark: SparkSession, root: str, table: str, *, but: list[str]) -> None:
    """Delete the partition folders of a table that a commit no longer names."""
    base, live = table_path(root, table), set(but)
    for part in names(spark, base):
        if part in live:
            continue
        folders = [f"{part}/{name}" for name in names(spark, f"{base}/{part}") if "=" in name]
        if not live & set(folders):
            delete(spark, f"{base}/{part}")
            continue
        for folder in folders:
            if folder not in live:
                delete(spark, f"{base}/{folder}")
