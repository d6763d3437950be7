"""What the operators of this subpackage share: tables, scratch tables, word rules."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.session import scoped_conf, scratch_path

# Fixed value: a word is a run of anything but these ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str, batch: int | None = None) -> DataFrame:
    """Write to the cluster's shared folder and read back.

    Cuts the lineage, so that a lost executor costs no earlier stage, and gives every
    later use of the result the same rows in the same files. `batch` bounds the rows that a
    Python worker gets at a time, for rows that may be long. What was shuffled for it goes from the executors' disks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    conf = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if batch:
        conf["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(batch)
    with scoped_conf(spark, conf):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WORKER: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What an operator keeps in a Python worker between tasks; another operator's goes first."""
    if _WORKER and owner not in _WORKER:
        _WORKER.clear()
        release()
    return _WORKER.setdefault(owner, {})


def released(batches: Iterator) -> Iterator:
    """The batches, after which a Python worker gives the memory it no longer uses back to the system.

    Workers outlive their tasks, and beside them an executor needs the memory for its JVM.
    """
    yield from batches
    release()


def release() -> None:
    """Free memory goes back to the system: that of dropped objects, of Arrow's pool and of the C library."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def ascii_lower(text: str | Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_fold(doc_id: str | Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo `folds`; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def free_name(name: str, columns: list[str]) -> str:
    """The name, with underscores added until no column has it in any spelling."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
