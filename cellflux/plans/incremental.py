"""Daily totals that follow their input files.

A ledger holds partial totals per input file, date and cell. Since totals are sums, a file that is added, replaced or
removed changes its own rows of the ledger and the totals of its own dates, and nothing else is read or written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.commits import CommitLog, delete_parts, folder_key, fresh_name, names, read_parts, stage
from cellflux.config import Settings
from cellflux.functions import total_columns
from cellflux.operators import repair_measures, valid_cells, with_event_time
from cellflux.operators.lines import as_path
from cellflux.schema import DAILY_PARTITIONS, DAILY_SCHEMA, RECORD_SCHEMA, SEPARATOR, TOTALS
from cellflux.session import scratch_path
from cellflux.sources.records import record_files

# A file as it was read: its address, when it was changed, and its size.
_VERSION = T.StructField("version", T.StringType())
LEDGER_SCHEMA = T.StructType([_VERSION, *DAILY_SCHEMA])
FILES_SCHEMA = T.StructType(
    [T.StructField("uri", T.StringType()), _VERSION, T.StructField("folders", T.ArrayType(T.StringType()))]
)
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # Spark's name for the partition of a missing value
_EMPTY = {"files": [], "ledger": [], "daily": []}


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: addresses of files by what became of them, and the dates written again."""

    added: list[str]
    replaced: list[str]
    removed: list[str]
    dates: list[str]


def _version() -> Column:
    changed = F.unix_micros("_metadata.file_modification_time")
    return F.concat_ws("|", "_metadata.file_path", changed, "_metadata.file_size").alias("version")


def _listed(spark: SparkSession, input_path: str) -> DataFrame:
    """uri and version of each input file; no content is read."""
    files = spark.read.format("binaryFile").load(record_files(input_path))
    return files.select(F.col("_metadata.file_path").alias("uri"), _version())


def _partial(spark: SparkSession, uris: list[str], settings: Settings | None) -> DataFrame:
    """Totals per file, date and cell of some files."""
    paths = [as_path(uri) for uri in uris]
    records = spark.read.csv(paths, sep=SEPARATOR, header=False, schema=RECORD_SCHEMA, mode="PERMISSIVE")
    records = records.select("*", _version())
    events = with_event_time(repair_measures(valid_cells(records, settings)), settings)
    totals = events.groupBy("version", "date", "cell_id").agg(*total_columns())
    return totals.select(LEDGER_SCHEMA.fieldNames())


def read_incremental(spark: SparkSession, root: str) -> DataFrame:
    """The committed daily totals."""
    state = CommitLog(spark, root).latest() or _EMPTY
    return read_parts(spark, root, "daily", DAILY_SCHEMA, state["daily"])


def refresh_daily(
    spark: SparkSession, input_path: str, root: str, settings: Settings | None = None
) -> Refresh:
    """Bring the daily totals under `root` up to date with the record files of `input_path`.

    Files that have come, changed or gone since the last refresh are found by address, time and size. Only files that are
    new or changed are read, and only the dates that one of the files has or had are read from the ledger and written
    again, in parts that one commit exchanges for the old ones. The driver gets the addresses of the files that
    changed, and the dates. Settings that decide about dates or cells must stay the same.
    """
    log = CommitLog(spark, root)
    state = log.latest() or _EMPTY
    known = read_parts(spark, root, "files", FILES_SCHEMA, state["files"])
    now = _listed(spark, input_path)
    both = known.withColumnRenamed("version", "old").join(now, "uri", "full_outer")
    changed = both.filter(~F.col("old").eqNullSafe(F.col("version"))).collect()
    if not changed:
        return Refresh([], [], [], [])
    added = sorted(r.uri for r in changed if r.old is None)
    removed = sorted(r.uri for r in changed if r.version is None)
    replaced = sorted(r.uri for r in changed if r.old and r.version)
    gone = [r.old for r in changed if r.old is not None]

    name, fresh = fresh_name(), scratch_path(spark, "ledger")
    if added or replaced:
        _partial(spark, added + replaced, settings).write.partitionBy(*DAILY_PARTITIONS).parquet(fresh)
    else:
        spark.createDataFrame([], LEDGER_SCHEMA).write.parquet(fresh)
    partial = spark.read.schema(LEDGER_SCHEMA).parquet(fresh)
    touched = {folder for folder in names(spark, fresh) if "=" in folder}
    touched |= {folder for r in changed for folder in r.folders or []}

    kept = [folder for folder in state["ledger"] if folder_key(folder) in touched]
    before = read_parts(spark, root, "ledger", LEDGER_SCHEMA, kept)
    if gone:
        dead = spark.createDataFrame([(v,) for v in gone], T.StructType([_VERSION]))
        before = before.join(dead, "version", "left_anti")
    rows = before.select(LEDGER_SCHEMA.fieldNames()).unionByName(partial)
    ledger = stage(rows.hint("rebalance", *DAILY_PARTITIONS), root, "ledger", name, DAILY_PARTITIONS)
    sums = [F.sum(t).alias(t) for t in TOTALS]
    totals = read_parts(spark, root, "ledger", LEDGER_SCHEMA, ledger).groupBy("date", "cell_id").agg(*sums)
    totals = totals.select(DAILY_SCHEMA.fieldNames()).hint("rebalance", *DAILY_PARTITIONS)
    daily = stage(totals, root, "daily", name, DAILY_PARTITIONS)

    folder = F.concat(F.lit("date="), F.coalesce(F.col("date").cast("string"), F.lit(_NO_DATE)))
    read = partial.groupBy("version").agg(F.collect_set(folder).alias("folders"))
    same = known.join(now, ["uri", "version"], "left_semi").select(FILES_SCHEMA.fieldNames())
    new = now.join(known.select("uri", "version"), ["uri", "version"], "left_anti").join(read, "version", "left")
    files = stage(same.unionByName(new.select(FILES_SCHEMA.fieldNames())), root, "files", name, [])

    after = {"files": files}
    for table, made in (("ledger", ledger), ("daily", daily)):
        after[table] = [f for f in state[table] if folder_key(f) not in touched] + made
    log.commit(after)
    for table, folders in after.items():
        delete_parts(spark, root, table, but=folders)
    return Refresh(added, replaced, removed, sorted(folder.split("=", 1)[1] for folder in touched))
