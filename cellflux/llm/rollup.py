"""Token counts kept up to date by signed batches (operator 9).

A store is one Parquet table of additive deltas, partitioned by `batch_id`. A batch is
summed before it is written, as one overwrite of its own partition: a batch that failed
half-way is simply written again, and a batch that the store already holds is not taken
a second time. Every commit leaves one row without a key, so that a batch without
effect counts as committed too.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
_FIRST = "-"  # the batch that creates the store
_SCHEMA = (
    "source string, lang string, tokenizer string, is_commit boolean, "
    "docs bigint, tokens bigint, batch_id string"
)


def signed(events: DataFrame) -> DataFrame:
    """Events as additive (docs, tokens) per key.

    `events`: source, lang, tokenizer, action, tokens, old_tokens. An insert adds a document
    and its tokens, a delete takes both away, a revision adds what the count has changed by.
    A column `times`, if there is one, says how many equal events a row stands for.
    A missing count is 0; a missing or unknown action changes nothing; a missing source,
    language or tokenizer is a key of its own. Further columns are ignored.
    """
    action, new = F.col("action"), F.coalesce("tokens", F.lit(0))
    docs = F.when(action == "insert", 1).when(action == "delete", -1).otherwise(0)
    tokens = (
        F.when(action == "insert", new)
        .when(action == "delete", -new)
        .when(action == "revise", new - F.coalesce("old_tokens", F.lit(0)))
        .otherwise(0)
    )
    times = F.col("times") if "times" in events.columns else F.lit(1)
    return events.select(
        *KEYS, (docs * times).cast("long").alias("docs"), (tokens * times).cast("long").alias("tokens")
    )


class RollupStore:
    """Totals by source, language and tokenizer version under a shared folder, made if it is not there."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        if not self._is_there():
            self._write(spark.createDataFrame([], _SCHEMA), _FIRST)

    def _is_there(self) -> bool:
        try:
            return self.has(_FIRST)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def _write(self, sums: DataFrame, batch_id: str) -> None:
        mark = self.spark.range(1).select(
            *[F.lit(None).cast("string").alias(k) for k in KEYS],
            F.lit(True).alias("is_commit"),
            *[F.lit(0).cast("long").alias(c) for c in ("docs", "tokens")],
        )
        rows = mark.unionByName(sums.drop("batch_id")).withColumn("batch_id", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch_id"
        ).parquet(self.path)

    def _deltas(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def has(self, batch_id: str) -> bool:
        return not self._deltas().filter(F.col("batch_id") == batch_id).isEmpty()

    def commit(self, batch_id: str, events: DataFrame) -> bool:
        """Take a batch; False, and no change, if the store has it already.

        Sums are made in each scan task before the one shuffle, so a source with a third
        of all rows sends a row per task.
        """
        if self.has(batch_id):
            return False
        sums = signed(events).groupBy(KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        changed = sums.filter((F.col("docs") != 0) | (F.col("tokens") != 0))
        self._write(changed.withColumn("is_commit", F.lit(False)), batch_id)
        return True

    def totals(self) -> DataFrame:
        """Current totals per key; keys whose documents are all gone are left out."""
        return (
            self._deltas()
            .filter(~F.col("is_commit"))
            .groupBy(KEYS)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .filter((F.col("docs") != 0) | (F.col("tokens") != 0))
        )

    def compacted(self, path: str) -> RollupStore:
        """A new store with the same totals in one batch, which still knows all batch ids."""
        store = RollupStore(self.spark, path)
        ids = self._deltas().filter("is_commit").filter(F.col("batch_id") != _FIRST)
        total = self.totals().select(*KEYS, F.lit(False).alias("is_commit"), "docs", "tokens")
        rows = ids.unionByName(total.withColumn("batch_id", F.lit(_FIRST)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch_id"
        ).parquet(path)
        return store
