"""Documents to packed training sequences, stage by stage.

Each stage takes all documents that the one before kept, with the columns of `documents`; the last
one gives the pieces of the packed sequences. Null texts are empty texts; an empty table passes through. Further
columns come back as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.llm.common import free_name, materialise, table
from cellflux.llm.jaccard import BROADCAST_IDS, near_groups
from cellflux.llm.mixing import dealt
from cellflux.llm.packing import packed
from cellflux.llm.queries import word_tokenizer
from cellflux.llm.toxicity import fitted, scored

TOXIC = 0.5
KEPT_TOKENS = 0.9  # tokens that the mixture keeps, as a share of those it gets


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, fitted on their labels, does not reject."""
    machine = fitted(docs, table(spark, sf_dir, "labels"))
    score = free_name("_toxicity", docs.columns)
    return scored(docs, machine, score).filter(F.col(score) < TOXIC).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each near-duplicate group.

    Rows are grouped by their texts, whatever their ids; rows without any word only with those of the
    same id, and those without id with each other. First is the row of the smallest id, one without
    id last; then of the smallest hash of the text, then of the other columns. Only rows to be dropped are
    joined with the texts, and these are broadcast if they are few.
    """
    row = free_name("_near_row", docs.columns)
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")
    groups = near_groups(rows.select(F.col(row).alias("doc_id"), "text")).select(
        F.col("doc_id").alias(row), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group")
    )
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    place = F.struct(
        F.col("doc_id").isNull().alias("nameless"),
        "doc_id",
        F.xxhash64("text").alias("text"),
        F.xxhash64(F.lit(0), *others).alias("others"),
        F.col(row).alias("row"),
    )
    # From here on there are no columns of the caller, but for the row number.
    placed = materialise(rows.select(row, place.alias("#place")).join(groups, row).select(
        F.col(row).alias("row"), F.col("#place").alias("place"), "group"
    ), "pipeline-groups")
    wordless = F.when(F.col("group").isNull(), F.col("place.doc_id"))
    first = placed.groupBy("group", wordless).agg(F.min("place").alias("place"))
    first = first.select(F.col("place.row").alias("row"))
    dropped = materialise(placed.select("row").join(first, "row", "left_anti"), "pipeline-dropped")
    few = dropped.count() <= BROADCAST_IDS
    dropped = dropped.select(F.col("row").alias(row))
    return rows.join(F.broadcast(dropped) if few else dropped, row, "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample of documents, none of them twice, that brings sources, languages and topics nearest to their weights.

    It has `KEPT_TOKENS` of the tokens: what is scarce stays whole, and what there is too much of gives the rest.
    """
    return dealt(docs, budget=KEPT_TOKENS, copies=1.0).filter("taken > 0").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packed(docs, word_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("mixture", mix),
    ("packing", pack),
]

# The first stage is a trained model, and the last a tokenizer's ids, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
