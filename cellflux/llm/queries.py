"""The numbered operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.llm.alignment import aligned
from cellflux.llm.bytepairs import decoded, encoded
from cellflux.llm.common import id_fold, materialise, table
from cellflux.llm.graphs import nearest
from cellflux.llm.jaccard import near_groups
from cellflux.llm.lattice import likelihoods, vocabulary
from cellflux.llm.licences import licence_matches, licence_sql
from cellflux.llm.mixing import dealt, mixing_sql, word_count
from cellflux.llm.packing import packed
from cellflux.llm.pages import extracted
from cellflux.llm.rollup import RollupStore
from cellflux.llm.simhash import NEAR_BITS, edited_pairs, likeness, near_counts
from cellflux.llm.toxicity import fitted, scored
from cellflux.llm.whitening import whitened
from cellflux.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extracted(table(spark, sf_dir, "pages"))


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text under a subword lattice fitted to four folds of five."""
    import public_tokenizers

    pieces, start = vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return likelihoods(table(spark, sf_dir, "documents"), pieces, start)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts, how like they are to those of the edited and the next text, and what is near.

    `near_prints` is the number of other fingerprints of the table within three bits, by permuted block tables.
    """
    prints = materialise(edited_pairs(table(spark, sf_dir, "documents")), "simhash-prints")
    own = F.col("fingerprint")
    return near_counts(prints, NEAR_BITS).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(own, F.col("next_fingerprint")).alias("near_next"),
        F.col("near").alias("near_prints"),
    )


def word_tokenizer() -> str:
    """The public vocabulary file that the packing query is stated for."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, each window with the corpus's shares of sources."""
    return packed(table(spark, sf_dir, "documents"), word_tokenizer())


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_groups(table(spark, sf_dir, "documents"))


def op6_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's raked weight, how often it is expected, and how often the sample has it."""
    return dealt(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "source",
        "lang",
        "topic",
        "tokens",
        F.round("weight", 6).alias("weight"),
        F.round("expected", 8).alias("expected"),
        "taken",
    )


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence templates found in the documents."""
    return licence_matches(table(spark, sf_dir, "documents")).withColumn("dice", F.round("dice", 6))


# Fixed value: a piece is a run of letters and digits, or one other visible ASCII character.
PIECE = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]"


def op9_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of the distinct texts, reached by five batches of which two are replays.

    First every document comes in with an estimate under `words`; then the estimates are
    revised to counts; then the counts of a second tokenizer version come in; then all copies of a
    text but that with the smallest id are deleted.
    """
    text = F.coalesce("text", F.lit(""))
    counted = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        F.floor(F.coalesce("n_chars", F.lit(0)) / 6).alias("estimate"),
        word_count("text").alias("words"),
        F.regexp_count(text, F.lit(PIECE)).cast("long").alias("pieces"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
    )
    counted = materialise(counted, "token-counts")
    # A text with very many copies is a row per source and language before it meets the others.
    kinds = counted.groupBy("digest", "source", "lang", "words", "pieces").agg(
        F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("doc_id")
    )
    kinds = materialise(kinds, "token-copies")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "source", "lang")
    first = kinds.groupBy("digest").agg(F.min(place).alias("first"))
    copies = kinds.join(first, "digest").withColumn(
        "times", F.col("rows") - F.when(place.eqNullSafe(F.col("first")), 1).otherwise(0)
    )

    def events(rows: DataFrame, action: str, tokenizer: str, tokens: str, old: str | None = None):
        return rows.select(
            "source",
            "lang",
            F.lit(tokenizer).alias("tokenizer"),
            F.lit(action).alias("action"),
            F.col(tokens).alias("tokens"),
            (F.col(old) if old else F.lit(None).cast("long")).alias("old_tokens"),
            (F.col("times") if "times" in rows.columns else F.lit(1)).alias("times"),
        )

    store = RollupStore(spark, scratch_path(spark, "token-rollup"))
    revised = events(counted, "revise", "words", "words", "estimate")
    deleted = events(copies, "delete", "words", "words").unionByName(
        events(copies, "delete", "pieces", "pieces")
    )
    store.commit("load", events(counted, "insert", "words", "estimate"))
    store.commit("count", revised)
    store.commit("count", revised)
    store.commit("second-tokenizer", events(counted, "insert", "pieces", "pieces"))
    store.commit("dedup", deleted)
    store.commit("dedup", deleted)
    return store.totals()


def op9_bpe_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by a real tokenizer version: loaded with an estimate, revised to the counts of its ids, replayed, and what is empty deleted."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = encoded(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, ("source", "lang", "n_chars"))
    counted = ids.select(
        "source",
        "lang",
        F.lit("byte_bpe_multi_50k").alias("tokenizer"),
        F.floor(F.octet_length("ids") / 4).alias("count"),
        F.floor(F.coalesce("n_chars", F.lit(0)) / 3).alias("estimate"),
    )
    counted = materialise(counted, "bpe-counts")

    def events(action: str, tokens: str, old: str | None = None) -> DataFrame:
        before = F.col(old) if old else F.lit(None).cast("long")
        rows = counted.withColumns({"action": F.lit(action), "tokens": F.col(tokens), "old_tokens": before})
        return rows.select("source", "lang", "tokenizer", "action", "tokens", "old_tokens", F.col("count").alias("size"))

    store = RollupStore(spark, scratch_path(spark, "bpe-rollup"))
    for batch, rows in (
        ("load", events("insert", "estimate")),
        ("count", events("revise", "count", "estimate")),
        ("count", events("revise", "count", "estimate")),
        ("empty", events("delete", "count").filter("size = 0")),
    ):
        store.commit(batch, rows.drop("size"))
    return store.totals()


OP9_SQL = r"""
WITH counted AS (
    SELECT source, lang, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words,
        len(regexp_extract_all(t, '[A-Za-z0-9\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]')) AS pieces
    FROM (SELECT *, coalesce(text, '') AS t FROM documents)
    QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, source NULLS FIRST, lang NULLS FIRST) = 1
)
SELECT source, lang, 'words' AS tokenizer, count(*) AS docs, sum(words)::BIGINT AS tokens
FROM counted GROUP BY source, lang
UNION ALL
SELECT source, lang, 'pieces', count(*), sum(pieces)::BIGINT FROM counted GROUP BY source, lang
"""

def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the fold 0 of five are never learned from."""
    documents = table(spark, sf_dir, "documents")
    machine = fitted(documents, table(spark, sf_dir, "labels"))
    return scored(documents.select("doc_id", "text"), machine).select(
        "doc_id",
        (id_fold("doc_id") == 0).alias("held_out"),
        F.col("_toxicity").alias("score"),
        F.when(F.col("_toxicity") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened coordinates of every vector."""
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's byte-level ids and of what they decode to."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = encoded(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return decoded(ids, ranks).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every text's tokens under two tokenizers."""
    import public_tokenizers

    def digest(groups: Column) -> Column:
        return F.when(groups == "", "").otherwise(F.sha2(groups.cast("binary"), 256))

    documents, _ = aligned(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        digest,
    )
    return documents.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_lattice": op2_lattice,
    "op3_simhash": op3_simhash,
    "op4_packing": op4_packing,
    "op5_jaccard": op5_jaccard,
    "op6_graph_search": op6_graph_search,
    "op7_mixture": op7_mixture,
    "op8_licences": op8_licences,
    "op9_token_rollup": op9_token_rollup,
    "op9_bpe_rollup": op9_bpe_rollup,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_alignment": op13_alignment,
}
ORACLES: dict[str, str] = {
    "op7_mixture": mixing_sql(),
    "op8_licences": licence_sql(),
    "op9_token_rollup": OP9_SQL,
}
