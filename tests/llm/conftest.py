from __future__ import annotations

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 4999}" for i in range(40_000))


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null, empty, blank, one-word and very long texts; equal texts, rows and ids; clashing columns."""
    near = LONG.replace("w17 ", "other ", 1)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", None, "a", 0),
        (3, " \n\t ", "en", None, 3),
        (4, "word", "en", "a", 4),
        (5, LONG, "en", "a", len(LONG)),
        (6, near, "en", "b", len(near)),
        (7, "word", "de", "b", 4),
        (8, "Ünï’s   a.b 12% don't  x \U0001f600 <|endoftext|>", "fr", "b", None),
        (9, "one two three four", "en", "c", 18),
        (9, "one two three four", "en", "c", 18),
        (None, "no id here at all", "en", "c", 17),
        (-5, "ONE two\nthree  four", "en", "c", 19),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ["fingerprint", "key", "_row", "window", "n", "block", "_kept", "tokens", "_toxicity", "kind", "edited"]
    return df.withColumns({c: F.lit("x") for c in clashing})


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def tokenizer():
    from cellflux.llm.queries import word_tokenizer

    return word_tokenizer()
