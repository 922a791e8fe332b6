from __future__ import annotations

import pytest

from ..conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeats, ties, and columns whose names clash with working names."""
    long = " ".join(f"w{i % 9973}" for i in range(60_000))
    rows = [
        (1, "one two three four five six seven", "en", "a", 1),
        (2, "one two three four five six seven", "en", "a", 1),
        (2, "one two three four five six seven", "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "", "", 0),
        (5, " \t\n\r ", "en", "b", 5),
        (6, long, "en", "b", 6),
        (None, "no id here", "en", "a", 2),
        (None, None, "en", None, 2),
        (7, "Été     x\x1cy  z\n\nz <|endoftext|> [INST] \\ </s>", "fr", "c", 9),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("size", "s_key", "m_key", "hash", "key", "h", "shingle", "sim_digest", "dec_hash", "mix_size", "range", "node", "shard", "slot", "n_words", "failed_bits",
                 "sim_id", "sim_key", "dec_id", "dec_key", "mix_id", "mix_shard", "clean_text", "fingerprint", "copies", "target", "text_hash", "kept_0"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
