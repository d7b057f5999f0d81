"""Rows that every operator must bear: NULLs, empty and long texts, ties, repeats, and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
CLASHING = ("row", "given", "kept", "text_sha256", "place", "fp", "component_id", "n_tokens", "item", "length",
            "oddness", "raw", "found", "spans", "kind", "word", "block", "digest", "size", "instance")

WORDS = "the quick brown fox jumps over a lazy dog while seven small birds watch from their old wooden fence".split()


def sentence(seed: int, n: int) -> str:
    """Words in an order that depends on the seed alone."""
    out, state = [], seed * 7919 + 17
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state >> 8 & 15] + str(state >> 16 & 63))
    return " ".join(out)


HARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one two"), (None, None),
    (6, "a  b\n\nc \x0b d"), (6, "a b c d"), (7, "don't <|endoftext|> we'll x 日本語 😀 é"), (8, "x" * 30_000),
    (9, "word " * 30_000), (10, "0" * 5_000), (11, sentence(1, 20_000)), (12, sentence(2, 80)), (13, sentence(2, 80)),
    (14, "mail ann.lee@example.com or +1 (415) 555-2671, card 4111 1111 1111 1111, host 10.0.0.1"),
    (-3, "!!! ### $$$ " * 40),
]


@pytest.fixture(scope="session")
def hard(spark):
    rows = spark.createDataFrame(HARD, "doc_id long, text string").repartition(3)
    return rows.withColumns({name: F.lit("clash") for name in CLASHING})


@pytest.fixture(scope="session")
def nothing(hard):
    return hard.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")
