import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


def hard_rows():
    """Documents with nulls, blanks, repeated rows, ties and a very long word."""
    base = "The quick brown fox jumps over the lazy dog while seven wizards quietly box"
    return [
        (1, base, "en", "a"), (1, base, "en", "a"), (2, base + " again", "en", "b"),
        (3, None, "en", "a"), (4, "", None, None), (5, "  \t\n ", "en", None),
        (None, base, None, "b"), (None, None, None, None), (6, "x" * 50_000, "de", "c"),
        (7, "one two three", "en", "a"), (8, "ONE TWO THREE", "en", "a"),
        (9, " ".join(f"w{k % 900}é" for k in range(20_000)), "fr", "a"),
        (10, "mail bob@site.example.com or +1 (962) 555-2005, 10.0.0.1", "en", "a"),
        (11, "mail bob@site.example.com or call Zanzibar", "en", "a"),
    ]


CLASH = ("fp", "key", "unit", "size", "copy", "row_hash", "text_key", "chunk", "v", "component_id")


@pytest.fixture(scope="session")
def hard_docs(spark):
    """:func:`hard_rows` with columns named like those the operators add."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(hard_rows(), "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})


@pytest.fixture(scope="session")
def no_docs(spark, hard_docs):
    return spark.createDataFrame([], hard_docs.schema)


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
