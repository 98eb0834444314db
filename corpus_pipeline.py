"""Corpus pipeline: five stages from raw documents to tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm import bpe, mixing, pii, simhash, toxicity
from fraudlake.llm.common import staged


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3; the model learns from the
    labels of all documents that are not in the held-out fold."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold != 2)
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 4 or fewer of 64 bits (four-word
    shingles): that with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=4, max_distance=4)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, terms that give it away removed or
    generalised."""
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: a row per document and pass over it."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from them."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_copies),
    ("pii", remove_personal_data),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

ORACLE_SQL: str | None = None  # no stage but the word counts can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is staged in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
