"""Registered queries of the operators: thin digests of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.oracle import ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(n: int) -> F.Column:
    """crc32 of doc_id as text, modulo ``n`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; the model learns outside fold 0."""
    from fraudlake.llm import quality

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(_fold(5) != 0))
    return quality.score(docs, model).select(
        "doc_id", (_fold(5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate classes of all documents."""
    from fraudlake.llm.simhash import simhash_classes

    classes = simhash_classes(_table(spark, sf_dir, "documents"), shingle=4, max_distance=4)
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                          "component_id")


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated 400-byte strings in all documents."""
    from fraudlake.llm.suffix import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), length=400, digest=True)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC round trip of all pages: lengths and digests of responses are those of
    the bytes read back."""
    from fraudlake.llm.warc import archive_pages

    back = archive_pages(_table(spark, sf_dir, "pages"), payload="digest")
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to_id").alias("refers_to"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of all documents."""
    from fraudlake.llm.pii import all_spans, find_spans

    return find_spans(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256"),
        all_spans(F.col("base"), F.col("added")).alias("spans"))


def op6_ego(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding near-duplicate classes of all vectors."""
    from fraudlake.llm.ego import join_classes

    return join_classes(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest neighbours of every hundredth vector among all vectors."""
    from fraudlake.llm.ann import search

    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; the model learns outside fold 2."""
    from fraudlake.llm import toxicity

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(_fold(4) != 2))
    return toxicity.score(docs, model).select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    from fraudlake.llm.mixing import mix, taken_words

    taken = taken_words(*mix(_table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source")))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source",
                        "shard")


def op10_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """BPE round trip of all documents with the public tokenizer file."""
    from fraudlake.llm.bpe import round_trip_digests

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return round_trip_digests(_table(spark, sf_dir, "documents"), path)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened coordinates of all vectors."""
    from fraudlake.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"), components=4, scale=256.0)


def op12_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token records of all documents, written and read back."""
    import public_tokenizers

    from fraudlake.llm.records import archive_tokens

    back = archive_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, end_id=0)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in all documents."""
    import public_tokenizers

    from fraudlake.llm.alignment import Files, align

    return align(_table(spark, sf_dir, "documents"), Files(
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's result."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_suffix": op3_suffix,
    "op4_warc": op4_warc,
    "op5_pii": op5_pii,
    "op6_ego": op6_ego,
    "op7_ann": op7_ann,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_bpe": op10_bpe,
    "op11_whitening": op11_whitening,
    "op12_records": op12_records,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}
