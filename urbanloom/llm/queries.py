"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    cover_tree,
    importance,
    line_dedup,
    lsh_forest,
    merkle,
    mixing,
    quality_model,
    quality_rules,
    suffix_dedup,
    surrogates,
    token_files,
    warc,
)
from .common import table
from .oracles import ORACLES  # noqa: F401

#: The key of the registered query; a real run takes its own from a secret store.
SURROGATE_KEY = "registered-query"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(documents, counts=True)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_files.token_files(
        table(spark, sf_dir, "documents"),
        tokenizer=public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
        with_ids=False,
    )
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_bpe.encode_documents(
        table(spark, sf_dir, "documents"),
        ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
        with_ids=False,
    )
    return found.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_model.scored(documents, labels, ~held_out).select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(documents, key=SURROGATE_KEY, counts=True)


def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), depth=50, with_kept=False).withColumnRenamed("id", "doc_id")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resampled(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), lengths=(1, 1), buckets=10_000, seed=2024
    )
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = merkle.manifest(
        table(spark, sf_dir, "documents"),
        columns=["doc_id", "source", "lang", "n_chars", "text"],
        id_col="doc_id",
        group_col="lang",
        claims={"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))},
    )
    return merkle.verified(rows).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_files": op2_token_files,
    "op3_mixing": op3_mixing,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_cover_tree": op5_cover_tree,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_model": op7_quality_model,
    "op8_surrogates": op8_surrogates,
    "op9_lsh_forest": op9_lsh_forest,
    "op10_warc": op10_warc,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_importance": op12_importance,
    "op13_merkle": op13_merkle,
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline; its module lies beside the driver contract."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
