"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.decontaminate import decontaminate
from pairloom.llm.hosts import host_quality
from pairloom.llm.jaccard import jaccard_components
from pairloom.llm.language import identify_language
from pairloom.llm.lm import score_texts
from pairloom.llm.manifest import manifest
from pairloom.llm.merkle import edited_fingerprints
from pairloom.llm.mixing import mix_sources
from pairloom.llm.packing import pack_documents
from pairloom.llm.roles import repair_roles
from pairloom.llm.text import fold
from pairloom.llm.toxicity import fit_toxicity, score_toxicity
from pairloom.llm.warc import round_trip
from pairloom.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_roles(_table(spark, sf_dir, "conversations"))


def op2_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    remainder = fold(F.col("doc_id"), 5)
    model = fit_toxicity(docs, labels, remainder != 0)
    return score_toxicity(docs, model).select("doc_id", (remainder == 0).alias("held_out"), "score", "predicted")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).alias("taken"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = round_trip(_table(spark, sf_dir, "pages"))
    return read.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = fold(F.col("doc_id"), 3)
    predicted = identify_language(_table(spark, sf_dir, "documents"), remainder != 1)
    return predicted.select("doc_id", (remainder == 1).alias("held_out"), "lang_pred", "score")


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = fold(F.col("doc_id"), 5)
    scored = score_texts(_table(spark, sf_dir, "documents"), remainder != 1)
    return scored.select(
        "doc_id", (remainder == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked after the newlines of every second id were lost."""
    lost = F.when(fold(F.col("doc_id"), 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return manifest(_table(spark, sf_dir, "documents"), now={"text": lost})


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(_table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_role_repair,
        op2_merkle_fingerprint,
        op3_toxicity,
        op4_source_mixing,
        op5_warc,
        op6_language_id,
        op7_host_rules,
        op8_lm_score,
        op9_packing,
        op10_jaccard_join,
        op11_merkle_manifest,
        op12_benchmark_decontamination,
        op13_embedding_whitening,
    )
}
