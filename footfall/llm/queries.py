"""Registered queries of the operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    decontaminate,
    divergence,
    html_text,
    lm_score,
    near_dedup,
    negatives,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    substrings,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), shifted.alias("label"), negatives.quantized(F.col("embedding")).alias("vector")
    )
    return negatives.hard_negatives(rows, F.col("id") % 50 == 0)


def op12_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    hexadecimal = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", hexadecimal, "component_id")


def llm_queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_best_fit_packing,
            op2_toxicity,
            op3_minhash_near_dedup,
            op4_substring_dedup,
            op5_html_extraction,
            op6_benchmark_decontamination,
            op7_lm_scoring,
            op8_sharding,
            op9_pii,
            op10_quality_rules,
            op11_hard_negatives,
            op12_source_divergence_audit,
            op13_simhash_near_dedup,
        )
    }
