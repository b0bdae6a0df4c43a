"""The text operators over the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import (
    best_fit_packing,
    exact_dedup,
    jaccard_join,
    license_scan,
    quality_ranking,
    quality_rules,
    secret_scan,
    source_divergence,
    source_mix,
    substring_dedup,
    target_resampling,
    token_counts,
    toxicity,
)
from roadpulse.llm.common import benchmark, documents, labels


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, sf_dir))


def op2_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ranking.quality_scores(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(documents(spark, sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.clean_lines(documents(spark, sf_dir), carry=["doc_id"], with_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words", "base_failed", "kept"
    )


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_sources(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir), carry=["doc_id"]).drop("spans")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir), carry=["doc_id"])


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resample(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence_audit(documents(spark, sf_dir))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(documents(spark, sf_dir))
    return found.withColumn("spans", secret_scan.joined_spans())


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_substring_dedup,
        op2_quality_ranking,
        op3_best_fit_packing,
        op4_jaccard_join,
        op5_toxicity,
        op6_quality_rules,
        op7_source_mix,
        op8_token_counts,
        op9_license_scan,
        op10_exact_dedup,
        op11_target_resampling,
        op12_source_divergence,
        op13_secret_scan,
    ]
    return {query.__name__: query for query in found}
