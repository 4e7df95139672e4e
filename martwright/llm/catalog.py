"""Named queries over the given tables, one per operator, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martwright.llm import (
    decontamination,
    jaccard_join,
    license_scan,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    source_divergence,
    source_mixing,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from martwright.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed_spans(read(spark, sf_dir, "documents"), substring_dedup.DedupParams(least_line_words=3))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(read(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = token_counts.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), scores, public_tokenizers.PATTERN)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), url_filter.default_rules())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.words_taken(read(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic_runs.plant(read(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(planted))


def registry() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def oracle() -> dict[str, str]:
    return {
        "op8_url_filters": url_filter.oracle_sql(),
        "op11_source_mixing": source_mixing.oracle_sql(),
        "op12_source_divergence": source_divergence.oracle_sql(),
    }
