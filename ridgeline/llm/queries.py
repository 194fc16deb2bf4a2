"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm import decontam, html_extract, langid, licenses, ngram_join, packing, quality, secrets, sharding, toxicity
from ridgeline.llm.common import table


def op1_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing(table(spark, sf_dir, "documents"), buckets=16, budget=16_384)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"), sample=1000)


def op3_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=8)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_texts(spark))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), k=3, percent=90)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ALL = (
    op1_length_bucket_packing,
    op2_html_extraction,
    op3_lpt_sharding,
    op4_quality_rules,
    op5_benchmark_decontamination,
    op6_license_scan,
    op7_language_id,
    op8_secret_scan,
    op9_ngram_jaccard_join,
    op10_toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    return {"op6_license_scan": licenses.sql()}
