"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns
of documents, and are written in the shared folder before the next one reads them. Stage 1 drops rejected documents (its
limits are fitted to the labelled ones), stage 2 leaves one document of each group of near duplicates (shingles
of five words, similarity 0.8 or more), stage 3 drops documents that contain benchmark items, stage 4 replaces secrets
by a mark and keeps every document, stage 5 returns each document's place in a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm import decontam, ngram_join, packing, quality, secrets
from ridgeline.llm.common import Tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.deduplicated(docs, k=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def length_bucket_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packing(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("length_bucket_packing", length_bucket_packing),
]

#: SQL has no compression, tokenizer or prefix join; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, last = Tables(spark), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = tables.cut(stage(spark, docs, sf_dir))
        if last is not None:
            tables.drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
