"""Corpus analytics and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import models
from ridgeline.plans.registry import query, table


@query()
def a18_neighbour_enrichment(spark, sf_dir):
    rows = models.principal(table(spark, sf_dir, "embeddings"), "embedding", 50).select("vec_id", "label", "components")
    return models.neighbour_enrichment(models.all_neighbours(rows), rows.select("vec_id", F.col("label").alias("family"), (F.col("vec_id") % 50).alias("paper")))


@query()
def r9_forest_baseline(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    types = [r.p_type for r in part.select("p_type").where("p_type is not null").distinct().orderBy("p_type").collect()]
    rows = part.select("p_partkey", "p_brand", F.expr("nullif(p_size, 7)").cast("double").alias("size"), F.col("p_retailprice").alias("price"), *(F.coalesce(F.col("p_type") == t, F.lit(False)).cast("double").alias(f"type{i}") for i, t in enumerate(types)))
    return models.forest_scores(rows, ["size", "price"], [f"type{i}" for i in range(len(types))], "p_brand", key="p_partkey")


@query()
def r10_principal_components(spark, sf_dir):
    return models.principal(table(spark, sf_dir, "embeddings"), "embedding", 8).select("vec_id", F.round(F.abs(F.get("components", F.lit(0))), 6).alias("c0"))


@query("SELECT max(n) / sum(n) AS majority, sum(n * n) / (sum(n) * sum(n)) AS permuted_expected FROM (SELECT p_type, CAST(count(*) AS DOUBLE) AS n FROM part GROUP BY p_type)")
def r12_frequency_baseline(spark, sf_dir):
    return models.frequency_baseline(table(spark, sf_dir, "part"), "p_type")
