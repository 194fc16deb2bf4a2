"""Sorts, limits, top-k, pages, samples."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ridgeline.operators import models
from ridgeline.plans.registry import query, table


@query("SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS p FROM orders ORDER BY p DESC NULLS LAST, o_orderkey LIMIT 500")
def l1_nulls_last(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr("nullif(o_orderpriority, '3-MEDIUM')").alias("p")).orderBy(F.col("p").desc_nulls_last(), "o_orderkey").limit(500)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200")
def l2_page(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(200).limit(100)


@query("SELECT asked, least(greatest(asked, 1), greatest(1, CAST(ceil(n / 50.0) AS BIGINT))) AS page FROM (SELECT count(*) AS n FROM part), (VALUES (-3), (1), (7), (1000000)) AS a(asked)")
def l3_page_clamp(spark, sf_dir):
    asked = spark.createDataFrame([(-3,), (1,), (7,), (1000000,)], "asked int")
    n = table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n"))
    return asked.crossJoin(F.broadcast(n)).select("asked", F.least(F.greatest(F.col("asked"), F.lit(1)), F.greatest(F.lit(1), F.ceil(F.col("n") / 50.0))).cast("long").alias("page"))


@query("""WITH q AS (SELECT vec_id AS q, embedding AS e FROM embeddings WHERE vec_id % 50 = 0), d AS (SELECT q, vec_id, round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (CAST(e[i] AS DOUBLE) - CAST(embedding[i] AS DOUBLE)) ** 2))), 9) AS d FROM q, embeddings WHERE q <> vec_id)
SELECT q, vec_id, k FROM (SELECT q, vec_id, row_number() OVER (PARTITION BY q ORDER BY d, vec_id) AS k FROM d) WHERE k <= 10""")
def l6_nearest_neighbours(spark, sf_dir):
    """Stated queries (ids divisible by 50) against all vectors; exact, with a running top ten a query."""
    near = models.top_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 10, "embedding")
    return near.select("q", "vec_id", F.col("place").cast("long").alias("k"))


@query("SELECT p_partkey, p_name FROM part ORDER BY p_size % 2 = 0, p_name, p_partkey LIMIT 300")
def l7_multi_key_sort(spark, sf_dir):
    return table(spark, sf_dir, "part").orderBy(F.col("p_size") % 2 == 0, "p_name", "p_partkey").limit(300).select("p_partkey", "p_name")


@query("SELECT o_orderkey, (k - 1) // 50 AS bucket FROM (SELECT o_orderkey, row_number() OVER (ORDER BY sha256('7:' || o_orderkey)) AS k FROM orders) WHERE k <= 250")
def l8_seeded_sample(spark, sf_dir):
    top = table(spark, sf_dir, "orders").select("o_orderkey", F.sha2(F.concat(F.lit("7:"), "o_orderkey"), 256).alias("h")).orderBy("h").limit(250)
    return top.withColumn("k", F.row_number().over(Window.orderBy("h"))).select("o_orderkey", F.floor((F.col("k") - 1) / 50).cast("long").alias("bucket"))


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10")
def l9_top_groups(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_brand").limit(10)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20")
def l10_most_recent(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(20).select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
