"""Readers and writers as queries: each writes files of its own in the shared folder from a table, and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.functions import text
from ridgeline.operators import calibration, search
from ridgeline.plans.registry import query, table
from ridgeline.sources import files, scratch
from ridgeline.streaming import ingest


@query("SELECT 'f' || n_nationkey AS figure_id, CASE n_nationkey % 3 WHEN 0 THEN 'accepted' ELSE 'partial' END AS status FROM nation WHERE n_nationkey % 3 < 2")
def s1_report_scan(spark, sf_dir):
    k = F.col("n_nationkey")
    folder = scratch.folder(spark, "reports")
    rows = table(spark, sf_dir, "nation").select(k.alias("at"), F.concat(F.lit("f"), k).alias("figure_id"), F.when(k % 3 == 0, "accepted").when(k % 3 == 1, "partial").otherwise("rejected").alias("status"))
    rows.write.partitionBy("at").json(folder)
    return files.reports(spark, folder, "*.json").select("figure_id", "status")


_QUOTED = "p_name || ' \"' || p_type || '\",' || chr(10) || p_brand"


def _quoted(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(' "'), "p_type", F.lit('",\n'), "p_brand").alias("cell"))


@query(f"SELECT p_partkey, {_QUOTED} AS cell FROM part")
def s3_quoted_csv(spark, sf_dir):
    folder = scratch.folder(spark, "quoted")
    _quoted(spark, sf_dir).write.options(header=True, quoteAll=True, escape='"').csv(folder)
    return files.csv_table(spark, folder).select(F.col("p_partkey").cast("long").alias("p_partkey"), "cell")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def s5_gzip_csv(spark, sf_dir):
    folder = scratch.folder(spark, "gzip")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").write.options(header=True, compression="gzip").csv(folder)
    return files.csv_table(spark, folder).select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderstatus")


@query("SELECT n_nationkey, n_name FROM nation")
def s6_marked_csv(spark, sf_dir):
    """A table with a byte order mark before its header, and a column under another name."""
    folder = scratch.folder(spark, "marked")
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("﻿key"), F.col("n_name").alias("nation"))
    rows.coalesce(1).write.option("header", True).csv(folder)
    return files.csv_table(spark, folder, {"n_nationkey": ["key"], "n_name": ["nation"]}).select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name")


_MEANS = "SELECT 's' || label AS series_id, CAST(r.pos AS DOUBLE) AS two_theta_deg, round(avg(CAST(embedding[r.pos + 1] AS DOUBLE)), 6) AS relative_intensity FROM embeddings, range(64) r(pos) GROUP BY label, r.pos"


def _means(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "v"))
    means = rows.groupBy("label", "pos").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("relative_intensity"))
    return means.select(F.concat(F.lit("s"), "label").alias("series_id"), F.col("pos").cast("double").alias("two_theta_deg"), "relative_intensity")


@query(_MEANS)
def s9_series_csv(spark, sf_dir):
    folder = scratch.folder(spark, "series")
    files.write_series(_means(spark, sf_dir), folder)
    return files.curve_points(files.csv_table(spark, folder))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def s9_accepted_csv(spark, sf_dir):
    folder = scratch.folder(spark, "accepted")
    files.write_accepted(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), folder, F.col("o_orderstatus") == "F", ["o_orderkey"])
    return files.csv_table(spark, folder).select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderpriority")


@query(f"SELECT 'f' || substr(series_id, 2) AS figure_id, series_id, two_theta_deg, relative_intensity FROM ({_MEANS})")
def s10_figure_csv(spark, sf_dir):
    folder = scratch.folder(spark, "figures")
    files.write_figures(_means(spark, sf_dir).withColumn("figure_id", F.concat(F.lit("f"), F.substr("series_id", F.lit(2)))), folder)
    rows = files.csv_table(spark, folder)
    return rows.select("figure_id", "series_id", files.number(F.col("two_theta_deg")).alias("two_theta_deg"), files.number(F.col("relative_intensity")).alias("relative_intensity"))


@query("SELECT o_custkey, count(*) > 3 AS changed FROM orders GROUP BY o_custkey")
def s10_changed_figures(spark, sf_dir):
    """Which customers' orders differ from a copy in which those with more than three have one order twice in place of another."""
    from pyspark.sql import Window

    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    n, k = F.count(F.lit(1)).over(Window.partitionBy("o_custkey")), F.row_number().over(w)
    swap = lambda c: F.when((F.col("n") > 3) & (F.col("k") == 2), F.lag(c).over(w)).otherwise(F.col(c)).alias(c)
    copy = o.withColumns({"n": n, "k": k}).select("o_custkey", swap("o_orderkey"), swap("o_totalprice"))
    both = files.content_hash(o, "o_custkey").join(files.content_hash(copy, "o_custkey").withColumnRenamed("hash", "other"), "o_custkey")
    return both.select("o_custkey", (F.col("hash") != F.col("other")).alias("changed"))


@query("SELECT count(*) AS figures, count(*) FILTER (WHERE o_orderstatus = 'F') AS accepted, count(*) FILTER (WHERE o_orderstatus = 'P') AS partial, count(*) FILTER (WHERE o_orderstatus = 'O') AS rejected, 0::BIGINT AS needs_review FROM orders")
def s12_run_summary(spark, sf_dir):
    s = F.col("o_orderstatus")
    folder = scratch.folder(spark, "summary")
    written = files.run_summary(table(spark, sf_dir, "orders").select(F.when(s == "F", "accepted").when(s == "P", "partial").otherwise("rejected").alias("status")), folder)
    return spark.read.schema(written.schema).json(folder)


@query("SELECT 'https://example.org/paper/' || replace(c_name, '#', '%23') AS loc, '0.8' AS priority, 'monthly' AS changefreq FROM customer UNION ALL VALUES ('https://example.org/', '1.0', 'daily'), ('https://example.org/docs/api', '0.5', 'monthly')")
def s23_sitemap(spark, sf_dir):
    """The addresses as they stand in the written files."""
    folder = scratch.folder(spark, "sitemap")
    files.write_sitemap(files.sitemap(table(spark, sf_dir, "customer"), "https://example.org", "c_name"), folder, "https://example.org")
    lines = spark.read.text(f"{folder}/sitemap").where("value like '%<loc>%'")
    part = lambda name: F.regexp_extract("value", f"<{name}>(.*)</{name}>", 1).alias(name)
    return lines.select(part("loc"), part("priority"), part("changefreq"))


@query("SELECT n_nationkey, true AS parses, 20 AS length FROM nation")
def dt4_run_stamp(spark, sf_dir):
    rows = files.stamped(table(spark, sf_dir, "nation").select("n_nationkey"))
    at = F.try_to_timestamp("generated_at", F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
    return rows.select("n_nationkey", (F.abs(F.unix_timestamp(at) - F.unix_timestamp(F.current_timestamp())) <= 1).alias("parses"), F.length("generated_at").alias("length"))


_REQUESTS = [({"limit": "7"}, True), ({"limit": "0"}, False), ({"limit": "1001"}, False), ({"limit": "x"}, False), ({"offset": "-1"}, False), ({"nope": "1"}, False), ({"admission": "clean,axis_verified"}, True), ({"admission": "dirty"}, False), ({"first_peak_min": "3", "first_peak_max": "2"}, False), ({"sort": "-first_peak"}, True), ({"sort": "size"}, False), ({"paper_id": "a b"}, False), ({}, True)]


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, {str(ok).lower()})" for i, (_, ok) in enumerate(_REQUESTS)) + ") AS v(request, accepted)")
def f8_parameter_validation(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select(*(F.lit("x").alias(c) for c in ("series_id", "paper_id", "figure_id", "material_group", "material", "role", "stacking_hump_status", "axis_verification", "admission", "first_peak_status")), F.lit(1.0).alias("first_peak"))

    def accepted(given: dict) -> bool:
        try:
            search.curves(rows, **given)
        except search.BadParameter:
            return False
        return True

    return spark.createDataFrame([(i, accepted(given)) for i, (given, _) in enumerate(_REQUESTS)], "request int, accepted boolean")


@query("""SELECT p_partkey, CASE WHEN v > 0 AND v BETWEEN 0.1 AND 90 THEN v END AS angle, CASE WHEN 1.5406 / (2 * v) <= 1 AND 2 * degrees(asin(least(1, 1.5406 / (2 * v)))) BETWEEN 0.1 AND 90 THEN round(2 * degrees(asin(least(1, 1.5406 / (2 * v)))), 9) END AS from_spacing
FROM (SELECT p_partkey, p_retailprice / 100.0::DOUBLE - 9 + p_size / 100.0::DOUBLE AS v FROM part)""")
def m3_peak_targets(spark, sf_dir):
    v = F.col("p_retailprice").cast("double") / 100.0 - 9 + F.col("p_size") / 100.0
    return table(spark, sf_dir, "part").select("p_partkey", search.target_angle(v).alias("angle"), F.round(search.target_angle(v, "d"), 9).alias("from_spacing"))


@query("""WITH p AS (SELECT user_id, event_id, value, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY value, event_id)),
f AS (SELECT *, greatest(0, max(value - i * 4) OVER (PARTITION BY user_id ORDER BY i)) + i * 4 AS f FROM p)
SELECT user_id, event_id, round(least(600 - (n - 1) * 4, min(f - i * 4) OVER (PARTITION BY user_id ORDER BY i DESC)) + i * 4, 6) AS value FROM f""")
def m19_label_spread(spark, sf_dir):
    return calibration.spread(table(spark, sf_dir, "events"), "user_id", "value", "event_id", 4.0, 0.0, 600.0).select("user_id", "event_id", F.round("value", 6).alias("value"))


@query("SELECT p_partkey FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'x' ELSE '' END || p_name AS t FROM part) WHERE contains(lower(t), 'red')")
def t28_contains_pattern(spark, sf_dir):
    """A caller's text with wildcards of its own finds only the text."""
    t = F.concat(F.when(F.col("p_partkey") % 3 == 0, "x").otherwise(""), "p_name")
    return table(spark, sf_dir, "part").where(t.ilike(text.like_pattern("%RED*"))).select("p_partkey")


_SEARCHES = [((3.4, 0.1), {}, "lowest peak near 3.4° 2θ; within 0.1° or the curve''s own axis uncertainty; sure peaks only"), ((3.3955, 0.25), {"entered": 26.0, "low_confidence": True}, "lowest peak near 26 Å, that is 3.396° 2θ at an assumed 1.5406 Å; within 0.25° or the curve''s own axis uncertainty; peaks of low confidence included"), ((None, 0.1), {"filters": ("hump detected",)}, "hump detected"), ((None, 0.1), {}, "")]


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{said}')" for i, (_, _, said) in enumerate(_SEARCHES)) + ") AS v(search, described)")
def t32_descriptions(spark, sf_dir):
    return spark.createDataFrame([(i, search.describe(*a, **k)) for i, (a, k, _) in enumerate(_SEARCHES)], "search int, described string")


@query("SELECT doc_id, source FROM documents")
def r3_resumable_ingest(spark, sf_dir):
    """Two runs over a folder that grows in between; the second reads only what is new."""
    folder = scratch.folder(spark, "ingest")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    for half in (0, 1):
        rows.where(F.col("doc_id") % 2 == half).write.mode("append").parquet(f"{folder}/in")
        ingest.ingest(spark, f"{folder}/in", "doc_id long, source string", f"{folder}/out", f"{folder}/checkpoint", "doc_id")
    return spark.read.parquet(f"{folder}/out").select("doc_id", "source")
