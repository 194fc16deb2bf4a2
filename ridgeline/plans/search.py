"""The API's queries over stand-ins: customers are papers, orders figures and curves, part labels materials."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import groups, search
from ridgeline.plans.registry import query, table

_INDEX = """SELECT c_custkey AS paper_number, 'p' || c_custkey AS paper_id, c_name AS title, c_mktsegment AS journal, CAST(2000 + c_nationkey AS INT) AS year, CASE WHEN c_acctbal < 0 THEN 'retracted' ELSE 'active' END AS publication_status,
count(o_orderkey) AS curve_count, count(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS clean_curve_count FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL"""


def _index(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    g = rows.groupBy("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal").agg(F.count("o_orderkey").alias("curve_count"), F.count_if(F.col("o_orderstatus") == "F").alias("clean_curve_count"))
    return g.select(F.col("c_custkey").alias("paper_number"), F.concat(F.lit("p"), "c_custkey").alias("paper_id"), F.col("c_name").alias("title"), F.lit("").alias("doi"), F.lit("").alias("authors"), F.col("c_mktsegment").alias("journal"), (2000 + F.col("c_nationkey")).cast("int").alias("year"), F.when(F.col("c_acctbal") < 0, "retracted").otherwise("active").alias("publication_status"), "curve_count", "clean_curve_count")


@query("SELECT (SELECT count(*) FROM customer) AS papers, (SELECT count(*) FROM orders) AS curves, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS clean, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS flagged")
def api_stats(spark, sf_dir):
    s = F.col("o_orderstatus")
    o = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("curves"), F.count_if(s == "F").alias("clean"), F.count_if(s == "P").alias("flagged"))
    return table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("papers")).crossJoin(o)


@query(f"SELECT paper_id, title, year, curve_count FROM ({_INDEX}) WHERE title ILIKE '%1%' AND year BETWEEN 2003 AND 2018 AND clean_curve_count > 0 ORDER BY curve_count DESC NULLS LAST, paper_id LIMIT 50 OFFSET 25")
def api_papers(spark, sf_dir):
    return search.papers(_index(spark, sf_dir), q="1", year_min=2003, year_max=2018, include_readmitted="false", sort="-curves", limit=50, offset=25).rows.select("paper_id", "title", "year", "curve_count")


_CURVE_ROWS = """SELECT 's' || o_orderkey AS series_id, 'p' || o_custkey AS paper_id, o_orderpriority AS material, CASE WHEN o_orderkey % 9 > 0 THEN o_totalprice / 10000 END AS first_peak,
CASE o_orderstatus WHEN 'F' THEN 'clean' WHEN 'O' THEN 'axis_verified' ELSE 'shape_flagged' END AS admission, CASE WHEN o_orderkey % 4 = 0 THEN 'low_confidence' ELSE 'ok' END AS first_peak_status,
CASE WHEN o_orderkey % 5 = 0 THEN 'axis_arbitrated' ELSE 'axis_cross_validated' END AS axis_verification, CASE WHEN o_orderkey % 3 = 0 THEN 0.4 END AS uncertainty FROM orders"""


def _curves(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("s"), k).alias("series_id"),
        F.concat(F.lit("p"), "o_custkey").alias("paper_id"),
        F.concat(F.lit("f"), k).alias("figure_id"),
        F.col("o_orderpriority").alias("material"),
        F.when(k % 9 > 0, F.col("o_totalprice") / 10000).alias("first_peak"),
        F.when(F.col("o_orderstatus") == "F", "clean").when(F.col("o_orderstatus") == "O", "axis_verified").otherwise("shape_flagged").alias("admission"),
        F.when(k % 4 == 0, "low_confidence").otherwise("ok").alias("first_peak_status"),
        F.when(k % 5 == 0, "axis_arbitrated").otherwise("axis_cross_validated").alias("axis_verification"),
        F.when(k % 3 == 0, 0.4).alias("uncertainty"),
    )


@query(f"SELECT series_id, first_peak, admission FROM ({_CURVE_ROWS}) WHERE first_peak BETWEEN 3 AND 20 AND admission IN ('clean', 'shape_flagged') AND first_peak_status = 'ok' AND material ILIKE '%high%' ORDER BY first_peak DESC NULLS LAST, series_id LIMIT 100")
def api_curves(spark, sf_dir):
    return search.curves(_curves(spark, sf_dir), first_peak_min=3, first_peak_max=20, admission="clean,shape_flagged", first_peak_status="ok", material="high", sort="-first_peak").rows.select("series_id", "first_peak", "admission")


@query("WITH g AS (SELECT regexp_replace(lower(p_name), '[^a-z0-9@/]', '', 'g') AS key, count(*) AS curve_count, count(DISTINCT p_brand) AS paper_count FROM part GROUP BY 1) SELECT key, curve_count, paper_count FROM g WHERE contains(key, 'red') ORDER BY curve_count DESC, key LIMIT 100")
def api_materials(spark, sf_dir):
    g = groups.label_groups(table(spark, sf_dir, "part"), "p_name", "p_brand")
    return search.materials(g, q="red", specificity="all", sort="-curves").rows.select("key", "curve_count", "paper_count")


@query(f"SELECT paper_id, count(*) AS matches, count(*) FILTER (WHERE axis_verification = 'axis_arbitrated') AS disputed FROM ({_CURVE_ROWS}) WHERE abs(first_peak - 12.5::DOUBLE) <= greatest(0.15, coalesce(uncertainty, 0))::DOUBLE GROUP BY paper_id")
def api_browse_first_peak(spark, sf_dir):
    return search.first_peak_search(_curves(spark, sf_dir), 12.5, 0.15)


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS sort_order FROM orders WHERE o_custkey = 7")
def api_paper_detail(spark, sf_dir):
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "orders").where("o_custkey = 7")
    return rows.select("o_custkey", "o_orderkey", (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")) - 1).cast("long").alias("sort_order"))


@query("SELECT c_custkey, c_name, max(o_totalprice) AS bet_max, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_mktsegment ILIKE '%auto%' AND c_nationkey = 3 AND o_totalprice BETWEEN 100000 AND 300000 GROUP BY ALL")
def api_legacy_search(spark, sf_dir):
    """Parents by their own columns and a child filter: a parent without such a child goes."""
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").ilike("%auto%") & (F.col("c_nationkey") == 3))
    o = table(spark, sf_dir, "orders").where(F.col("o_totalprice").between(100000, 300000))
    return c.join(o, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_custkey", "c_name").agg(F.max("o_totalprice").alias("bet_max"), F.count(F.lit(1)).alias("n"))


_POINTS = "SELECT 's' || l_orderkey AS series_id, CAST(l_linenumber AS DOUBLE) AS two_theta_deg, CAST(l_quantity AS DOUBLE) AS relative_intensity FROM lineitem"


def _points(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(F.concat(F.lit("s"), "l_orderkey").alias("series_id"), F.col("l_linenumber").cast("double").alias("two_theta_deg"), F.col("l_quantity").cast("double").alias("relative_intensity"))


@query(f"""SELECT series_id, CAST(count(*) AS INT) AS point_count, list(two_theta_deg ORDER BY two_theta_deg, relative_intensity)::VARCHAR AS x, list(relative_intensity ORDER BY two_theta_deg, relative_intensity)::VARCHAR AS y,
(SELECT uncertainty FROM ({_CURVE_ROWS}) WHERE series_id = 's3') AS two_theta_uncertainty_deg FROM ({_POINTS}) WHERE series_id = 's3' GROUP BY series_id""")
def api_curve_data(spark, sf_dir):
    shown = lambda c: F.concat(F.lit("["), F.array_join(F.transform(c, lambda v: F.format_string("%.1f", v)), ", "), F.lit("]"))
    rows = search.curve_data(_curves(spark, sf_dir), _points(spark, sf_dir), series_id="s3")
    return rows.select("series_id", "point_count", shown("two_theta_deg").alias("x"), shown("relative_intensity").alias("y"), "two_theta_uncertainty_deg")


@query(f"""SELECT CAST(0 AS INT) AS n, 'two_theta_deg,relative_intensity' AS line UNION ALL
SELECT CAST(row_number() OVER (ORDER BY two_theta_deg, relative_intensity) AS INT), CAST(two_theta_deg AS VARCHAR) || ',' || CAST(relative_intensity AS VARCHAR) FROM ({_POINTS}) WHERE series_id = 's3'""")
def api_curve_data_csv(spark, sf_dir):
    return search.curve_data(_curves(spark, sf_dir), _points(spark, sf_dir), series_id="s3", format="csv")


@query("SELECT 'f7' AS figure_id, 'figures/7.csv.gz' AS data_path")
def api_figure_data(spark, sf_dir):
    rows = _curves(spark, sf_dir).withColumn("data_path", F.when(F.col("figure_id") != "f1", F.concat(F.lit("figures/"), F.substr("figure_id", F.lit(2)), F.lit(".csv.gz"))))
    return search.figure_data(rows, figure_id="f7")
