"""Scans, sinks and updates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ridgeline.functions import text
from ridgeline.operators import joins, validation
from ridgeline.plans.registry import query, table
from ridgeline.sources import files

_CELLS = "SELECT user_id, CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'bad' WHEN 2 THEN 'NaN' ELSE CAST(event_id AS VARCHAR) END AS x, CAST(CAST(floor(value) AS INT) AS VARCHAR) AS y FROM events"


def _cells(spark, sf_dir):
    n = F.col("event_id") % 7
    x = F.when(n == 0, "").when(n == 1, "bad").when(n == 2, "NaN").otherwise(F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("series_id"), x.alias("two_theta_deg"), F.floor("value").cast("int").cast("string").alias("relative_intensity"))


@query(f"SELECT CAST(user_id AS VARCHAR) AS series_id, count(*) AS n, min(v) AS lo FROM (SELECT user_id, TRY_CAST(nullif(nullif(x, 'NaN'), '') AS DOUBLE) AS v FROM ({_CELLS})) WHERE v IS NOT NULL GROUP BY user_id HAVING n >= 2")
def s2_csv_points(spark, sf_dir):
    return files.curve_points(_cells(spark, sf_dir)).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.min("two_theta_deg").alias("lo"))


@query(f"SELECT user_id, count(TRY_CAST(nullif(nullif(x, 'NaN'), '') AS DOUBLE)) AS n, count(*) AS rows FROM ({_CELLS}) GROUP BY user_id")
def s4_numeric_cells(spark, sf_dir):
    rows = _cells(spark, sf_dir).select(F.col("series_id").cast("long").alias("user_id"), files.number(F.col("two_theta_deg")).alias("v"))
    return rows.groupBy("user_id").agg(F.count("v").alias("n"), F.count(F.lit(1)).alias("rows"))


@query("SELECT l_orderkey, l_partkey FROM lineitem WHERE l_suppkey = 7")
def s7_projected_scan(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_suppkey = 7").select("l_orderkey", "l_partkey")


@query("SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 500 OFFSET 500")
def s8_paged_sweep(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey").orderBy("p_partkey").offset(500).limit(500)


@query("SELECT (SELECT count(*) FROM lineitem) AS points, (SELECT count(*) FROM orders) AS curves, (SELECT count(*) FROM customer) AS papers, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS clean")
def s11_export_manifest(spark, sf_dir):
    o = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("curves"), F.count_if(F.col("o_orderstatus") == "F").alias("clean"))
    return o.crossJoin(table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("points"))).crossJoin(table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("papers"))).select("points", "curves", "papers", "clean")


@query("SELECT p_partkey, CASE WHEN regexp_matches(c, '^[=+\\-@]') THEN '''' || c ELSE c END AS cell FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '=' WHEN 1 THEN '-' WHEN 2 THEN '@' ELSE '' END || p_name AS c FROM part)")
def s13_guarded_manifest(spark, sf_dir):
    n = F.col("p_partkey") % 4
    c = F.concat(F.when(n == 0, "=").when(n == 1, "-").when(n == 2, "@").otherwise(""), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", text.guarded_cell(c).alias("cell"))


@query("SELECT count(*) FILTER (WHERE c_custkey IS NULL) AS orphans, sum(n)::BIGINT = (SELECT count(*) FROM orders) AS sums_agree FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) LEFT JOIN customer ON o_custkey = c_custkey")
def s14_snapshot_gate(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    g = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    total = o.agg(F.count(F.lit(1)).alias("total"))
    return g.agg(F.count_if(F.col("c_custkey").isNull()).alias("orphans"), F.sum("n").alias("s")).crossJoin(total).select("orphans", (F.col("s") == F.col("total")).alias("sums_agree"))


def _old_new(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    old = o.where("o_orderkey % 3 < 2")
    new = o.where("o_orderkey % 3 > 0").select("o_orderkey", F.expr("nullif(o_orderstatus, 'O')").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return old, new


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN nullif(o_orderstatus, 'O') ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
CASE WHEN o_orderkey % 3 < 2 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def s15_upsert(spark, sf_dir):
    return joins.upsert(*_old_new(spark, sf_dir), "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders")
def s16_replace(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return joins.replace_rows(old.select("o_orderkey", "o_totalprice"), new.select("o_orderkey", "o_totalprice"), "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 AND o_orderstatus = 'F' THEN 'axis' ELSE o_orderstatus END AS status FROM orders")
def s17_guarded_update(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    values = o.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("axis").alias("new_value"))
    rows = o.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return joins.guarded_update(rows, values, "o_orderkey", "status", F.col("status") == "F")


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN nullif(c_mktsegment, 'BUILDING') END, c_name) AS label FROM customer")
def s18_coalesce_update(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    new = c.where("c_custkey % 2 = 0").select("c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("new"))
    return c.join(new, "c_custkey", "left").select("c_custkey", F.coalesce("new", "c_name").alias("label"))


@query("SELECT p_partkey, CAST(NULL AS DOUBLE) AS first_peak FROM part")
def s19_schema_evolution(spark, sf_dir):
    return files.evolve(files.evolve(table(spark, sf_dir, "part"), {"first_peak": "double"}), {"first_peak": "double", "p_partkey": "long"}).select("p_partkey", "first_peak")


@query("SELECT doc_id, source FROM documents WHERE doc_id % 2 = 0")
def s20_resumable_batch(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.join(d.where("doc_id % 2 = 1").select("doc_id"), "doc_id", "left_anti").select("doc_id", "source")


@query("SELECT p_partkey, sha256(p_name || chr(0) || p_type || chr(0) || CAST(p_size AS VARCHAR)) AS key FROM part")
def s21_cache_key(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", files.cache_key(F.col("p_name"), F.col("p_type"), F.col("p_size").cast("string")).alias("key"))


@query("SELECT CASE page_id % 4 WHEN 0 THEN 'publisher_derived' WHEN 1 THEN 'data' WHEN 2 THEN 'own_replot' ELSE 'unclassified' END AS class, count(*) AS n FROM pages GROUP BY 1")
def s22_object_walk(spark, sf_dir):
    n = F.col("page_id") % 4
    u = F.concat(F.lit("papers/"), "page_id", F.when(n == 0, "/page-3.png").when(n == 1, "/points.csv.gz").when(n == 2, "/digitized.webp").otherwise("/x.bin"))
    return table(spark, sf_dir, "pages").select(text.object_class(u).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


# --- declared invariants: rows that break them

_CURVES = """SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS in_clean_set, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 19 > 0 THEN 'clean' ELSE 'flagged' END AS admission, CASE WHEN o_orderkey % 17 = 0 THEN -1.0 ELSE o_totalprice / 600000 END AS fidelity,
CASE WHEN o_orderkey % 11 > 0 THEN o_totalprice / 2000 END AS two_theta, CASE WHEN o_orderkey % 11 > 0 THEN 5.0 END AS d, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey % 40 / 10.0 END AS fwhm, CASE WHEN o_orderkey % 13 > 0 THEN 0.35 + o_orderkey % 30 / 10.0 END AS wavelength,
CASE WHEN o_orderkey % 11 > 0 THEN 'paper' END AS source, CASE o_orderkey % 7 WHEN 0 THEN 'no_bragg_peak' WHEN 1 THEN 'truncated_at_window_start' ELSE 'ok' END AS status, o_orderkey % 23 / 20.0 AS crystalline_fraction,
CASE WHEN o_orderkey % 3 = 0 THEN 14.0 + o_orderkey % 23 END AS hump_center, CASE WHEN o_orderkey % 3 = 0 THEN 2.0 END AS hump_fwhm, CASE o_orderkey % 4 WHEN 0 THEN 'hump_detected' WHEN 1 THEN 'not_computed' WHEN 2 THEN 'no_hump_detected' END AS hump_status,
o_orderkey % 9 AS two_theta_min, o_orderkey % 7 + 3 AS two_theta_max FROM orders"""

#: Each rule as SQL, with the rows that it holds for; an unknown result passes.
_RULES = {
    "c4": "in_clean_set = (admission = 'clean')",
    "c5": "fidelity BETWEEN 0 AND 1",
    "c6_two_theta": "two_theta > 0 AND two_theta < 180",
    "c6_fwhm": "fwhm BETWEEN 0.05 AND 3",
    "c6_wavelength": "wavelength > 0.4 AND wavelength < 3",
    "c7_together": "(two_theta IS NULL) = (d IS NULL) AND (two_theta IS NULL) = (fwhm IS NULL) AND (two_theta IS NULL) = (wavelength IS NULL) AND (two_theta IS NULL) = (source IS NULL)",
    "c7_absent": "NOT (status IN ('truncated_at_window_start', 'no_bragg_peak') AND two_theta IS NOT NULL)",
    "c8_fraction": "crystalline_fraction BETWEEN 0 AND 1",
    "c8_center": "hump_center BETWEEN 15 AND 35",
    "c9_geometry": "hump_status IS NOT DISTINCT FROM 'hump_detected' OR (hump_center IS NULL AND hump_fwhm IS NULL)",
    "c9_computed": "NOT (hump_status IS NOT DISTINCT FROM 'not_computed' AND crystalline_fraction IS NOT NULL)",
    "c10": "two_theta_min <= two_theta_max",
}


def _curves(spark, sf_dir):
    k = F.col("o_orderkey")
    here = k % 11 > 0
    return table(spark, sf_dir, "orders").select(
        k.alias("k"),
        (k % 2 == 0).alias("in_clean_set"),
        F.when((k % 2 == 0) & (k % 19 > 0), "clean").otherwise("flagged").alias("admission"),
        F.when(k % 17 == 0, -1.0).otherwise(F.col("o_totalprice") / 600000).alias("fidelity"),
        F.when(here, F.col("o_totalprice") / 2000).alias("two_theta"),
        F.when(here, 5.0).alias("d"),
        F.when(here, k % 40 / 10.0).alias("fwhm"),
        F.when(k % 13 > 0, 0.35 + k % 30 / 10.0).alias("wavelength"),
        F.when(here, "paper").alias("source"),
        F.when(k % 7 == 0, "no_bragg_peak").when(k % 7 == 1, "truncated_at_window_start").otherwise("ok").alias("status"),
        (k % 23 / 20.0).alias("crystalline_fraction"),
        F.when(k % 3 == 0, 14.0 + k % 23).alias("hump_center"),
        F.when(k % 3 == 0, 2.0).alias("hump_fwhm"),
        F.when(k % 4 == 0, "hump_detected").when(k % 4 == 1, "not_computed").when(k % 4 == 2, "no_hump_detected").alias("hump_status"),
        (k % 9).alias("two_theta_min"),
        (k % 7 + 3).alias("two_theta_max"),
    )


@query(" UNION ALL ".join(f"SELECT '{name}' AS rule, k AS id FROM ({_CURVES}) WHERE NOT coalesce({rule}, true)" for name, rule in _RULES.items()))
def c_row_invariants(spark, sf_dir):
    return validation.violations(_curves(spark, sf_dir), "k", validation.curve_rules()).select("rule", F.col("key").alias("id"))


@query("SELECT 'c1' AS rule, c_custkey AS id FROM customer WHERE (c_acctbal < 0) <> (c_custkey % 3 = 0)")
def c1_paper_invariants(spark, sf_dir):
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k, F.when(F.col("c_acctbal") < 0, "unchecked").otherwise("active").alias("status"), F.when(k % 3 > 0, "2024-01-01").alias("checked_at"))
    return validation.violations(rows, "c_custkey", validation.paper_rules()).select("rule", F.col("key").alias("id"))


@query("""WITH f AS (SELECT p_partkey AS k, p_size - 3 AS page, CASE WHEN p_partkey % 5 > 0 THEN p_retailprice - 1000 END AS rmse, p_partkey % 4 - 1 AS n FROM part)
SELECT 'c2_page' AS rule, k AS id FROM f WHERE NOT coalesce(page > 0, true) UNION ALL SELECT 'c2_rmse', k FROM f WHERE NOT coalesce(rmse >= 0, true) UNION ALL SELECT 'c2_points', k FROM f WHERE NOT coalesce(n >= 0, true)""")
def c2_figure_invariants(spark, sf_dir):
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(k, (F.col("p_size") - 3).alias("page"), F.when(k % 5 > 0, F.col("p_retailprice") - 1000).alias("rmse"), (k % 4 - 1).alias("n_points"))
    return validation.violations(rows, "p_partkey", validation.figure_rules()).select("rule", F.col("key").alias("id"))


@query("""WITH g AS (SELECT p_brand AS k, count(*) - 40 AS curve_count, count(DISTINCT p_type) AS paper_count, count(DISTINCT CASE WHEN p_size > 49 THEN p_name END) AS variants FROM part GROUP BY p_brand)
SELECT 'c3_counts' AS rule, k AS id FROM g WHERE curve_count < paper_count UNION ALL SELECT 'c3_variants', k FROM g WHERE variants < 1""")
def c3_group_invariants(spark, sf_dir):
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg((F.count(F.lit(1)) - 40).alias("curve_count"), F.count_distinct("p_type").alias("paper_count"), F.collect_set(F.when(F.col("p_size") > 49, F.col("p_name"))).alias("label_variants"))
    return validation.violations(rows, "p_brand", validation.group_rules()).select("rule", F.col("key").alias("id"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def c11_foreign_keys(spark, sf_dir):
    return validation.orphans(table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer").where("c_acctbal > 0"), "c_custkey").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING n > 1")
def c12_unique_keys(spark, sf_dir):
    return validation.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders WHERE (o_orderstatus, o_orderpriority) NOT IN (('F', '1-URGENT'), ('O', '2-HIGH')) GROUP BY ALL")
def c13_unmapped_pairs(spark, sf_dir):
    known = spark.createDataFrame([("F", "1-URGENT"), ("O", "2-HIGH")], "o_orderstatus string, o_orderpriority string")
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(known), ["o_orderstatus", "o_orderpriority"], "left_anti")


@query("SELECT conv_id, turn, n FROM (SELECT conv_id, turn, length(text) // 100 AS n, lag(length(text) // 100) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p IS NULL OR p <> n")
def r2_progress_changes(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.floor(F.length("text") / 100).cast("long").alias("n"))
    return rows.withColumn("p", F.lag("n").over(w)).where("p is null or p <> n").select("conv_id", "turn", "n")
