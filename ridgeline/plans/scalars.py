"""Projections, mappings and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.functions import physics, text
from ridgeline.functions import vocabulary as V
from ridgeline.operators import mapping
from ridgeline.plans.registry import query, table


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def f1_pruned_projection(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("""SELECT c_custkey, count(o_orderkey) AS n_orders, min(o_orderkey) AS first_order, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS best_final
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def f2_nested_children(spark, sf_dir):
    """Orders nested under customers, then read back from the nested rows."""
    child = F.when(F.col("o_orderkey").isNotNull(), F.struct("o_orderkey", "o_orderstatus", "o_totalprice"))
    nested = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.array_sort(F.collect_list(child)).alias("orders"))
    final = F.transform(F.filter("orders", lambda o: o["o_orderstatus"] == "F"), lambda o: o["o_totalprice"])
    return nested.select("c_custkey", F.size("orders").cast("long").alias("n_orders"), F.get("orders", F.lit(0))["o_orderkey"].alias("first_order"), F.array_max(final).alias("best_final"))


@query("SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'N') AND l_quantity >= 10 AND l_quantity <= 20 AND nullif(l_discount, 0.05) < 0.07")
def f3_equality_subset_range(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F' AND l_returnflag IN ('A', 'N') AND l_quantity >= 10 AND l_quantity <= 20 AND nullif(l_discount, 0.05D) < 0.07D")
    return rows.select("l_orderkey", "l_quantity", "l_returnflag")


@query("SELECT doc_id, source FROM documents WHERE text ILIKE '%the _n%' OR source ILIKE '%rc1%'")
def f4_contains_search(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.where(F.col("text").ilike(text.like_pattern("the _n")) | F.col("source").ilike(text.like_pattern("*rc1%"))).select("doc_id", "source")


@query("SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS clean FROM orders GROUP BY o_custkey HAVING clean > 0")
def f5_flag_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("clean")).where("clean > 0")


@query("SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'O') IS NULL OR o_orderstatus = 'P'")
def f6_null_or_sentinel(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("nullif(o_orderstatus, 'O') IS NULL OR o_orderstatus = 'P'").select("o_orderkey")


@query("""SELECT l_orderkey, CASE WHEN r <= 1 THEN 'low' WHEN r > 1 AND r <= 10 THEN 'middle' WHEN r > 10 THEN 'high' END AS band FROM
(SELECT l_orderkey, l_quantity / nullif(l_linenumber, 3) AS r FROM lineitem) WHERE r IS NOT NULL""")
def f7_ratio_bands(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_quantity") / F.expr("nullif(l_linenumber, 3)")).alias("r"))
    return rows.where("r is not null").select("l_orderkey", mapping.ratio_band(F.col("r")).alias("band"))


@query("""SELECT DISTINCT c_custkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE lower(c_name) LIKE '%1%' AND c_mktsegment IN ('BUILDING', 'AUTOMOBILE')
GROUP BY c_custkey HAVING count(*) >= 5 AND bool_or(o_orderstatus = 'F')""")
def f9_facet_conjunction(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    facets = rows.groupBy("c_custkey").agg(F.first("c_name").alias("name"), F.first("c_mktsegment").alias("segment"), F.collect_set("o_orderstatus").alias("roles"), F.count(F.lit(1)).alias("n"))
    return facets.where(F.contains(F.lower("name"), F.lit("1")) & F.col("segment").isin("BUILDING", "AUTOMOBILE") & (F.col("n") >= 5) & F.array_contains("roles", "F")).select("c_custkey")


_CLASSES = "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 15 THEN 'clean' WHEN l_quantity < 25 THEN 'axis_verified' WHEN l_quantity < 48 THEN 'excluded' ELSE 'new' END AS kind, CASE WHEN l_quantity >= 25 THEN CASE CAST(l_quantity AS INT) % 5 WHEN 0 THEN 'own_shape_flag' WHEN 1 THEN 'axis_arbitrated' WHEN 2 THEN 'model_derived' WHEN 3 THEN 'unknown' END END AS reason FROM lineitem"
_ADMISSION = "CASE " + " ".join(f"WHEN kind = '{k}' AND " + ("coalesce(trim(reason), '') = ''" if r is None else f"reason = '{r}'") + f" THEN '{c}'" for (k, r), c in V.ADMISSION) + " END"


def _classes(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("ridgeline_lineitem")
    return spark.sql(_CLASSES.replace("FROM lineitem", "FROM ridgeline_lineitem"))


@query(f"SELECT l_orderkey, l_linenumber, kind, reason, {_ADMISSION} AS admission FROM ({_CLASSES})")
def f10_admission_class(spark, sf_dir):
    return _classes(spark, sf_dir).withColumn("admission", mapping.admission(F.col("kind"), F.col("reason")))


@query(f"SELECT l_orderkey, l_linenumber, {_ADMISSION} AS admission FROM ({_CLASSES}) WHERE {_ADMISSION} IS NOT NULL")
def f11_published(spark, sf_dir):
    return _classes(spark, sf_dir).select("l_orderkey", "l_linenumber", mapping.admission(F.col("kind"), F.col("reason")).alias("admission")).where("admission is not null")


_STATUS = "CASE o_orderpriority WHEN '1-URGENT' THEN ' Consensus' WHEN '2-HIGH' THEN 'single_method' WHEN '3-MEDIUM' THEN 'arbitrated' WHEN '5-LOW' THEN 'failed' END"
_VERIFIED = "CASE lower(trim(s)) WHEN 'consensus' THEN 'axis_cross_validated' WHEN 'single_method' THEN 'axis_single_method' WHEN 'arbitrated' THEN 'axis_arbitrated' ELSE 'axis_unverified' END"


@query(f"SELECT o_orderkey, {_VERIFIED} AS verification FROM (SELECT o_orderkey, {_STATUS} AS s FROM orders)")
def f12_verification_status(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", mapping.verification(F.expr(_STATUS)).alias("verification"))


@query(f"""SELECT o_orderkey, CASE WHEN v = 'axis_arbitrated' OR f = 'partial' THEN 'flagged' ELSE 'pending' END AS quality, concat_ws(';', CASE WHEN v = 'axis_arbitrated' THEN v END, CASE WHEN f = 'partial' THEN 'series_incomplete' END) AS reasons
FROM (SELECT o_orderkey, {_VERIFIED} AS v, f FROM (SELECT o_orderkey, {_STATUS} AS s, CASE WHEN o_orderstatus = 'P' THEN 'partial' END AS f FROM orders))""")
def f13_quality_reasons(spark, sf_dir):
    status, why = mapping.quality(F.when(F.col("o_orderstatus") == "P", " Partial "), mapping.verification(F.expr(_STATUS)))
    return table(spark, sf_dir, "orders").select("o_orderkey", status.alias("quality"), F.array_join(why, ";").alias("reasons"))


_HUMP = "CASE WHEN l_quantity IS NULL THEN NULL WHEN l_quantity < 10 THEN 'not_computed' WHEN l_discount > 0.08 THEN 'window_not_covered' WHEN l_tax > 0.04 THEN 'hump_detected' ELSE 'no_hump_detected' END"


@query(f"SELECT l_orderkey, l_linenumber, {_HUMP} AS status FROM (SELECT * REPLACE (nullif(l_quantity, 25) AS l_quantity) FROM lineitem)")
def f14_hump_status(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.expr("nullif(l_quantity, 25D)"))
    return rows.select("l_orderkey", "l_linenumber", mapping.hump_status(F.col("l_quantity"), F.col("l_quantity") >= 10, F.col("l_discount") <= 0.08, F.col("l_tax") > 0.04).alias("status"))


@query(f"SELECT l_orderkey, s AS status, CASE WHEN s = 'hump_detected' THEN l_extendedprice END AS centre FROM (SELECT *, {_HUMP} AS s FROM lineitem)")
def f15_descriptor_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("status", mapping.hump_status(F.col("l_quantity"), F.col("l_quantity") >= 10, F.col("l_discount") <= 0.08, F.col("l_tax") > 0.04))
    return rows.select("l_orderkey", "status", F.when(F.col("status") == "hump_detected", F.col("l_extendedprice")).alias("centre"))


@query("""SELECT l_orderkey, CASE WHEN assumed = 0 AND reported IS NOT NULL THEN reported ELSE 1.5406 END AS wavelength, CASE WHEN assumed = 0 AND reported IS NOT NULL THEN 'paper_reported' ELSE 'assumed_cu_ka' END AS source,
CASE WHEN assumed = 1 AND reported IS NOT NULL THEN 'stale_paper_wavelength' WHEN assumed = 1 OR (assumed = 0 AND reported IS NOT NULL) THEN NULL ELSE 'unverifiable_wavelength' END AS anomaly
FROM (SELECT l_orderkey, CASE WHEN l_linenumber = 1 THEN 1 WHEN l_linenumber < 5 THEN 0 END AS assumed, CASE WHEN l_quantity > 0.4 AND l_quantity < 3.0 THEN l_quantity END AS reported FROM lineitem)""")
def f16_wavelength_source(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.expr("CASE WHEN l_linenumber = 1 THEN 1 WHEN l_linenumber < 5 THEN 0 END").alias("assumed"), F.when((F.col("l_quantity") > 0.4) & (F.col("l_quantity") < 3.0), F.col("l_quantity")).alias("reported"))
    return rows.select("l_orderkey", mapping.wavelength(F.col("assumed"), F.col("reported")).alias("w")).select("l_orderkey", "w.*")


@query("""SELECT event_id, CASE WHEN k BETWEEN 10 AND 60 THEN k END AS bounded, CASE WHEN k + 1790 BETWEEN 1800 AND 2200 THEN k + 1790 END AS year, CASE WHEN lower(trim(event_type)) IN ('click', 'view') THEN lower(trim(event_type)) END AS kind
FROM (SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def f17_bounded_coercion(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return rows.select("event_id", mapping.bounded(F.col("k"), "int", 10, 60).alias("bounded"), mapping.bounded(F.col("k").try_cast("int") + 1790, "int", 1800, 2200).alias("year"), mapping.one_of(F.col("event_type"), ["click", "view"]).alias("kind"))


_ROLE_ROWS = "SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'reference' WHEN 1 THEN 'odd' END AS context, CASE p_partkey % 5 WHEN 0 THEN ' Exp' WHEN 1 THEN 'measured' END AS state, p_name || CASE p_partkey % 6 WHEN 0 THEN ' Simulated' WHEN 1 THEN ' Pawley refined' WHEN 2 THEN ' difference' WHEN 3 THEN ' JCPDS' ELSE '' END AS label FROM part"


@query("SELECT p_partkey, CASE WHEN context IN (" + ", ".join(f"'{r}'" for r in V.ROLES) + ") THEN context WHEN lower(trim(state)) IN (" + ", ".join(f"'{r}'" for r in V.EXPERIMENTAL_STATES) + ") THEN 'experimental' " + " ".join("WHEN " + " OR ".join(f"contains(lower(label), '{m}')" for m in marks) + f" THEN '{r}'" for r, marks in V.ROLE_MARKS) + f" ELSE 'unclassified' END AS role FROM ({_ROLE_ROWS})")
def f18_role(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("ridgeline_part")
    return spark.sql(_ROLE_ROWS.replace("FROM part", "FROM ridgeline_part")).select("p_partkey", mapping.role(F.col("context"), F.col("label"), F.col("state")).alias("role"))


_STATE_ROWS = "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Simulated AA' WHEN 1 THEN 'as-prepared' WHEN 2 THEN ' calc ' WHEN 3 THEN 'calcined' ELSE '' END AS state, p_name || CASE p_partkey % 5 WHEN 0 THEN ' (sim)' WHEN 1 THEN ' AB stacking' ELSE '' END AS label FROM part"


@query("SELECT p_partkey, CASE WHEN trim(state) <> '' THEN trim(lower(state)) IN (" + ", ".join(f"'{m}'" for m in V.COMPUTED_WHOLE) + ") OR " + " OR ".join(f"contains(lower(state), '{m}')" for m in V.COMPUTED_STATE) + " ELSE " + " OR ".join(f"contains(lower(label), '{m}')" for m in V.COMPUTED_LABEL) + f" END AS computed FROM ({_STATE_ROWS})")
def f19_computed_classifier(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("ridgeline_part")
    return spark.sql(_STATE_ROWS.replace("FROM part", "FROM ridgeline_part")).select("p_partkey", mapping.computed(F.col("state"), F.col("label")).alias("computed"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_discount <= 0.08 AND NOT bool_or(l_discount > 0.08) OVER (PARTITION BY l_orderkey) AND l_quantity < 45 AS clean FROM lineitem")
def f20_clean_flag(spark, sf_dir):
    from pyspark.sql import Window

    flagged = F.col("l_discount") > 0.08
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", (~flagged & ~F.bool_or(flagged).over(Window.partitionBy("l_orderkey")) & (F.col("l_quantity") < 45)).alias("clean"))


@query("SELECT p_partkey, CASE WHEN lo <= hi OR lo IS NULL OR hi IS NULL THEN lo END AS lo, CASE WHEN lo <= hi OR lo IS NULL OR hi IS NULL THEN hi END AS hi FROM (SELECT p_partkey, nullif(p_size, 7) AS lo, p_partkey % 50 AS hi FROM part)")
def f21_reversed_bounds(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr("nullif(p_size, 7)").alias("lo"), (F.col("p_partkey") % 50).alias("hi"))
    wrong = F.coalesce(F.col("lo") > F.col("hi"), F.lit(False))
    return rows.select("p_partkey", F.when(~wrong, F.col("lo")).alias("lo"), F.when(~wrong, F.col("hi")).alias("hi"))


@query("SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'Series ' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)) AS label FROM orders")
def f22_default_label(spark, sf_dir):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.expr("nullif(o_orderpriority, '5-LOW')"), F.concat(F.lit("Series "), n)).alias("label"))


@query("SELECT o_orderkey, mark, shown FROM orders JOIN (VALUES ('F', 'retracted', true), ('P', 'corrected', true), ('O', 'active', false)) AS m(s, mark, shown) ON o_orderstatus = s")
def f23_lifecycle_marks(spark, sf_dir):
    marks = spark.createDataFrame([("F", "retracted", True), ("P", "corrected", True), ("O", "active", False)], "s string, mark string, shown boolean")
    return table(spark, sf_dir, "orders").join(F.broadcast(marks), F.col("o_orderstatus") == F.col("s")).select("o_orderkey", "mark", "shown")


@query("SELECT p_partkey, a * 0 + b >= -5 AND a * 900 + b <= 130 AND a * 900 BETWEEN 1.5 AND 135 AS plausible FROM (SELECT p_partkey, p_size / 250.0 AS a, CAST(p_partkey % 20 - 8 AS DOUBLE) AS b FROM part)")
def f24_fit_plausibility(spark, sf_dir):
    a, b = F.col("p_size") / 250.0, (F.col("p_partkey") % 20 - 8).cast("double")
    return table(spark, sf_dir, "part").select("p_partkey", mapping.plausible_fit(a, b, F.lit(0.0), F.lit(900.0)).alias("plausible"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity, concat_ws(';', CASE WHEN coalesce(p, 1.0) < 0.80 THEN 'precision' END, CASE WHEN coalesce(s, 1.0) < 0.80 THEN 'snap' END, CASE WHEN coalesce(r, 1.0) < 0.70 THEN 'recall' END, CASE WHEN coalesce(d, 0) > 15 THEN 'residual' END) AS reasons
FROM (SELECT *, nullif(1.0 - l_discount * 3, 1.0) AS p, 1.0 - l_tax * 3 AS s, 1.0 - l_quantity / 100.0 AS r, nullif(l_quantity, 20) / 2 AS d FROM lineitem)""")
def f25_evidence_gates(spark, sf_dir):
    q = F.col("l_quantity")
    why = mapping.evidence_reasons(F.expr("nullif(1.0D - l_discount * 3, 1.0D)"), 1.0 - F.col("l_tax") * 3, 1.0 - q / 100.0, F.expr("nullif(l_quantity, 20D)") / 2)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.array_join(why, ";").alias("reasons"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity, s >= 0.55 AND p >= 0.70 AND r >= 0.60 AND c >= 0.55 AS accepted, floor(c * 10000 + 0.5) / 10000 AS confidence FROM
(SELECT *, 0.30 * s + 0.30 * p + 0.25 * r + 0.15 * greatest(0.0, 1.0 - d / 0.25) AS c FROM (SELECT *, 1.0 - l_tax * 3 AS s, 1.0 - l_discount * 3 AS p, 1.0 - l_quantity / 100.0 AS r, l_tax * 2 AS d FROM lineitem))""")
def f26_acceptance_gate(spark, sf_dir):
    s, p, r, d = 1.0 - F.col("l_tax") * 3, 1.0 - F.col("l_discount") * 3, 1.0 - F.col("l_quantity") / 100.0, F.col("l_tax") * 2
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", mapping.acceptance(s, p, r, d).alias("g")).select("l_orderkey", "l_linenumber", "l_quantity", "g.*")


@query("""SELECT o_custkey, CASE WHEN a = n THEN 'accepted' WHEN a > 0 THEN 'partial' ELSE 'rejected' END AS decision, m AS best FROM
(SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS a, max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS m FROM orders GROUP BY o_custkey)""")
def f27_figure_decision(spark, sf_dir):
    ok = F.col("o_orderstatus") == "F"
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("a"), F.max(F.when(ok, F.col("o_totalprice"))).alias("best"))
    return rows.select("o_custkey", F.when(F.col("a") == F.col("n"), "accepted").when(F.col("a") > 0, "partial").otherwise("rejected").alias("decision"), "best")


@query("SELECT l_orderkey, l_linenumber, l_quantity, least(greatest(l_quantity / 50 + least(0.15, 0.03 * l_linenumber) - 0.1 * (l_linenumber % 3), 0.0), 1.0) AS reliability FROM lineitem")
def f28_reliability(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", physics.reliability(F.col("l_quantity") / 50, F.col("l_linenumber"), F.col("l_linenumber") % 3).alias("reliability"))


@query("""SELECT o_custkey, o_orderkey, passes FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY passes DESC, CASE WHEN passes THEN o_orderkey END, score DESC, o_orderkey) AS k FROM
(SELECT o_custkey, o_orderkey, o_totalprice AS score, o_orderstatus = 'P' AS passes FROM orders)) WHERE k = 1""")
def f29_first_passing_rung(spark, sf_dir):
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("score"), (F.col("o_orderstatus") == "P").alias("passes"))
    order = Window.partitionBy("o_custkey").orderBy(F.desc("passes"), F.when(F.col("passes"), F.col("o_orderkey")), F.desc("score"), "o_orderkey")
    return rows.withColumn("k", F.row_number().over(order)).where("k = 1").select("o_custkey", "o_orderkey", "passes")
