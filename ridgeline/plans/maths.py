"""Math and array functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ridgeline.functions import physics
from ridgeline.operators import calibration
from ridgeline.plans.registry import query, table


@query("SELECT event_id, round(CASE WHEN x > 0 AND x < 180 THEN 1.5406 / (2 * sin(radians(x / 2))) END, 9) AS d FROM (SELECT event_id, value - 10 AS x FROM events)")
def m1_d_spacing(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(physics.d_spacing(F.col("value") - 10), 9).alias("d"))


@query("SELECT event_id, round(CASE WHEN d > 0 AND 1.5406 / (2 * d) <= 1 THEN 2 * degrees(asin(1.5406 / (2 * d))) END, 9) AS x FROM (SELECT event_id, nullif(value / 100, 0) AS d FROM events)")
def m2_two_theta(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(physics.two_theta(F.col("value") / 100), 9).alias("x"))


@query("SELECT p_partkey, greatest(least(greatest(p_size / 40.0::DOUBLE, 0.02), 1.0), coalesce(nullif(p_size, 7) / 30.0::DOUBLE, 0)) AS tol FROM part")
def m4_tolerance(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", physics.tolerance(F.col("p_size") / 40.0, F.expr("nullif(p_size, 7)") / 30.0).alias("tol"))


@query("SELECT event_id, CASE WHEN m > 0 THEN value / m * 100 ELSE 0 END AS y FROM (SELECT event_id, value, max(value) OVER (PARTITION BY user_id) AS m FROM events)")
def m5_max_normalise(spark, sf_dir):
    m = F.max("value").over(Window.partitionBy("user_id"))
    return table(spark, sf_dir, "events").select("event_id", F.when(m > 0, F.col("value") / m * 100).otherwise(0.0).alias("y"))


@query("SELECT event_id, coalesce((value - a) / nullif(b - a, 0), 0) AS y FROM (SELECT event_id, value, min(value) OVER (PARTITION BY user_id) AS a, max(value) OVER (PARTITION BY user_id) AS b FROM events)")
def m6_min_max_normalise(spark, sf_dir):
    w = Window.partitionBy("user_id")
    a, b = F.min("value").over(w), F.max("value").over(w)
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(F.try_divide(F.col("value") - a, b - a), F.lit(0.0)).alias("y"))


@query("SELECT event_id, round(least(greatest((value - a) / nullif(b - a, 0), 0), 1.3), 9) AS y FROM events JOIN (SELECT user_id, quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.995) AS b FROM events GROUP BY user_id) USING (user_id)")
def m7_percentile_normalise(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    q = e.groupBy("user_id").agg(F.percentile("value", 0.05).alias("a"), F.percentile("value", 0.995).alias("b"))
    y = F.try_divide(F.col("value") - F.col("a"), F.col("b") - F.col("a"))
    return e.join(q, "user_id").select("event_id", F.round(F.when(y.isNotNull(), F.least(F.greatest(y, F.lit(0.0)), F.lit(1.3))), 9).alias("y"))


@query("""WITH g AS (SELECT vec_id, i, 2.13::DOUBLE + 1.37::DOUBLE * i AS x, embedding AS e FROM embeddings, range(20) r(i)), p AS (SELECT *, CAST(floor((x - 2.0::DOUBLE) / 0.5::DOUBLE) AS INT) AS k FROM g)
SELECT vec_id, i AS place, round(CAST(e[k + 1] AS DOUBLE) + (CAST(e[k + 2] AS DOUBLE) - CAST(e[k + 1] AS DOUBLE)) * ((x - (2.0::DOUBLE + 0.5::DOUBLE * k)) / 0.5::DOUBLE), 9) AS y FROM p""")
def m8_interpolation(spark, sf_dir):
    grid = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.lit(2.13) + F.lit(1.37) * i)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(calibration.interpolated(F.col("embedding"), 2.0, 0.5, grid)).alias("place", "y"))
    return rows.select("vec_id", F.col("place").cast("long").alias("place"), F.round("y", 9).alias("y"))


@query("SELECT user_id, round(regr_slope(value, CAST(event_id AS DOUBLE)), 9) AS slope, round(regr_intercept(value, CAST(event_id AS DOUBLE)), 5) AS intercept FROM events GROUP BY user_id")
def m9_line_fit(spark, sf_dir):
    x = F.col("event_id").cast("double")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(F.regr_slope("value", x), 9).alias("slope"), F.round(F.regr_intercept("value", x), 5).alias("intercept"))


@query()
def m9_robust_line_fit(spark, sf_dir):
    return calibration.fit_lines(table(spark, sf_dir, "events").select("user_id", F.col("event_id").cast("double").alias("px"), "value"), "user_id", "px", "value")


@query("""WITH p AS (SELECT o_custkey, CAST(o_orderkey AS DOUBLE) AS x, CAST(o_totalprice AS DOUBLE) AS y, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
t AS (SELECT o_custkey, n, (t * 7919 + 13) % n + 1 AS a, ((t * 7919 + 13) % n + 1 + (t * 104729 + 7) % (n - 1)) % n + 1 AS b FROM (SELECT DISTINCT o_custkey, n FROM p WHERE n > 12), range(64) r(t)),
k AS (SELECT o_custkey, a.i AS a, b.i AS b FROM p a JOIN p b USING (o_custkey) WHERE a.i < b.i AND a.n <= 12 UNION SELECT o_custkey, least(a, b), greatest(a, b) FROM t),
l AS (SELECT k.o_custkey, k.a AS i, k.b AS j, (b.y - a.y) / (b.x - a.x) AS m, a.y - (b.y - a.y) / (b.x - a.x) * a.x AS c FROM k JOIN p a ON a.o_custkey = k.o_custkey AND a.i = k.a JOIN p b ON b.o_custkey = k.o_custkey AND b.i = k.b),
s AS (SELECT l.o_custkey, l.i, l.j, count(*) AS n FROM l JOIN p q ON q.o_custkey = l.o_custkey WHERE q.i = l.i OR q.i = l.j OR abs(q.y - (m * q.x + c)) <= 20000 GROUP BY ALL)
SELECT o_custkey, max(n) AS inliers FROM s GROUP BY o_custkey""")
def m10_ransac_inliers(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    p = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").cast("double").alias("x"), F.col("o_totalprice").cast("double").alias("y"), F.row_number().over(w).alias("i"))
    pts = p.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("p")).where(F.size("p") >= 2)
    return pts.select("o_custkey", calibration.best_inliers(F.col("p"), 20000.0).alias("inliers"))


@query("SELECT p_partkey, greatest(abs((a - 2) * 0 + b - 1), abs((a - 2) * 90 + b - 1)) AS gap FROM (SELECT p_partkey, p_size / 10.0::DOUBLE AS a, CAST(p_partkey % 9 AS DOUBLE) AS b FROM part)")
def m11_line_disagreement(spark, sf_dir):
    a, b = F.col("p_size") / 10.0, (F.col("p_partkey") % 9).cast("double")
    return table(spark, sf_dir, "part").select("p_partkey", physics.line_gap((a, b), (F.lit(2.0), F.lit(1.0)), F.lit(0.0), F.lit(90.0)).alias("gap"))


@query("SELECT p_partkey, p_size % 4 <> 1 AND (p_size % 4 <> 2 OR true) AS arithmetic FROM part")
def m12_arithmetic_sequence(spark, sf_dir):
    n = F.col("p_size") % 4
    values = F.when(n == 1, F.array(*map(F.lit, (1.0, 2.0, 4.0)))).when(n == 2, F.array(*map(F.lit, (10.0, 20.0, 30.5, 40.2)))).otherwise(F.array(*map(F.lit, (5.0, 10.0, 15.0))))
    return table(spark, sf_dir, "part").select("p_partkey", physics.arithmetic(values).alias("arithmetic"))


@query()
def m13_tick_pairing(spark, sf_dir):
    rows = table(spark, sf_dir, "part")
    ticks = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: (F.col("p_size") + i * 40).cast("double"))
    labels = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: (10 + i * 10).cast("double"))
    return calibration.pair_ticks(rows.select("p_partkey", ticks.alias("ticks"), labels.alias("labels")), "p_partkey")


@query("""SELECT p_partkey, CASE WHEN a IS NULL AND b IS NULL THEN 'failed' WHEN a IS NOT NULL AND b IS NOT NULL AND abs(a - b) <= 0.5 THEN 'consensus' WHEN a IS NOT NULL AND b IS NOT NULL THEN 'disagreement' WHEN n >= 3 AND rmse <= 0.15 THEN 'single_method' ELSE 'weak' END AS status
FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN p_size / 10.0::DOUBLE END AS a, CASE WHEN p_partkey % 4 > 0 THEN p_size / 10.0::DOUBLE + (p_partkey % 2) END AS b, p_partkey % 5 AS n, (p_partkey % 30) / 100.0::DOUBLE AS rmse FROM part)""")
def m14_consensus(spark, sf_dir):
    k = F.col("p_partkey")
    a, b = F.when(k % 3 > 0, F.col("p_size") / 10.0), F.when(k % 4 > 0, F.col("p_size") / 10.0 + k % 2)
    return table(spark, sf_dir, "part").select("p_partkey", calibration.consensus(a, b, k % 5, (k % 30) / 100.0).alias("status"))


@query("SELECT p_partkey, round(greatest(5.0 - 1.25 * g, f0, 0.2), 9) AS lo, round(least(5.0 + 4 * g + 1.25 * g, f1, 130.0), 9) AS hi FROM (SELECT p_partkey, p_size / 10.0::DOUBLE AS g, p_partkey % 7 - 1.0::DOUBLE AS f0, 20.0::DOUBLE + p_partkey % 11 AS f1 FROM part)")
def m15_output_window(spark, sf_dir):
    g = F.col("p_size") / 10.0
    ticks = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.lit(5.0) + g * i)
    lo, hi = calibration.output_window(ticks, F.col("p_partkey") % 7 - F.lit(1.0), F.lit(20.0) + F.col("p_partkey") % 11)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(lo, 9).alias("lo"), F.round(hi, 9).alias("hi")).select("p_partkey", F.col("lo"), F.col("hi"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, floor((l_tax + abs(l_discount)) * 10000 + 0.5) / 10000 AS u FROM lineitem")
def m16_uncertainty(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", (F.floor((F.col("l_tax") + F.abs("l_discount")) * 10000 + 0.5) / 10000).alias("u"))


@query("SELECT p_partkey, p10 * CASE WHEN raw / p10 < 1.5 THEN 1 WHEN raw / p10 < 3.5 THEN 2 WHEN raw / p10 < 7.5 THEN 5 ELSE 10 END AS step FROM (SELECT p_partkey, raw, pow(10, floor(log10(raw))) AS p10 FROM (SELECT p_partkey, p_size * 1.7::DOUBLE / 6 AS raw FROM part))")
def m17_nice_step(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", physics.nice_step(F.col("p_size") * 1.7, 6).alias("step"))


@query("SELECT vec_id, len(list_filter(list_sort(embedding), lambda x: x < 0.05)) AS lower_at, len(list_filter(embedding, lambda x: x <= 0.05)) AS upper_at FROM embeddings")
def m18_bounds(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(F.filter("embedding", lambda x: x < 0.05)).cast("long").alias("lower_at"), F.size(F.filter("embedding", lambda x: x <= 0.05)).cast("long").alias("upper_at"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, floor(l_extendedprice / 7 * 1000 + 0.5) / 1000 AS r3 FROM lineitem")
def m20_round_half_up(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", (F.floor(F.col("l_extendedprice") / 7 * 1000 + 0.5) / 1000).alias("r3"))


@query("""SELECT p_partkey, round(coalesce(w * h / nullif(100.0 + p_size * p_size - w * h, 0), 0), 9) AS iou FROM (SELECT *, greatest(least(10.0, x + p_size) - greatest(0.0, x), 0.0) AS w, greatest(least(10.0, 2.0 + p_size) - 2.0, 0.0) AS h FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CAST(p_partkey % 12 AS DOUBLE) AS x FROM part))""")
def m21_iou(spark, sf_dir):
    x, s, zero, ten = (F.col("p_partkey") % 12).cast("double"), F.col("p_size").cast("double"), F.lit(0.0), F.lit(10.0)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(physics.iou((zero, zero, ten, ten), (x, F.lit(2.0), x + s, F.lit(2.0) + s)), 9).alias("iou"))


@query("SELECT user_id, 1.4826 * median(abs(value - m)) AS sigma FROM events JOIN (SELECT user_id, median(value) AS m FROM events GROUP BY user_id) USING (user_id) GROUP BY user_id")
def m22_robust_sigma(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    m = e.groupBy("user_id").agg(F.median("value").alias("m"))
    return e.join(m, "user_id").groupBy("user_id").agg((1.4826 * F.median(F.abs(F.col("value") - F.col("m")))).alias("sigma"))


@query("SELECT user_id, round(log2(l[1] / l[2]), 9) AS distortion FROM (SELECT user_id, list(value ORDER BY value DESC) AS l FROM events GROUP BY user_id) WHERE len(l) >= 2")
def m23_height_ratio(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    top = table(spark, sf_dir, "events").select("user_id", "value", F.row_number().over(w).alias("k")).where("k <= 2").groupBy("user_id").agg(F.max("value").alias("a"), F.min("value").alias("b"), F.count(F.lit(1)).alias("n"))
    return top.where("n = 2").select("user_id", F.round(F.log2(F.col("a") / F.col("b")), 9).alias("distortion"))


@query("SELECT vec_id, i AS place, round(greatest(CAST(embedding[i + 1] AS DOUBLE), 0) / m, 9) AS y FROM (SELECT *, CAST(list_max(embedding) AS DOUBLE) AS m FROM embeddings) , range(64) r(i) WHERE m > 0")
def m24_normalised_vector(spark, sf_dir):
    m = F.array_max("embedding").cast("double")
    y = F.transform("embedding", lambda v: F.greatest(v.cast("double"), F.lit(0.0)) / m)
    rows = table(spark, sf_dir, "embeddings").where(m > 0).select("vec_id", F.posexplode(y).alias("place", "y"))
    return rows.select("vec_id", F.col("place").cast("long").alias("place"), F.round("y", 9).alias("y"))


@query("""SELECT vec_id, round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (CAST(embedding[i] AS DOUBLE) - CAST(q[i] AS DOUBLE)) ** 2))), 9) AS d FROM embeddings, (SELECT embedding AS q FROM embeddings WHERE vec_id = 0)""")
def m25_euclidean(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    q = rows.where("vec_id = 0").select(F.col("embedding").alias("q"))
    d = F.aggregate(F.zip_with("embedding", "q", lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    return rows.crossJoin(F.broadcast(q)).select("vec_id", F.round(F.sqrt(d), 9).alias("d"))


@query("SELECT p_partkey, p_size * 0.02::DOUBLE + (p_partkey % 6) * 0.15::DOUBLE AS low, (p_size * 0.02::DOUBLE + (p_partkey % 6) * 0.15::DOUBLE) * 1.25 AS high FROM part")
def m26_cost(spark, sf_dir):
    low, high = physics.cost_range(F.col("p_size"), F.col("p_partkey") % 6, 0.02, 0.15)
    return table(spark, sf_dir, "part").select("p_partkey", low.alias("low"), high.alias("high"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN o > 0.18 THEN 'text_overlap' WHEN s < greatest(6.0::DOUBLE, 0.22::DOUBLE * 60) THEN 'short_span' WHEN c < 0.08 AND f > 1.8 THEN 'sparse_support' WHEN d < 0.22 AND f > 1.6 THEN 'poor_density'
WHEN l_linenumber % 2 = 0 AND (s < greatest(10.0::DOUBLE, 0.55::DOUBLE * 60) OR c < 0.2 OR o > 0.08) THEN 'single_curve_figure' END AS reason
FROM (SELECT *, l_tax * 2.5::DOUBLE AS o, l_quantity AS s, l_discount * 2 AS c, l_discount * 4 AS d, 1 + l_tax * 20 AS f FROM lineitem)""")
def x2_trace_rejection(spark, sf_dir):
    m = {"text_overlap": F.col("l_tax") * 2.5, "degree_span": F.col("l_quantity"), "support_coverage": F.col("l_discount") * 2, "support_density": F.col("l_discount") * 4, "fill_inflation": 1 + F.col("l_tax") * 20}
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", calibration.trace_rejection(m, F.lit(60.0), F.col("l_linenumber") % 2 == 0).alias("reason"))


@query()
def x1_tick_repair(spark, sf_dir):
    """The table is small for its rows and may come in one task: its two columns are dealt over all before the fold."""
    ticks = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.struct((i * 50.0).alias("px"), F.when(i == F.col("p_size") % 6, 1.0).otherwise(10.0 + i * 10).alias("value")))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size").repartition("p_partkey")
    return calibration.repair_ticks(part.select("p_partkey", ticks.alias("ticks")), "p_partkey")
