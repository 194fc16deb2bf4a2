"""Peak searches over the embedding vectors, read as curves: x = 2.0 + 0.5 * position."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import physics
from ridgeline.operators import joins, peaks
from ridgeline.plans.registry import query, table

#: The same curves and peaks in SQL: maxima that stand out of the ground between higher samples by 3 % of the range.
CURVES = """points AS (SELECT vec_id, label, p.pos AS pos, CAST(2.0 + 0.5 * p.pos AS DOUBLE) AS x, CAST(embedding[p.pos + 1] AS DOUBLE) AS y
  FROM embeddings, (SELECT unnest(range(64)) AS pos) p),
spans AS (SELECT vec_id, min(y) AS low, max(y) - min(y) AS span FROM points GROUP BY vec_id),
flanks AS (SELECT *, lag(y) OVER w AS l, lead(y) OVER w AS r FROM points WINDOW w AS (PARTITION BY vec_id ORDER BY pos)),
tops AS (SELECT vec_id, label, pos, x, y FROM flanks WHERE y > l AND y > r),
grounds AS (SELECT t.vec_id, t.label, t.pos, t.x, t.y, coalesce(max(p.pos) FILTER (p.pos < t.pos AND p.y > t.y), -1) AS a, coalesce(min(p.pos) FILTER (p.pos > t.pos AND p.y > t.y), 64) AS b
  FROM tops t JOIN points p ON p.vec_id = t.vec_id GROUP BY t.vec_id, t.label, t.pos, t.x, t.y),
raised AS (SELECT g.vec_id, g.label, g.pos, g.x, g.y, g.y - greatest(min(p.y) FILTER (p.pos <= g.pos), min(p.y) FILTER (p.pos >= g.pos)) AS rise
  FROM grounds g JOIN points p ON p.vec_id = g.vec_id AND p.pos > g.a AND p.pos < g.b GROUP BY g.vec_id, g.label, g.pos, g.x, g.y),
peaks AS (SELECT r.vec_id, label, pos, x, y, round((y - low) / span, 4) AS rel_height, round(rise / span, 4) AS prominence FROM raised r JOIN spans s ON s.vec_id = r.vec_id WHERE rise >= 0.03::DOUBLE * span)"""
UNCERTAINTY = "CASE WHEN label = 9 THEN NULL ELSE 0.05 * (label % 4) END"


def angles(n: int) -> np.ndarray:
    return 2.0 + 0.5 * np.arange(n)


def curves(spark, sf_dir) -> DataFrame:
    """vec_id, label, peaks, uncertainty and status of each curve."""
    return peaks.detected(table(spark, sf_dir, "embeddings"), "vec_id", angles, "embedding", "label").select(
        "*",
        F.when(F.col("label") != 9, 0.05 * (F.col("label") % 4)).cast("double").alias("uncertainty"),
        F.when(F.col("label") < 6, "ok").otherwise("low_confidence").alias("status"),
    )


def _search_sql(targets: list[float], asked: float, gate: str = "true") -> str:
    tol = f"greatest(least(greatest({asked}, 0.02), 1.0), coalesce({UNCERTAINTY}, 0.0))"
    hits = ", ".join(f"max(x) FILTER (t = {i}) AS hit_{i}" for i in range(1, len(targets) + 1))
    values = ", ".join(f"({i}, CAST({t} AS DOUBLE))" for i, t in enumerate(targets, 1))
    return f"""WITH {CURVES}, near AS (
  SELECT vec_id, t, x, prominence, CAST({tol} AS DOUBLE) AS tol, row_number() OVER (PARTITION BY vec_id, t ORDER BY abs(x - target), x) AS k
  FROM peaks, (VALUES {values}) AS v(t, target) WHERE {gate} AND abs(x - target) <= CAST({tol} AS DOUBLE))
SELECT vec_id, {hits}, min(prominence) AS min_prominence, max(tol) AS effective_tol FROM near WHERE k = 1
GROUP BY vec_id HAVING count(DISTINCT t) = {len(targets)}"""


@query(_search_sql([5.2, 12.9], 0.55))
def a5_multi_peak_search(spark, sf_dir):
    return peaks.search_peaks(curves(spark, sf_dir), [5.2, 12.9], 0.55, None, "vec_id")


@query(_search_sql([4.1, 9.6, 20.2], 0.9, "label < 6"))
def r5_search_peaks_function(spark, sf_dir):
    return peaks.search_peaks(curves(spark, sf_dir), [4.1, 9.6, 20.2], 0.9, ["ok"], "vec_id")


@query(f"WITH {CURVES} SELECT vec_id, count(*) AS n_peaks, min(x) AS first_x, max(prominence) AS best FROM peaks GROUP BY vec_id")
def w14_local_maxima(spark, sf_dir):
    rows = curves(spark, sf_dir).where(F.size("peaks") > 0)
    return rows.select("vec_id", F.size("peaks").cast("long").alias("n_peaks"), F.col("peaks")[0]["two_theta"].alias("first_x"), F.array_max(F.transform("peaks", lambda p: p["prominence"])).alias("best"))


@query(f"""WITH {CURVES}, v(target) AS (VALUES (3.2::DOUBLE), (7.7::DOUBLE), (15.1::DOUBLE)), near AS (
  SELECT vec_id, target, x, prominence, row_number() OVER (PARTITION BY vec_id, target ORDER BY abs(x - target), x) AS k FROM peaks, v WHERE abs(x - target) <= 0.6)
SELECT vec_id, CAST(target AS DOUBLE) AS target, x, prominence FROM near WHERE k = 1""")
def j7_nearest_peak_lateral(spark, sf_dir):
    rows = curves(spark, sf_dir).select("vec_id", F.explode(F.array(*[F.struct(F.lit(t).alias("target"), peaks.nearest(F.col("peaks"), t, F.lit(0.6)).alias("hit")) for t in (3.2, 7.7, 15.1)])).alias("m"))
    return rows.where("m.hit is not null").select("vec_id", "m.target", F.col("m.hit.two_theta").alias("x"), F.col("m.hit.prominence").alias("prominence"))


@query(f"WITH {CURVES} SELECT vec_id, CAST(t.target AS DOUBLE) AS target, count(*) FILTER (abs(x - t.target) <= 1.0) AS n_near FROM peaks, (VALUES (5.0::DOUBLE), (12.5::DOUBLE)) AS t(target) GROUP BY ALL")
def j8_cross_join_targets(spark, sf_dir):
    rows = curves(spark, sf_dir).where(F.size("peaks") > 0).select("vec_id", "peaks", F.explode(F.array(F.lit(5.0), F.lit(12.5))).alias("target"))
    return rows.select("vec_id", "target", F.size(F.filter("peaks", lambda p: F.abs(p["two_theta"] - F.col("target")) <= 1.0)).cast("long").alias("n_near"))


@query(f"""WITH {CURVES}, first AS (SELECT vec_id, any_value(label) AS label, min(x) AS x FROM peaks WHERE y >= 0.1 GROUP BY vec_id),
t(target) AS (SELECT 2.5::DOUBLE + 0.73::DOUBLE * i FROM range(20) r(i))
SELECT vec_id, CAST(target AS DOUBLE) AS target, x FROM first, t WHERE abs(x - target) <= greatest(0.3::DOUBLE, coalesce({UNCERTAINTY}, 0.0))""")
def j10_first_peak_band_join(spark, sf_dir):
    high = F.filter("peaks", lambda p: p["height"] >= 0.1)
    first = curves(spark, sf_dir).where(F.size(high) > 0).select("vec_id", high[0]["two_theta"].alias("x"), F.greatest(F.lit(0.3), F.coalesce("uncertainty", F.lit(0.0))).alias("tol"))
    targets = spark.range(20).select((F.lit(2.5) + F.lit(0.73) * F.col("id")).alias("target"))
    return joins.band_join(first, targets, "x", "target", "tol", 0.5).select("vec_id", "target", "x")


@query("""WITH p AS (SELECT vec_id, i AS pos, CAST(2.0 + 0.5 * i AS DOUBLE) AS x, CAST(embedding[i + 1] AS DOUBLE) AS y FROM embeddings, range(64) r(i)), t(target) AS (VALUES (3.25::DOUBLE), (10.1::DOUBLE)),
n AS (SELECT vec_id, CAST(target AS DOUBLE) AS target, x, y, row_number() OVER (PARTITION BY vec_id, target ORDER BY abs(x - target), x) AS k FROM p, t)
SELECT vec_id, target, x, y FROM n WHERE k = 1""")
def j11_nearest_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.explode(F.array(F.lit(3.25), F.lit(10.1))).alias("target"))
    spot = F.greatest(F.lit(0), F.least(F.size("embedding") - 1, F.ceil((F.col("target") - 2.0) / 0.5 - 0.5).cast("int")))
    return rows.select("vec_id", "target", (F.lit(2.0) + 0.5 * spot).alias("x"), F.get("embedding", spot).cast("double").alias("y"))


@query(f"""WITH {CURVES}, f AS (SELECT vec_id, list(x ORDER BY x) AS xs FROM peaks GROUP BY vec_id)
SELECT vec_id, (SELECT avg(m) FROM (SELECT min(abs(e - r)) AS m FROM unnest([5.0, 9.5, 21.0]) a(r), unnest(xs) b(e) GROUP BY r)) AS delta FROM f""")
def j16_reported_peak_delta(spark, sf_dir):
    rows = curves(spark, sf_dir).where(F.size("peaks") > 0)
    return rows.select("vec_id", physics.delta_to_nearest(F.array(F.lit(5.0), F.lit(9.5), F.lit(21.0)), F.transform("peaks", lambda p: p["two_theta"])).alias("delta"))


@query(f"""WITH {CURVES}, b AS (SELECT CAST(ceil((x - 2.0) / 2.5) - 1 AS INT) AS bin, CAST(prominence AS DECIMAL(18, 9)) AS prominence FROM peaks WHERE x > 2.0 AND x <= 49.5)
SELECT bin, count(*) AS n, CAST(sum(prominence) AS DOUBLE) AS weight FROM b GROUP BY bin""")
def a14_peak_histogram(spark, sf_dir):
    rows = curves(spark, sf_dir).select(F.explode("peaks").alias("p")).where("p.two_theta > 2.0 and p.two_theta <= 49.5")
    rows = rows.select((F.ceil((F.col("p.two_theta") - 2.0) / 2.5) - 1).cast("int").alias("bin"), F.col("p.prominence").cast("decimal(18,9)").alias("w"))
    return rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("w").cast("double").alias("weight"))


@query(f"""WITH {CURVES}, k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY prominence DESC, x) AS r, count(*) OVER (PARTITION BY vec_id) AS n FROM peaks)
SELECT vec_id, x, prominence, n >= 5 AS truncated FROM k WHERE r <= 5""")
def l4_top_peaks_by_prominence(spark, sf_dir):
    best = F.slice(F.array_sort(F.transform("peaks", lambda p: F.struct((-p["prominence"]).alias("a"), p["two_theta"].alias("x")))), 1, 5)
    rows = curves(spark, sf_dir).select("vec_id", (F.size("peaks") >= 5).alias("truncated"), F.explode(F.array_sort(F.transform(best, lambda p: F.struct(p["x"].alias("x"), (-p["a"]).alias("prominence"))))).alias("p"))
    return rows.select("vec_id", "p.x", "p.prominence", "truncated")


@query(f"""WITH {CURVES}, k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY y DESC, x) AS r FROM peaks) SELECT vec_id, r AS place, x, y FROM k WHERE r <= 8""")
def l5_top_peaks_by_height(spark, sf_dir):
    best = F.slice(F.array_sort(F.transform("peaks", lambda p: F.struct((-p["height"]).alias("a"), p["two_theta"].alias("x")))), 1, 8)
    return curves(spark, sf_dir).select("vec_id", F.posexplode(best).alias("i", "p")).select("vec_id", (F.col("i") + 1).cast("long").alias("place"), "p.x", (-F.col("p.a")).alias("y"))
