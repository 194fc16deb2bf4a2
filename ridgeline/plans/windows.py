"""Window operators; events are curves of user_id over event_id, embeddings dense curves."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ridgeline.operators import windows
from ridgeline.plans.registry import query, table


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS sort_order FROM orders")
def w1_position(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).cast("long").alias("sort_order"))


@query("""SELECT c_custkey, 'R' || lpad(CAST(row_number() OVER (ORDER BY CASE WHEN c_acctbal > 5000 THEN 0 ELSE 1 END, sha256('42:' || c_custkey)) AS VARCHAR), 8, '0') AS accession FROM customer""")
def w2_seeded_rank(spark, sf_dir):
    """Ranks without one task for all rows: the hash's first byte splits a cohort, counts give each part's first rank."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 5000, 0).otherwise(1).alias("cohort"), F.sha2(F.concat(F.lit("42:"), "c_custkey"), 256).alias("h"))
    rows = rows.withColumn("part", F.left("h", F.lit(2)))
    counts = rows.groupBy("cohort", "part").agg(F.count(F.lit(1)).alias("n"))  # at most 512 rows
    first = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("cohort", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    rank = F.col("before") + F.row_number().over(Window.partitionBy("cohort", "part").orderBy("h"))
    return rows.join(F.broadcast(first), ["cohort", "part"]).select("c_custkey", F.concat(F.lit("R"), F.lpad(rank.cast("string"), 8, "0")).alias("accession"))


_STD = "SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id) AS n, stddev_pop(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND {a} FOLLOWING) AS std FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"


@query(f"SELECT event_id, i, round(std, 6) AS std FROM ({_STD.format(a=14)}) WHERE i <= n - 14")
def w3_rolling_std(spark, sf_dir):
    rows = windows.rolling_std(table(spark, sf_dir, "events"), "user_id", "event_id", "value", 15)
    return rows.select("event_id", F.col("i").cast("long").alias("i"), F.round("std", 6).alias("std"))


_FLAT = f"""flat AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM ({_STD.format(a=3)}) WHERE i <= n - 3 AND std < 25),
runs AS (SELECT user_id, min(i) AS start, count(*) + 3 AS length FROM flat GROUP BY user_id, run HAVING count(*) + 3 >= 5),
every AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
plateaus AS (SELECT r.user_id, start, length, avg(value) AS level FROM runs r JOIN every e ON r.user_id = e.user_id AND i >= start AND i < start + length GROUP BY ALL)"""


@query(f"WITH {_FLAT} SELECT user_id, start, length, round(level, 6) AS level FROM plateaus")
def w4_plateaus(spark, sf_dir):
    return windows.plateaus(table(spark, sf_dir, "events"), "user_id", "event_id", "value", 4, 25.0, 5).select("user_id", "start", "length", F.round("level", 6).alias("level"))


@query(f"WITH {_FLAT}, p AS (SELECT *, lag(start + length) OVER w AS stop, lag(level) OVER w AS prior FROM plateaus WINDOW w AS (PARTITION BY user_id ORDER BY start)) SELECT user_id, start, round(level, 6) AS level, round(prior, 6) AS prior FROM p WHERE start - stop <= 60 AND abs(level - prior) > 10")
def w5_steps(spark, sf_dir):
    flats = windows.plateaus(table(spark, sf_dir, "events"), "user_id", "event_id", "value", 4, 25.0, 5)
    return windows.steps(flats, "user_id", 60, 10.0).select("user_id", "start", F.round("level", 6).alias("level"), F.round("prior", 6).alias("prior"))


@query("""WITH RECURSIVE f AS (SELECT vec_id, i, embedding[i - 3] - embedding[i + 1] > 0.1 AND embedding[i + 5] - embedding[i + 1] > 0.1 AS flag FROM embeddings, range(4, 60) r(i)),
s AS (SELECT vec_id, 4 AS i, CASE WHEN flag THEN 8 ELSE 0 END AS nxt, CAST(flag AS INT) AS n FROM f WHERE i = 4
UNION ALL SELECT s.vec_id, f.i, CASE WHEN flag AND f.i >= nxt THEN f.i + 4 ELSE nxt END, n + CASE WHEN flag AND f.i >= nxt THEN 1 ELSE 0 END FROM s JOIN f ON s.vec_id = f.vec_id AND f.i = s.i + 1)
SELECT vec_id, n AS notches FROM s WHERE i = 59""")
def w6_notches(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", windows.notches(F.col("embedding"), 4, 0.1).alias("notches"))


@query("""WITH z AS (SELECT user_id, event_id, (value - min(value) OVER (PARTITION BY user_id)) / nullif(max(value) OVER (PARTITION BY user_id) - min(value) OVER (PARTITION BY user_id), 0) AS z FROM events),
d AS (SELECT user_id, event_id, z - lag(z) OVER (PARTITION BY user_id ORDER BY event_id) AS d FROM z),
r AS (SELECT user_id, d, lag(d) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM d)
SELECT user_id, avg(CASE WHEN p IS NULL THEN NULL WHEN d * p < 0 AND least(abs(d), abs(p)) > 0.008::DOUBLE THEN 1.0 ELSE 0.0 END) AS reversals, round(sum(abs(d)), 6) AS variation FROM r GROUP BY user_id""")
def w7_reversals(spark, sf_dir):
    return windows.reversals(table(spark, sf_dir, "events"), "user_id", "event_id", "value", 0.008).select("user_id", "reversals", F.round("variation", 6).alias("variation"))


@query("SELECT event_id, round(quantile_cont(value, 0.1) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING), 6) AS base FROM events")
def w8_baseline_window(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-10, 10)
    return table(spark, sf_dir, "events").select("event_id", F.round(F.percentile("value", 0.1).over(w), 6).alias("base"))


_MED = "median(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"


@query(f"""WITH m AS (SELECT user_id, event_id, CASE WHEN abs(value - {_MED}) <= 60 THEN value END AS good FROM events),
n AS (SELECT *, last_value(good IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS a, first_value(good IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b,
last_value(CASE WHEN good IS NOT NULL THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS xa, first_value(CASE WHEN good IS NOT NULL THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS xb FROM m)
SELECT event_id, round(CASE WHEN good IS NOT NULL THEN good WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE a + (b - a) * (event_id - xa) / (xb - xa) END, 6) AS value FROM n""")
def w9_outlier_repair(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    m = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.abs(F.col("value") - F.percentile("value", 0.5).over(w.rowsBetween(-2, 2))) <= 60, F.col("value")).alias("good"))
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col("good").isNotNull(), F.col("event_id"))
    n = m.withColumns({"a": F.last("good", True).over(before), "b": F.first("good", True).over(after), "xa": F.last(at, True).over(before), "xb": F.first(at, True).over(after)})
    line = F.col("a") + (F.col("b") - F.col("a")) * (F.col("event_id") - F.col("xa")) / (F.col("xb") - F.col("xa"))
    return n.select("event_id", F.round(F.when(F.col("good").isNotNull(), F.col("good")).when(F.col("a").isNull(), F.col("b")).when(F.col("b").isNull(), F.col("a")).otherwise(line), 6).alias("value"))


@query(f"SELECT event_id, CASE WHEN abs(value - m) > 50 THEN m ELSE value END AS value FROM (SELECT event_id, value, {_MED} AS m FROM events)")
def w10_jump_suppression(spark, sf_dir):
    m = F.percentile("value", 0.5).over(Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-2, 2))
    return table(spark, sf_dir, "events").select("event_id", "value", m.alias("m")).select("event_id", F.when(F.abs(F.col("value") - F.col("m")) > 50, F.col("m")).otherwise(F.col("value")).alias("value"))


@query("""WITH g AS (SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) - event_id AS gap FROM events), m AS (SELECT user_id, median(gap) AS base FROM g GROUP BY user_id),
k AS (SELECT g.*, base, greatest(1, least(3, CAST(floor(gap / base + 0.5) AS INT))) AS times FROM g JOIN m USING (user_id) WHERE gap IS NOT NULL)
SELECT user_id, event_id, event_id + gap * j / times AS tick FROM k, range(3) r(j) WHERE j < times""")
def w11_grid_fill(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    g = table(spark, sf_dir, "events").select("user_id", "event_id", (F.lead("event_id").over(w) - F.col("event_id")).alias("gap"))
    m = g.groupBy("user_id").agg(F.median("gap").alias("base"))
    times = F.greatest(F.lit(1), F.least(F.lit(3), F.floor(F.col("gap") / F.col("base") + 0.5).cast("int")))
    k = g.where("gap is not null").join(m, "user_id").withColumn("times", times)
    return k.select("user_id", "event_id", "gap", "times", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("j")).select("user_id", "event_id", (F.col("event_id") + F.col("gap") * F.col("j") / F.col("times")).alias("tick"))


@query("SELECT user_id, event_id, value FROM (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM events) WHERE m IS NULL OR value > m")
def w12_increasing_filter(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, sf_dir, "events").withColumn("m", F.max("value").over(w)).where("m is null or value > m").select("user_id", "event_id", "value")


@query("SELECT user_id, event_id, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS session FROM (SELECT user_id, event_id, CASE WHEN event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) <= 100 THEN 0 ELSE 1 END AS n FROM events)")
def w13_gap_sessions(spark, sf_dir):
    return windows.sessions(table(spark, sf_dir, "events"), "user_id", "event_id", 100).select("user_id", "event_id", "session")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, min(CASE WHEN value > 20 THEN event_id END) OVER (PARTITION BY user_id) AS a, max(CASE WHEN value > 20 THEN event_id END) OVER (PARTITION BY user_id) AS b FROM events) WHERE event_id BETWEEN a AND b")
def w15_trim_ends(spark, sf_dir):
    w = Window.partitionBy("user_id")
    ok = F.when(F.col("value") > 20, F.col("event_id"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.min(ok).over(w).alias("a"), F.max(ok).over(w).alias("b")).where("event_id between a and b").select("user_id", "event_id")


@query("""WITH e AS (SELECT *, min(event_id) OVER (PARTITION BY user_id) AS lo, max(event_id) OVER (PARTITION BY user_id) AS hi FROM events),
c AS (SELECT *, CAST(least(floor(coalesce((event_id - lo) * 10 / nullif(hi - lo, 0), 0)), 9) AS INT) AS cell FROM e)
SELECT user_id, cell, arg_min(event_id, (value, event_id)) AS low_at, min(value) AS low, arg_max(event_id, (value, -event_id)) AS high_at, max(value) AS high FROM c GROUP BY user_id, cell""")
def w16_decimation(spark, sf_dir):
    return windows.decimate(table(spark, sf_dir, "events"), "user_id", "event_id", "value", 10)
