"""Pixel operators: users are plots of 100 rows; an event is a pixel at column event_id % 60."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import pixels
from ridgeline.plans.registry import query, table

_INK = "SELECT DISTINCT user_id, event_id % 60 AS col, CAST(floor(least(value, 99)) AS INT) AS row FROM events"
_COLUMNS = "SELECT user_id, col, 30.0::DOUBLE + col % 7 + user_id % 9 AS anchor, CASE WHEN col % 6 > 0 THEN 30.0::DOUBLE + col % 7 + user_id % 9 + (col % 5 - 2) * 1.5 END AS trace FROM (SELECT DISTINCT user_id FROM events), range(60) r(col)"


def _tables(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    ink = e.select("user_id", (F.col("event_id") % 60).alias("col"), F.floor(F.least(F.col("value"), F.lit(99.0))).cast("int").alias("row")).distinct()
    cols = e.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(59).cast("long"))).alias("col"))
    anchor = 30.0 + F.col("col") % 7 + F.col("user_id") % 9
    return cols.select("user_id", "col", anchor.alias("anchor"), F.when(F.col("col") % 6 > 0, anchor + (F.col("col") % 5 - 2) * 1.5).alias("trace")), ink


@query(f"""WITH ink AS ({_INK}), c AS ({_COLUMNS}),
s AS (SELECT c.user_id, c.col, min(abs(row - trace)) AS near, min(CASE WHEN abs(row - anchor) <= 10 THEN abs(row - trace) END) AS mine, coalesce(bool_or(abs(row - anchor) <= 10), false) AS inked, any_value(trace) AS trace FROM c LEFT JOIN ink USING (user_id, col) GROUP BY c.user_id, c.col)
SELECT user_id, count(trace) AS n_eval_cols, coalesce(count(*) FILTER (near <= 3) / nullif(CAST(count(trace) AS DOUBLE), 0), 0) AS precision, coalesce(count(*) FILTER (inked AND mine <= 3) / nullif(CAST(count(*) FILTER (inked) AS DOUBLE), 0), 0) AS recall FROM s GROUP BY user_id""")
def g13_trace_fidelity(spark, sf_dir):
    cols, ink = _tables(spark, sf_dir)
    return pixels.trace_fidelity(cols, ink, "user_id", F.lit(100))


@query(f"""WITH ink AS ({_INK}), c AS ({_COLUMNS}),
f AS (SELECT c.user_id, c.col, any_value(anchor) AS anchor, round(sum(row / (1 + ((row - anchor) / 2.0) ** 2)) / sum(1 / (1 + ((row - anchor) / 2.0) ** 2)), 9) AS found FROM c LEFT JOIN (SELECT * FROM ink) i ON i.user_id = c.user_id AND i.col = c.col AND row BETWEEN trunc(anchor) - 4 AND trunc(anchor) + 4 GROUP BY c.user_id, c.col),
m AS (SELECT user_id, col, coalesce(found, anchor) AS y, found IS NOT NULL AS snapped FROM f),
n AS (SELECT *, list_sort([coalesce(lag(y, 2) OVER w, first_value(y) OVER w), coalesce(lag(y, 1) OVER w, y), y, coalesce(lead(y, 1) OVER w, y), coalesce(lead(y, 2) OVER w, last_value(y) OVER (PARTITION BY user_id ORDER BY col ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))])[3] AS mid,
min(CASE WHEN snapped THEN col END) OVER (PARTITION BY user_id) AS a, max(CASE WHEN snapped THEN col END) OVER (PARTITION BY user_id) AS b FROM m WINDOW w AS (PARTITION BY user_id ORDER BY col))
SELECT user_id, col, round(CASE WHEN abs(y - mid) > 6 THEN mid ELSE y END, 6) AS y, snapped FROM n WHERE a IS NULL OR col BETWEEN a AND b""")
def g14_anchor_snapping(spark, sf_dir):
    cols, ink = _tables(spark, sf_dir)
    return pixels.snapped(cols, ink, "user_id", F.lit(100)).select("user_id", "col", F.round("y", 6).alias("y"), "snapped")


@query()
def r11_ink_colours(spark, sf_dir):
    k = F.col("event_id")
    shade = lambda a, b: F.when(k % 3 == a, 220.0).otherwise(30.0) + k % b
    rows = table(spark, sf_dir, "events").select(shade(0, 5).alias("r"), shade(1, 7).alias("g"), shade(2, 9).alias("b"), F.col("value").alias("row"))
    return pixels.ink_colours(rows, 3).select(*(F.round(c, 3).alias(c) for c in ("r", "g", "b", "row")), "size")
