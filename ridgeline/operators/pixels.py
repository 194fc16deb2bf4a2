"""Operators on pixel tables: ink (key, col, row) and columns (key, col, anchor, trace), one row for each column of a plot.

Everything is an equi-join on the plot and the column and an aggregation; no plot becomes a matrix.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Windows and limits, as shares of the plot's height and as least pixels.
SNAP_SHARE, SNAP_LEAST = 0.045, 4
JUMP_SHARE, JUMP_LEAST, JUMP_SAMPLES = 0.05, 6.0, 7
TOLERANCE_SHARE, TOLERANCE_LEAST = 0.02, 3
BAND_SHARE, BAND_LEAST = 0.10, 6
LEAST_PIXELS = 30


def snapped(columns: DataFrame, ink: DataFrame, key: str, height: Column) -> DataFrame:
    """(key, col, y, snapped): each column's anchor moved to the centroid of the ink near it, weighed towards the anchor.

    Centroids have nine decimals, so that no limit depends on the order of a sum. Columns without ink near keep the anchor. Jumps over the median of five columns take that median (of plots with seven
    columns at least), and unsnapped columns before the first and after the last snapped one go.
    """
    rows = columns.where("anchor is not null").select(key, "col", "anchor", height.cast("double").alias("h"))
    rows = rows.withColumn("reach", F.greatest(F.lit(SNAP_LEAST), F.floor(F.col("h") * SNAP_SHARE)))
    near = ink.join(rows, [key, "col"]).where("row >= int(anchor) - reach and row <= int(anchor) + reach and row >= 0 and row < h")
    off = F.abs(F.col("row") - F.col("anchor")) / F.greatest(F.lit(1.0), F.col("reach") / 2)
    weight = 1 / (1 + off * off)
    found = near.groupBy(key, "col").agg(F.round(F.sum(weight * F.col("row")) / F.sum(weight), 9).alias("found"))
    moved = rows.join(found, [key, "col"], "left").select(key, "col", "h", F.coalesce("found", "anchor").alias("y"), F.col("found").isNotNull().alias("snapped"))
    w, every = Window.partitionBy(key).orderBy("col"), Window.partitionBy(key)
    first, last = F.first("y").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.last("y").over(w.rowsBetween(0, Window.unboundedFollowing))
    five = F.array(*[F.coalesce(F.lag("y", k).over(w), first) for k in (2, 1)], F.col("y"), *[F.coalesce(F.lead("y", k).over(w), last) for k in (1, 2)])
    middle = moved.withColumns({"middle": F.get(F.array_sort(five), F.lit(2)), "n": F.count(F.lit(1)).over(every)})
    jump = (F.col("n") >= JUMP_SAMPLES) & (F.abs(F.col("y") - F.col("middle")) > F.greatest(F.lit(JUMP_LEAST), F.col("h") * JUMP_SHARE))
    out = middle.withColumn("y", F.when(jump, F.col("middle")).otherwise(F.col("y")))
    at = F.when(F.col("snapped"), F.col("col"))
    out = out.withColumns({"a": F.min(at).over(every), "b": F.max(at).over(every)})
    return out.where("a is null or col between a and b").select(key, "col", "y", "snapped")


def trace_fidelity(columns: DataFrame, ink: DataFrame, key: str, height: Column, anchored: bool = True) -> DataFrame:
    """(key, precision, recall, n_eval_cols) of traces by column.

    precision: the share of traced columns with ink within the tolerance. recall: of the columns with ink in a band around the
    anchor (of all columns with ink, unless anchored), the share that the trace explains; columns it gave up count.
    """
    rows = columns.select(key, "col", F.col("anchor").cast("double").alias("anchor"), F.col("trace").cast("double").alias("trace"), height.cast("double").alias("h"))
    rows = rows.withColumns({"tolerance": F.greatest(F.lit(TOLERANCE_LEAST), F.floor(F.col("h") * TOLERANCE_SHARE)), "band": F.greatest(F.lit(BAND_LEAST), F.floor(F.col("h") * BAND_SHARE))})
    off = F.abs(F.col("row") - F.col("trace"))
    mine = F.abs(F.col("row") - F.col("anchor")) <= F.col("band") if anchored else F.lit(True)
    seen = ink.join(rows, [key, "col"]).groupBy(key, "col").agg(F.min(off).alias("nearest"), F.min(F.when(mine, off)).alias("nearest_mine"), F.bool_or(mine).alias("inked"))
    each = rows.join(seen, [key, "col"], "left")
    near = lambda c: F.coalesce(F.col(c) <= F.col("tolerance"), F.lit(False))
    sums = each.groupBy(key).agg(F.count("trace").alias("n_eval_cols"), F.count_if(near("nearest")).alias("hits"), F.count_if("inked").alias("inked"), F.count_if(F.col("inked") & near("nearest_mine")).alias("explained"))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return sums.select(key, share("hits", "n_eval_cols").alias("precision"), share("explained", "inked").alias("recall"), "n_eval_cols")


def lab(r: Column, g: Column, b: Column) -> list[Column]:
    """CIE L*, a* and b* (D65) of sRGB channels from 0 to 255."""
    linear = [F.when(c / 255 <= 0.04045, c / 255 / 12.92).otherwise(F.pow((c / 255 + 0.055) / 1.055, F.lit(2.4))) for c in (r, g, b)]
    to_white = ((0.412453 / 0.950456, 0.357580 / 0.950456, 0.180423 / 0.950456), (0.212671, 0.715160, 0.072169), (0.019334 / 1.088754, 0.119193 / 1.088754, 0.950227 / 1.088754))  # fixed values
    x, y, z = (sum((w * c for w, c in zip(row[1:], linear[1:])), row[0] * linear[0]) for row in to_white)
    root = lambda v: F.when(v > 0.008856, F.cbrt(v)).otherwise(7.787 * v + 16 / 116)
    return [116 * root(y) - 16, 500 * (root(x) - root(y)), 200 * (root(y) - root(z))]


def ink_colours(pixels: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """Clusters of coloured pixels (r, g, b, row) by k-means over CIE Lab: median colour, mean row and size of those with
    LEAST_PIXELS pixels at least. Fewer different colours than k give fewer clusters; an empty table none."""
    rows = pixels.select("r", "g", "b", "row", *(c.alias(n) for c, n in zip(lab(F.col("r"), F.col("g"), F.col("b")), ("x", "y", "z"))))
    ready = VectorAssembler(inputCols=["x", "y", "z"], outputCol="v").transform(rows.where("r is not null and g is not null and b is not null"))
    schema = "r double, g double, b double, row double, size long"
    if ready.limit(1).isEmpty():
        return pixels.sparkSession.createDataFrame([], schema)
    made = KMeans(k=k, seed=seed, maxIter=30, initMode="k-means||", featuresCol="v", predictionCol="cluster").fit(ready).transform(ready)
    out = made.groupBy("cluster").agg(*(F.percentile(c, 0.5).alias(c) for c in "rgb"), F.avg("row").alias("row"), F.count(F.lit(1)).alias("size"))
    return out.where(F.col("size") >= LEAST_PIXELS).select("r", "g", "b", "row", "size")
