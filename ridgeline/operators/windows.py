"""Window operators on long curves: (series, order, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_std(rows: DataFrame, series: str, order: str, value: str, width: int = 15) -> DataFrame:
    """rows with `i` (1..), `std` of the window that starts there; the last width - 1 rows of a series go."""
    w = Window.partitionBy(series).orderBy(order)
    n = F.count(F.lit(1)).over(Window.partitionBy(series))
    out = rows.withColumns({"i": F.row_number().over(w), "std": F.stddev_pop(value).over(w.rowsBetween(0, width - 1)), "__n": n})
    return out.where(F.col("i") <= F.col("__n") - (width - 1)).drop("__n")


def plateaus(rows: DataFrame, series: str, order: str, value: str, width: int, limit: float, least: int) -> DataFrame:
    """Maximal runs of windows whose std is under a limit: (series, start, length, level), length in samples.

    A run of windows i to j covers samples i to j + width - 1. Its number rides on all of them: the latest flat window at or
    before a sample, within the width, names the run, so that one aggregation gives the levels. A sample that two runs cover
    (at most width - 1 samples around a gap) counts for both: the earlier one is found looking back over the gap.
    """
    w = Window.partitionBy(series).orderBy(order)
    back = w.rowsBetween(-(width - 1), 0)
    numbered = rows.withColumns({"i": F.row_number().over(w), "std": F.stddev_pop(value).over(w.rowsBetween(0, width - 1)), "n": F.count(F.lit(1)).over(Window.partitionBy(series))})
    flat = (F.col("i") <= F.col("n") - (width - 1)) & (F.col("std") < limit)
    named = numbered.withColumn("flat", F.coalesce(flat, F.lit(False)))
    named = named.withColumn("run", F.when(F.col("flat"), F.col("i") - F.sum(F.col("flat").cast("int")).over(w)))
    covered = named.withColumn("runs", F.collect_set("run").over(back))  # at most `width` of them
    held = covered.select(series, F.col(value).alias("v"), F.col("i"), "flat", "run", F.explode("runs").alias("of"))
    out = held.groupBy(series, "of").agg(F.min(F.when(F.col("flat") & (F.col("run") == F.col("of")), F.col("i"))).cast("long").alias("start"), F.count(F.lit(1)).alias("length"), F.avg("v").alias("level"))
    return out.where(F.col("length") >= least).select(series, "start", "length", "level")


def steps(flats: DataFrame, series: str, gap: int, rise: float) -> DataFrame:
    """Consecutive plateaus at most `gap` samples apart whose levels differ by more than `rise`."""
    w = Window.partitionBy(series).orderBy("start")
    prior = flats.withColumns({"end": F.lag(F.col("start") + F.col("length")).over(w), "prior": F.lag("level").over(w)})
    return prior.where((F.col("start") - F.col("end") <= gap) & (F.abs(F.col("level") - F.col("prior")) > rise)).select(series, "start", "level", "prior")


def spread_skip(flags: Column, skip: int) -> Column:
    """How many flags of an array a greedy scan counts that skips `skip` samples after each hit."""
    state = F.struct(F.lit(0).alias("next"), F.lit(0).alias("n"), F.lit(0).alias("i"))
    step = lambda s, f: F.struct(F.when(f & (s["i"] >= s["next"]), s["i"] + skip).otherwise(s["next"]).alias("next"), F.when(f & (s["i"] >= s["next"]), s["n"] + 1).otherwise(s["n"]).alias("n"), (s["i"] + 1).alias("i"))
    return F.aggregate(flags, state, step, lambda s: s["n"])


def notches(y: Column, reach: int, depth: float) -> Column:
    """Downward notches of a curve held as an array: both samples `reach` away lie more than `depth` above."""
    inner = F.when(F.size(y) > 2 * reach, F.sequence(F.lit(reach), F.size(y) - 1 - reach)).otherwise(F.array().cast("array<int>"))
    at = lambda i: F.get(y, i)
    return spread_skip(F.transform(inner, lambda i: (at(i - reach) - at(i) > depth) & (at(i + reach) - at(i) > depth)), reach)


def reversals(rows: DataFrame, series: str, order: str, value: str, amplitude: float) -> DataFrame:
    """(series, reversals, variation) of the min-max scaled values: the share of samples where the direction turns between two
    steps of more than `amplitude`, and the sum of all steps. Null for flat series and where too few samples are."""
    every, w = Window.partitionBy(series), Window.partitionBy(series).orderBy(order)
    low, span = F.min(value).over(every), F.max(value).over(every) - F.min(value).over(every)
    steps_ = rows.select(series, order, F.try_divide(F.col(value) - low, span).alias("z")).select(series, order, (F.col("z") - F.lag("z").over(w)).alias("d"))
    turned = steps_.withColumn("p", F.lag("d").over(w))
    turns = F.when((F.col("d") * F.col("p") < 0) & (F.least(F.abs("d"), F.abs("p")) > amplitude), 1.0).otherwise(0.0)
    return turned.groupBy(series).agg(F.avg(F.when(F.col("p").isNotNull(), turns)).alias("reversals"), F.sum(F.abs("d")).alias("variation"))


def sessions(rows: DataFrame, series: str, order: str, gap: Column | float) -> DataFrame:
    """rows with `session`: numbered from 1 in each series, a new one after a gap of more than `gap`."""
    w = Window.partitionBy(series).orderBy(order)
    new = (F.col(order) - F.lag(order).over(w) > gap).cast("int")
    return rows.withColumn("__new", F.coalesce(new, F.lit(1))).withColumn("session", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def decimate(rows: DataFrame, series: str, order: str, value: str, columns: int) -> DataFrame:
    """The first lowest and first highest sample of each of `columns` equal cells of the order's extent."""
    ends = Window.partitionBy(series)
    lo, hi = F.min(order).over(ends), F.max(order).over(ends)
    cell = F.least(F.floor(F.coalesce(F.try_divide((F.col(order) - lo) * columns, hi - lo), F.lit(0))), F.lit(columns - 1)).cast("int")
    cells = rows.withColumn("cell", cell).groupBy(series, "cell").agg(F.min(F.struct(F.col(value).alias("v"), F.col(order).alias("o"))).alias("a"), F.max(F.struct(F.col(value).alias("v"), (-F.col(order)).alias("o"))).alias("b"))
    return cells.select(series, "cell", F.col("a.o").alias("low_at"), F.col("a.v").alias("low"), (-F.col("b.o")).alias("high_at"), F.col("b.v").alias("high"))
