"""Axis calibration: line fits, tick pairing, consensus, windows, interpolation."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.physics import differences, median_of


# What a misread tick may have lost, and how far readings may lie off.
LOST_TENS = (0.0, 10.0, 20.0, 40.0, 60.0, 80.0)
LOST_ZEROS = (10.0, 100.0)
STEPS_ON = (1.0, 2.0, 3.0)
ROUND_TO = (1.0, 2.0, 5.0, 10.0)
STRAY_LEAST, STRAY_SHARE = 5.0, 0.35
SNAP_LEAST, SNAP_SHARE = 1.5, 0.15

#: Ticks and labels that are fitted at a time.
PAIRED_AT_ONCE = 1 << 17

# When a secondary trace is refused.
OVERLAP_MOST, OVERLAP_ALONE = 0.18, 0.08
SPAN_LEAST, SPAN_SHARE, SPAN_ALONE, SHARE_ALONE = 6.0, 0.22, 10.0, 0.55
COVER_LEAST, COVER_FILL, COVER_ALONE = 0.08, 1.8, 0.2
DENSITY_LEAST, DENSITY_FILL = 0.22, 1.6


def interpolated(y: Column, start: float, step: float, grid: Column) -> Column:
    """Linear interpolation of an evenly sampled curve at the points of an array; ends are clamped."""

    def at(x):
        k = F.greatest(F.lit(0), F.least(F.floor((x - start) / step).cast("int"), F.size(y) - 2))
        a, b = F.get(y, k).cast("double"), F.get(y, k + 1).cast("double")
        part = F.greatest(F.lit(0.0), F.least((x - (F.lit(start) + F.lit(step) * k)) / step, F.lit(1.0)))
        return a + (b - a) * part

    return F.transform(grid, at)


def robust_line(x: np.ndarray, y: np.ndarray, drops: int = 2) -> tuple[float, float, float, int] | None:
    """slope, intercept, rmse and points of a least-squares line; up to `drops` times the worst residual goes when it
    exceeds max(0.3, three times the median one) and three points stay."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    good = np.isfinite(x) & np.isfinite(y)
    x, y = x[good], y[good]
    for left in range(drops, -1, -1):
        if len(x) < 2 or np.ptp(x) == 0:
            return None
        m = ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()
        c = y.mean() - m * x.mean()
        r = np.abs(y - (m * x + c))
        worst = int(r.argmax())
        if left == 0 or len(x) <= 3 or r[worst] <= max(0.3, 3 * float(np.median(r))):
            return float(m), float(c), float(np.sqrt((r**2).mean())), len(x)
        x, y = np.delete(x, worst), np.delete(y, worst)
    return None


def fit_lines(rows: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """One robust line for each key: (key, slope, intercept, rmse, n); null where there is none."""
    kind = rows.schema[key].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([x, y])
        got = robust_line(pdf[x].to_numpy(), pdf[y].to_numpy()) or (None, None, None, 0)
        return pd.DataFrame([(pdf[key].iloc[0], *got)], columns=[key, "slope", "intercept", "rmse", "n"])

    return rows.select(key, x, y).groupBy(key).applyInPandas(fit, f"{key} {kind}, slope double, intercept double, rmse double, n int")


def best_inliers(points: Column, limit: float, most: int = 12, trials: int = 64) -> Column:
    """Most points within `limit` of a line through two of them: array<struct<i, x, y>>, i from 1, x rising.

    All pairs of at most `most` points; of more, `trials` pairs that a fixed rule picks, so that runs repeat.
    """
    n = F.size(points)
    every = F.flatten(F.transform(points, lambda a: F.transform(F.filter(points, lambda b: b["i"] > a["i"]), lambda b: F.struct(a.alias("a"), b.alias("b")))))

    def tried(t):
        a = (t * 7919 + 13) % n
        return F.struct(F.get(points, a).alias("a"), F.get(points, (a + 1 + (t * 104729 + 7) % (n - 1)) % n).alias("b"))

    pairs = F.when(n <= most, every).otherwise(F.transform(F.sequence(F.lit(0), F.lit(trials - 1)), tried))

    def count(p):
        a, b = p["a"], p["b"]
        m = (b["y"] - a["y"]) / (b["x"] - a["x"])
        c = a["y"] - m * a["x"]
        return F.size(F.filter(points, lambda q: (q["i"] == a["i"]) | (q["i"] == b["i"]) | (F.abs(q["y"] - (m * q["x"] + c)) <= limit))).cast("long")

    return F.array_max(F.transform(pairs, count))


def consensus(a: Column, b: Column, n: Column, rmse: Column) -> Column:
    """Status of two readings of one axis value, either of which may be missing."""
    both = a.isNotNull() & b.isNotNull()
    return F.when(a.isNull() & b.isNull(), "failed").when(both & (F.abs(a - b) <= 0.5), "consensus").when(both, "disagreement").when((n >= 3) & (rmse <= 0.15), "single_method").otherwise("weak")


def output_window(ticks: Column, frame_low: Column, frame_high: Column) -> tuple[Column, Column]:
    """Ticks widened by 1.25 median gaps, inside the frame and [0.2, 130]."""
    gap = median_of(differences(ticks))
    return F.greatest(F.array_min(ticks) - 1.25 * gap, frame_low, F.lit(0.2)), F.least(F.array_max(ticks) + 1.25 * gap, frame_high, F.lit(130.0))


def paired_many(ticks: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """slope, intercept, rmse of labels on ticks, a row for each row of both (of one length each, finite), NaN where none fits:
    one to one, or a label every 1, 2 or 5 ticks from some offset.

    Fits need rmse under 0.25; those that span three quarters of the ticks come first, then the least rmse.
    """
    t, v = np.sort(ticks, axis=1), np.sort(labels, axis=1)
    rows, n, m = len(t), t.shape[1], v.shape[1]
    best = np.full((rows, 3), np.nan)
    if m < 2 or n < m:
        return best
    rank = np.full((rows, 2), np.inf)  # narrow or not, rmse; earlier steps and offsets win ties
    down = v.mean(1)
    for k in (1,) if n == m else (1, 2, 5):
        for offset in range(n - k * (m - 1)):
            x = np.ascontiguousarray(t[:, offset : offset + k * (m - 1) + 1 : k])
            over = x.mean(1)
            flat = x[:, -1] == x[:, 0]
            xs, ys = x - over[:, None], v - down[:, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                slope = (xs * ys).sum(1) / (xs**2).sum(1)
                start = down - slope * over
                rmse = np.sqrt((np.abs(v - (slope[:, None] * x + start[:, None])) ** 2).mean(1))
            narrow = ~((x[:, -1] - x[:, 0] >= 0.75 * (t[:, -1] - t[:, 0])) & (t[:, -1] > t[:, 0]))
            here = np.stack([narrow, np.round(rmse, 9)], 1)
            better = ~flat & (rmse < 0.25) & ((here[:, 0] < rank[:, 0]) | (here[:, 0] == rank[:, 0]) & (here[:, 1] < rank[:, 1]))
            rank[better] = here[better]
            best[better] = np.stack([slope, start, rmse], 1)[better]
    return best


def paired(ticks: list[float], labels: list[float]) -> tuple[float, float, float] | None:
    """paired_many of one row."""
    got = paired_many(np.array([ticks], float), np.array([labels], float))[0]
    return None if np.isnan(got[0]) else tuple(got.tolist())


def pair_ticks(rows: DataFrame, key: str) -> DataFrame:
    """rows (key, ticks, labels) to (key, slope, intercept, rmse), in Arrow batches without a shuffle; the rows of a batch that
    have as many ticks and labels are fitted together. Ticks and labels that are null or not finite go; null arrays fit nothing."""
    kind = rows.schema[key].dataType.simpleString()
    known = lambda c: F.filter(F.coalesce(F.col(c).cast("array<double>"), F.array().cast("array<double>")), lambda x: F.abs(x) < float("inf")).alias(c)

    def fit(batches):
        for batch in batches:
            (t, t_from), (v, v_from) = ((np.asarray(c.values), np.asarray(c.offsets)) for c in (batch.column(1), batch.column(2)))
            sizes = np.stack([np.diff(t_from), np.diff(v_from)], 1)
            got = np.full((len(sizes), 3), np.nan)
            for n, m in np.unique(sizes, axis=0).tolist():
                for at in np.array_split(same := np.flatnonzero((sizes == (n, m)).all(1)), -(-len(same) * (n + m + 1) // PAIRED_AT_ONCE)):
                    got[at] = paired_many(t[t_from[at][:, None] + np.arange(n)], v[v_from[at][:, None] + np.arange(m)])
            fits = [pa.array(c, pa.float64(), mask=np.isnan(got[:, 0])) for c in got.T]
            yield pa.RecordBatch.from_arrays([batch.column(0), *fits], names=[key, "slope", "intercept", "rmse"])

    return rows.select(key, known("ticks"), known("labels")).mapInArrow(fit, f"{key} {kind}, slope double, intercept double, rmse double")


def trace_rejection(m: dict[str, Column], primary_span: Column, single_curve: Column) -> Column:
    """Why a secondary trace is refused, or null. m: degree_span, support_coverage, support_density, fill_inflation,
    text_overlap; single_curve: whether the figure is surely of one curve. The first rule that holds names it."""
    span, cover = m["degree_span"], m["support_coverage"]
    wide = F.greatest(primary_span, F.lit(0.0))
    alone = single_curve & ((span < F.greatest(F.lit(SPAN_ALONE), SHARE_ALONE * wide)) | (cover < COVER_ALONE) | (m["text_overlap"] > OVERLAP_ALONE))
    return (
        F.when(m["text_overlap"] > OVERLAP_MOST, "text_overlap")
        .when(span < F.greatest(F.lit(SPAN_LEAST), SPAN_SHARE * wide), "short_span")
        .when((cover < COVER_LEAST) & (m["fill_inflation"] > COVER_FILL), "sparse_support")
        .when((m["support_density"] < DENSITY_LEAST) & (m["fill_inflation"] > DENSITY_FILL), "poor_density")
        .when(alone, "single_curve_figure")
    )


def _readings(seen: Column, last: Column, line: Column, step: Column) -> Column:
    """What a tick read as `seen` may have meant, above the last value: lost leading digits, lost zeros, some steps further, or a
    round value near the line."""
    none = F.array().cast("array<double>")
    options = [F.transform(F.array(*map(F.lit, LOST_TENS)), lambda k: seen + k)]
    options.append(F.when((seen > 0) & (seen < 10), F.transform(F.array(*map(F.lit, LOST_ZEROS)), lambda k: seen * k)).otherwise(none))
    options.append(F.when(step > 0, F.transform(F.array(*map(F.lit, STEPS_ON)), lambda k: last + step * k)).otherwise(none))
    options.append(F.when(line.isNotNull(), F.transform(F.array(*map(F.lit, ROUND_TO)), lambda k: F.rint(line / k) * k)).otherwise(none))
    return F.filter(F.concat(*options), lambda v: v > last)


def _once(value: Column, then) -> Column:
    """then(value), with value computed once however often `then` names it: Spark shares nothing inside a lambda."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _repaired(out: Column, tick: Column, usual: Column) -> Column:
    """The next tick after those of `out`, its value repaired where it falls back or strays from the line of the last two."""
    off = lambda v, place: F.coalesce(F.abs(v - place), F.lit(0.0))

    def lined(s: Column) -> Column:
        last, before = s["last"], s["before"]
        run, rise = last["px"] - before["px"], last["value"] - before["value"]
        sure = (s["n"] > 1) & (run > 1) & (rise > 0)
        line = F.when(sure, last["value"] + rise / run * (s["tick"]["px"] - last["px"]))
        return F.struct(s["n"].alias("n"), s["tick"]["value"].alias("seen"), last["value"].alias("last"), F.when(sure, rise).otherwise(s["usual"]).alias("step"), line.alias("line"))

    def cheapest(s: Column) -> Column:
        seen, last, line, step = (s[c] for c in ("seen", "last", "line", "step"))
        cost = lambda v: F.struct(off(v, line).alias("line"), off(v, last + step).alias("step"), F.when(line.isNull() & step.isNull(), 0.0).otherwise(F.abs(v - seen)).alias("seen"), v.alias("value"))
        near, next_ = F.greatest(F.lit(SNAP_LEAST), SNAP_SHARE * step), last + step
        return _once(F.coalesce(F.array_min(F.transform(_readings(seen, last, line, step), cost))["value"], seen), lambda v: F.when((step > 0) & (F.abs(v - next_) <= near), next_).otherwise(v))

    def value(s: Column) -> Column:
        seen, last, line = s["seen"], s["last"], s["line"]
        fits = (seen > last) & (line.isNull() | (F.abs(seen - line) <= F.greatest(F.lit(STRAY_LEAST), STRAY_SHARE * s["step"])))
        return F.when((s["n"] == 0) | fits, seen).otherwise(cheapest(s))

    n = F.size(out)
    ends = F.struct(n.alias("n"), F.get(out, n - 1).alias("last"), F.get(out, n - 2).alias("before"), tick.alias("tick"), usual.alias("usual"))
    return F.struct(tick["px"].alias("px"), _once(_once(ends, lined), value).alias("value"))


def repair_ticks(rows: DataFrame, key: str) -> DataFrame:
    """rows (key, ticks array<struct<px, value>>) with the values made strictly increasing along px.

    A tick that falls back, or strays from the line of the two before it, takes the cheapest of the plausible readings above
    the last value: nearest to the line, then to one step further, then to what was seen. What still falls back goes. Fewer
    than two ticks stay as they are. A fold over the array: no Python, no shuffle.
    """
    kind = "array<struct<px: double, value: double>>"
    rise = F.transform(F.col("ticks"), lambda t, i: F.round(t["value"] - F.get(F.col("ticks"), i - 1)["value"], 4))
    usual = F.array_max(F.filter(rise, lambda d: d > 0))
    in_order = F.array_sort("ticks", lambda a, b: F.when(a["px"] < b["px"], -1).when(a["px"] > b["px"], 1).otherwise(0))
    ready = rows.select(key, F.col("ticks").cast(kind).alias("ticks"))
    fold = lambda s: F.aggregate(s["sorted"], F.array().cast(kind), lambda out, t: F.concat(out, F.array(_repaired(out, t, s["usual"]))))
    folded = ready.select(key, "ticks", _once(F.struct(in_order.alias("sorted"), usual.alias("usual")), fold).alias("out"))
    highest = lambda i: F.array_max(F.transform(F.slice("out", F.lit(1), i), lambda t: t["value"]))
    rising = F.filter("out", lambda t, i: F.coalesce(t["value"] > highest(i), F.lit(True)))
    return folded.select(key, F.when(F.size("ticks") < 2, F.col("ticks")).otherwise(rising).alias("ticks"))


def spread_labels(rows: list[float], least: float, low: float, high: float) -> list[float]:
    """Label positions moved apart to at least `least`, inside [low, high]: forward, then back from the end."""
    out = sorted(rows)
    for i in range(len(out)):
        out[i] = max(out[i], low if i == 0 else out[i - 1] + least)
    limit = high
    for i in range(len(out) - 1, -1, -1):
        out[i] = min(out[i], limit)
        limit = out[i] - least
    return out


def spread(rows: DataFrame, key: str, position: str, tie: str, least: float, low: float, high: float) -> DataFrame:
    """spread_labels of each key: (key, tie, position). Both passes are running extremes of the position less its place times
    `least`, so that no series is walked."""
    from pyspark.sql import Window

    w, n = Window.partitionBy(key).orderBy(position, tie), F.count(F.lit(1)).over(Window.partitionBy(key))
    placed = rows.select(key, tie, F.col(position).cast("double").alias(position), (F.row_number().over(w) - 1).alias("__i"), n.alias("__n"))
    here, at = Window.partitionBy(key).orderBy("__i"), F.col("__i") * least
    pushed = F.greatest(F.max(F.col(position) - at).over(here.rowsBetween(Window.unboundedPreceding, 0)), F.lit(low)) + at
    back = F.min(F.col("__f") - at).over(here.rowsBetween(0, Window.unboundedFollowing))
    return placed.withColumn("__f", pushed).select(key, tie, (F.least(back, F.lit(high) - (F.col("__n") - 1) * least) + at).alias(position))
