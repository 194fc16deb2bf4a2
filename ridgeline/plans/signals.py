"""Signal operators: embeddings as curves held as arrays (x = 2.0 + 0.5 * position, y in hundredths); events as sparse ones."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ridgeline.operators import signal
from ridgeline.plans.peaks import CURVES, angles
from ridgeline.plans.registry import query, table


def _curves(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double") * 100).alias("y"))


def _run(spark, sf_dir, kernel, schema, *more, many=None):
    return signal.per_curve(_curves(spark, sf_dir), "vec_id", angles, "y", kernel, schema, *more, many=many)


def _pairs(x, y):
    return list(zip(x.tolist(), y.tolist()))


@query(f"WITH {CURVES} SELECT vec_id, x AS two_theta, rel_height, prominence FROM peaks")
def g1_detect_peaks(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return signal.per_curve(rows, "vec_id", angles, "embedding", lambda x, y: [t[:3] for t in signal.detect_peaks(x, y)], "two_theta double, rel_height double, prominence double")


@query()
def g2_first_peak(spark, sf_dir):
    def run(x, y):
        r = signal.first_peak(x, y)
        return [] if r is None else [(r["status"], r.get("two_theta"), r.get("fwhm"), r.get("snr"))]

    return _run(spark, sf_dir, run, "status string, two_theta double, fwhm double, snr double")


@query()
def g3_first_peak_spacing(spark, sf_dir):
    """As it is written back: each curve with its own wavelength, some without one, some with an implausible one."""

    def run(x, y, wavelength):
        r = signal.first_peak(x, y)
        r = r and signal.with_spacing(r, wavelength)
        return [] if r is None else [(r["status"], r["two_theta"], r["d"], r["snr"], r["fwhm"], r["wavelength"], r["assumed"])]

    known = F.when(F.col("label") % 3 == 0, 0.7107).when(F.col("label") % 3 == 1, 3.0)
    rows = _curves(spark, sf_dir).withColumn("wavelength", known)
    return signal.per_curve(rows, "vec_id", angles, "y", run, "status string, two_theta double, d double, snr double, fwhm double, wavelength double, assumed int", "wavelength")


@query()
def g4_descriptors(spark, sf_dir):
    def run(x, y):
        first = signal.first_peak(x, y) or {}
        return [tuple(signal.descriptors(x, y, first.get("two_theta"), first.get("fwhm")).values())]

    return _run(spark, sf_dir, run, "crystalline_fraction double, hump_center double, hump_fwhm double, hump_height double, intensity_ratio_100_001 double, hump_window_covered int")


@query()
def g5_shape_verdict(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_id").cast("double").alias("x"), F.col("value").alias("y"))
    return signal.per_series(e, "user_id", "x", "y", lambda x, y: [tuple(signal.shape_verdict(y).values())], "flagged boolean, reasons string, steps int, notches int, rev_frac double, tv double")


@query()
def g6_process_curve(spark, sf_dir):
    def run(xs, ys):
        made = [signal.process_curve(x, y, base, 0.25) for x, y, base in zip(xs, ys, signal.asls_many(ys))]
        return [[(len(grid), float(v.max(initial=0.0)), len(peaks))] for grid, v, peaks in made]

    return _run(spark, sf_dir, None, "n int, top double, peaks int", many=run)


@query()
def g7_asls_baseline(spark, sf_dir):
    def run(xs, ys):
        return [_pairs(x, base) for x, base in zip(xs, signal.asls_many(ys, stiffness=1e3))]

    return _run(spark, sf_dir, None, "x double, base double", many=run)


def _smoothing_sql(window: int, order: int) -> str:
    """Each sample's weights on the samples of its window, from the normal equations."""
    powers = np.vander(np.arange(window) - window // 2, order + 1, increasing=True).astype(float)
    hat = powers @ np.linalg.solve(powers.T @ powers, powers.T)
    weights = ", ".join(f"({i}, {j}, {w!r}::DOUBLE)" for i, row in enumerate(hat.tolist()) for j, w in enumerate(row))
    half = window // 2
    return f"""WITH w(i, j, weight) AS (VALUES {weights}),
p AS (SELECT vec_id, pos, least(greatest(pos - {half}, 0), 64 - {window}) AS first, embedding FROM embeddings, range(64) r(pos))
SELECT vec_id, CAST(2.0 + 0.5 * pos AS DOUBLE) AS x, round(sum(weight * CAST(embedding[first + j + 1] AS DOUBLE) * 100), 6) AS y FROM p JOIN w ON i = pos - first GROUP BY vec_id, pos"""


@query(_smoothing_sql(7, 2))
def g8_savgol(spark, sf_dir):
    return _run(spark, sf_dir, lambda x, y: _pairs(x, np.round(signal.smooth(y, 7, 2), 6)), "x double, y double")


@query("""WITH g AS (SELECT vec_id, embedding, i, 2.0::DOUBLE + 0.3::DOUBLE * i AS x FROM embeddings, range(106) r(i)),
p AS (SELECT *, least((x - 2.0) / 0.5, 63.0::DOUBLE) AS p FROM g), k AS (SELECT *, CAST(least(floor(p), 62) AS INT) AS a FROM p)
SELECT vec_id, round(x, 6) AS x, round(100 * (CAST(embedding[a + 1] AS DOUBLE) + (p - a) * (CAST(embedding[a + 2] AS DOUBLE) - CAST(embedding[a + 1] AS DOUBLE))), 6) AS y FROM k""")
def g9_interpolate(spark, sf_dir):
    """31.5 degrees in steps of 0.3: the last of the 106 points passes the end, and holds the last value."""

    def run(x, y):
        grid, v = signal.interpolate(x, y, 0.3)
        return _pairs(np.round(grid, 6), np.round(v, 6))

    return _run(spark, sf_dir, run, "x double, y double")


@query()
def g10_pick_peaks(spark, sf_dir):
    return _run(spark, sf_dir, lambda x, y: signal.pick_peaks(x, np.maximum(y - y.min(), 0)), "position double, height double")


@query("""SELECT vec_id, i AS pos, round((v - lo) / (hi - lo) * 100 + (4 - 1 - vec_id % 4) * 60, 9) AS y FROM (SELECT vec_id, r.i AS i, CAST(embedding[r.i + 1] AS DOUBLE) AS v, CAST(list_min(embedding) AS DOUBLE) AS lo, CAST(list_max(embedding) AS DOUBLE) AS hi FROM embeddings, range(64) r(i))""")
def g12_offset_stack(spark, sf_dir):
    lo, hi = F.array_min("embedding").cast("double"), F.array_max("embedding").cast("double")
    y = F.transform("embedding", lambda v: (v.cast("double") - lo) / (hi - lo) * 100 + (3 - F.col("vec_id") % 4) * 60)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(y).alias("pos", "y")).select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("y", 9).alias("y"))


@query()
def g11_peak_fidelity(spark, sf_dir):
    """Each curve against itself smoothed, and against a control whose highest peak is amputated."""

    def run(x, y):
        runs = (("smoothed", signal.smooth(y, 5, 2)), ("control", signal.amputated(y)))
        return [(name, *signal.peak_fidelity(y, other).values()) for name, other in runs]

    return _run(spark, sf_dir, run, "run string, status string, n_peaks int, worst_loss double, worst_gain double, ratio_distortion_log2 double, flagged boolean")


@query()
def j15_box_suppression(spark, sf_dir):
    """Greedy suppression of overlapping boxes of each user, a box an event, the strongest first."""
    import pandas as pd

    x, y = F.col("value") / 50, F.col("event_id") % 50 / 5
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", x.alias("x0"), y.alias("y0"), (x + 3).alias("x1"), (y + 3).alias("y1"), "value")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["value", "event_id"], ascending=[False, True])
        return pdf.iloc[signal.suppress_boxes(pdf[["x0", "y0", "x1", "y1"]].to_numpy(), 0.3)][["user_id", "event_id"]]

    return rows.groupBy("user_id").applyInPandas(run, "user_id long, event_id long")
