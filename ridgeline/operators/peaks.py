"""Peak operators on curves held as arrays: no row is exploded and nothing shuffles."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import physics
from ridgeline.operators import signal

PEAKS = "peaks array<struct<two_theta: double, rel_height: double, prominence: double, height: double>>"


def detected(curves: DataFrame, key: str, x: str | Callable[[int], np.ndarray], y: str, carried: str | None = None) -> DataFrame:
    """(key, carried, peaks) of each curve: its peaks by topographic prominence (see `signal.detect_peaks`), by position."""
    names = ("two_theta", "rel_height", "prominence", "height")
    found = lambda u, v: [dict(zip(names, t)) for t in signal.detect_peaks(u, v)]
    if carried is None:
        return signal.per_curve(curves, key, x, y, lambda u, v: [(found(u, v),)], PEAKS)
    kind = curves.schema[carried].dataType.simpleString()
    return signal.per_curve(curves, key, x, y, lambda u, v, c: [(c, found(u, v))], f"{carried} {kind}, {PEAKS}", carried)


def nearest(peaks: Column, target: float, within: Column) -> Column:
    """The peak nearest to a target within a tolerance (ties: the lower angle), or null."""
    near = F.filter(peaks, lambda p: F.abs(p["two_theta"] - target) <= within)
    return F.array_min(F.transform(near, lambda p: F.struct(F.abs(p["two_theta"] - target).alias("distance"), p["two_theta"].alias("two_theta"), p["prominence"].alias("prominence"))))


def search_peaks(curves: DataFrame, targets: list[float], asked: float = 0.15, statuses: list[str] | None = None, key: str = "series_id") -> DataFrame:
    """Curves (key, peaks, uncertainty, status) that have a peak near every target.

    One to eight different targets, else no row; one peak may serve two targets; `statuses` None sets no gate.
    """
    within = physics.tolerance(F.lit(float(asked)), F.col("uncertainty"))
    wrong = not 1 <= len(targets) <= 8 or len(set(targets)) < len(targets)
    rows = curves if statuses is None else curves.where(F.col("status").isin(statuses))
    hits = [nearest(F.col("peaks"), float(t), within).alias(f"hit_{i}") for i, t in enumerate(targets, 1)]
    found = rows.where(F.lit(not wrong)).select(key, within.alias("effective_tol"), *hits)
    names = [f"hit_{i}" for i in range(1, len(targets) + 1)]
    for n in names:
        found = found.where(F.col(n).isNotNull())
    low = F.least(*[F.col(f"{n}.prominence") for n in names]) if len(names) > 1 else F.col(f"{names[0]}.prominence") if names else F.lit(None).cast("double")
    return found.select(key, *[F.col(f"{n}.two_theta").alias(n) for n in names], low.alias("min_prominence"), "effective_tol")
