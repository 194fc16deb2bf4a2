"""Signal kernels on curves (NumPy) and their maps over arrays: Arrow batches of many curves, no shuffle. Curves that come
as points are gathered first, by one shuffle on the series.

Filters follow public documentation: reflecting edges for percentile and Gaussian filters (truncated at four sigma),
polynomial edges for Savitzky-Golay, flat tops at their middle for peaks, distance before prominence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ridgeline.functions.physics import WAVELENGTH, WAVELENGTHS

# Limits of the kernels.
PEAK_SHARE, PEAK_APART, MOST_PEAKS = 0.03, 0.1, 40
SNR_OK, SNR_LOW = 5.0, 3.5
FWHM_RANGE = (0.05, 3.0)
EDGE_DEGREES, PERSIST_DEGREES = 0.25, 0.12
SCALES = (0.10, 0.30, 0.60)
NOISE_DEGREES, BASE_DEGREES = 0.20, 6.0
HUMP_WINDOW, HUMP_SPAN, HUMP_LEAST, HUMP_SIGMA = (15.0, 35.0), 3.0, 0.02, 0.6
FRACTION_BASE_DEGREES, MASK_DEGREES, HEIGHT_DEGREES = 4.0, 1.5, 0.75
FLAT_WIDTH, FLAT_STD, FLAT_LEAST = 15, 0.004, 20
STEP_GAP, STEP_RISE = 60, 0.10
NOTCH_REACH, NOTCH_DEPTH = 4, 0.12
REVERSAL_AMPLITUDE = 0.008
MOST_STEPS, MOST_NOTCHES, MOST_REVERSALS, MOST_VARIATION = 1, 1, 0.03, 20.0
PROFILE_PROMINENCE, PROFILE_WIDTHS, LOSS_LIMIT, TOP_SHARE = 0.15, (3, 80), 0.35, 0.75
MOST_GRID = 20_000
#: Samples and curves that a task holds as Python values at a time.
SAMPLES_AT_ONCE, CURVES_AT_ONCE = 1 << 14, 256


def savgol(y: np.ndarray, window: int, order: int) -> np.ndarray:
    """Least-squares polynomial smoothing by an odd window; the ends take the polynomial of the first and last window."""
    half = window // 2
    powers = np.vander(np.arange(-half, half + 1), order + 1, increasing=True)
    fit = np.linalg.pinv(powers)
    out = np.convolve(y, fit[0][::-1], "valid")
    head, tail = powers[:half] @ (fit @ y[:window]), powers[half + 1 :] @ (fit @ y[-window:])
    return np.concatenate([head, out, tail])


def smooth(y: np.ndarray, window: int, order: int) -> np.ndarray:
    """savgol with a window made odd and cut to the curve; a curve shorter than the asked window or order + 2: unchanged."""
    y = np.asarray(y, float)
    fitting = min(window | 1, len(y) - 1 + len(y) % 2)
    return y.copy() if len(y) < max(window, order + 2) or fitting <= order else savgol(y, fitting, order)


def _windows(y: np.ndarray, size: int) -> np.ndarray:
    half = size // 2
    return np.lib.stride_tricks.sliding_window_view(np.pad(y, (half, size - 1 - half), "symmetric"), size)


def percentile_filter(y: np.ndarray, percentile: float, size: int) -> np.ndarray:
    """Running order statistic with reflected edges."""
    size = max(1, min(size, 2 * len(y) - 1))
    k = min(size - 1, int(size * percentile / 100.0))
    return np.partition(_windows(np.asarray(y, float), size), k, axis=1)[:, k]


def gaussian_filter(y: np.ndarray, sigma: float) -> np.ndarray:
    if sigma <= 0:
        return np.asarray(y, float).copy()
    reach = int(4 * sigma + 0.5)
    weight = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    wide, n = np.asarray(y, float), len(y)
    at = np.arange(-reach, n + reach) % (2 * n)
    return np.convolve(wide[np.where(at < n, at, 2 * n - 1 - at)], weight / weight.sum(), "valid")


def maxima(y: np.ndarray) -> np.ndarray:
    """Middles of the flat tops that are higher than both sides."""
    if len(y) < 3:
        return np.zeros(0, int)
    starts = np.flatnonzero(np.append(True, np.diff(y) != 0))
    ends = np.append(starts[1:], len(y)) - 1
    level = y[starts]
    top = np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])) + 1
    return (starts[top] + ends[top]) // 2


def prominences(y: np.ndarray, peaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Height over the higher of the two lowest points that lie before higher ground, and those points."""
    out, left, right = np.zeros(len(peaks)), np.zeros(len(peaks), int), np.zeros(len(peaks), int)
    for j, p in enumerate(peaks):
        higher = np.flatnonzero(y > y[p])
        a = higher[higher < p].max(initial=-1) + 1
        b = higher[higher > p].min(initial=len(y))
        left[j] = p - int(np.argmin(y[a : p + 1][::-1]))
        right[j] = p + int(np.argmin(y[p:b]))
        out[j] = y[p] - max(y[left[j]], y[right[j]])
    return out, left, right


def widths(y: np.ndarray, peaks: np.ndarray, prominence: np.ndarray, left: np.ndarray, right: np.ndarray, relative: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Width in samples at a share of the prominence below the top, by linear interpolation, and where it begins."""
    out, begins = np.zeros(len(peaks)), np.zeros(len(peaks))
    for j, p in enumerate(peaks):
        level = y[p] - prominence[j] * relative
        before, after = y[left[j] : p + 1][::-1] <= level, y[p : right[j] + 1] <= level
        a = p - (int(before.argmax()) if before.any() else p - left[j])
        b = p + (int(after.argmax()) if after.any() else right[j] - p)
        lo = a + (level - y[a]) / (y[a + 1] - y[a]) if y[a] < level else a
        hi = b - (level - y[b]) / (y[b - 1] - y[b]) if y[b] < level else b
        out[j], begins[j] = hi - lo, lo
    return out, begins


def find_peaks(y: np.ndarray, prominence: float, distance: float = 1) -> tuple[np.ndarray, np.ndarray]:
    """Peaks and prominences: of two nearer than `distance` the lower goes, then those under the prominence."""
    peaks = maxima(y)
    if distance > 1 and len(peaks):
        keep = np.ones(len(peaks), bool)
        for j in np.argsort(y[peaks], kind="stable")[::-1]:
            if keep[j]:
                near = np.abs(peaks - peaks[j]) < distance
                near[j] = False
                keep[near] = False
        peaks = peaks[keep]
    prom = prominences(y, peaks)[0]
    good = prom >= prominence
    return peaks[good], prom[good]


def detect_peaks(x: np.ndarray, y: np.ndarray) -> list[tuple[float, float, float, float]]:
    """(two_theta, rel_height, prominence, height) of at most MOST_PEAKS peaks by prominence, in order of two_theta.

    rel_height and prominence are shares of the curve's range, rel_height from its lowest sample on.
    """
    span = float(np.ptp(y)) if len(y) else 0.0
    if span <= 0:
        return []
    step = float(np.median(np.diff(x)))
    peaks, prom = find_peaks(y, PEAK_SHARE * span, max(1, int(PEAK_APART / max(step, 1e-6))))
    best = np.sort(np.lexsort((peaks, -prom))[:MOST_PEAKS])
    low = float(y.min())
    return [(round(float(x[p]), 3), round((float(y[p]) - low) / span, 4), round(float(h) / span, 4), float(y[p])) for p, h in zip(peaks[best], prom[best])]


def asls(y: np.ndarray, stiffness: float = 1e7, asymmetry: float = 0.01, rounds: int = 10) -> np.ndarray:
    """Asymmetric least-squares baselines of curves of one length (the last axis); each round solves five diagonals for all
    curves at once. Under three samples: zeros. Samples on the baseline count as below it."""
    y = np.asarray(y, float)
    n = y.shape[-1]
    if n < 3:
        return np.zeros_like(y)
    bend = np.zeros((3, n))  # diagonals 0, 1 and 2 of the squared second differences
    second = (1.0, -2.0, 1.0)
    for diagonal in range(3):
        for i in range(3 - diagonal):
            bend[diagonal, i : i + n - 2] += second[i] * second[i + diagonal]
    weight = np.ones_like(y)
    for _ in range(rounds):
        base = solve_five(weight + stiffness * bend[0], stiffness * bend[1], stiffness * bend[2], weight * y)
        weight = np.where(y > base, asymmetry, 1 - asymmetry)
    return base


def solve_five(main: np.ndarray, near: np.ndarray, far: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Solves symmetric positive definite systems of five diagonals along the last axis (near[i] and far[i] couple i with
    i + 1 and i + 2) by their factors, a step over all systems at a time."""
    n = main.shape[-1]
    at = lambda v: np.moveaxis(np.broadcast_to(v, main.shape), -1, 0).tolist() if main.ndim == 1 else np.ascontiguousarray(np.moveaxis(np.broadcast_to(v, main.shape), -1, 0))
    main, near, far, rhs = at(main), at(near), at(far), at(rhs)
    d, e, f, v = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(n):
        pivot, side, value = main[i], near[i], rhs[i]
        if i:
            pivot = pivot - e[i - 1] * e[i - 1] * d[i - 1]
            side = side - f[i - 1] * d[i - 1] * e[i - 1]
            value = value - e[i - 1] * v[i - 1]
        if i > 1:
            pivot = pivot - f[i - 2] * f[i - 2] * d[i - 2]
            value = value - f[i - 2] * v[i - 2]
        d[i], e[i], f[i], v[i] = pivot, side / pivot, far[i] / pivot, value
    out = [0.0] * n
    for i in range(n - 1, -1, -1):
        value = v[i] / d[i]
        if i < n - 1:
            value = value - e[i] * out[i + 1]
        if i < n - 2:
            value = value - f[i] * out[i + 2]
        out[i] = value
    return np.moveaxis(np.array(out), 0, -1)


def asls_many(ys: list[np.ndarray], **settings) -> list[np.ndarray]:
    """asls of curves of any lengths, those of one length together, about a million samples at a time."""
    out: list = [None] * len(ys)
    by_length: dict[int, list[int]] = {}
    for i, y in enumerate(ys):
        by_length.setdefault(len(y), []).append(i)
    for n, which in by_length.items():
        some = max(1, (1 << 20) // max(n, 1))
        for a in range(0, len(which), some):
            part = which[a : a + some]
            for i, base in zip(part, asls(np.stack([ys[i] for i in part]), **settings) if len(part) > 1 else [asls(ys[part[0]], **settings)]):
                out[i] = base
    return out


def interpolate(x: np.ndarray, y: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    """The curve on a grid of a step from its lowest x. The grid may pass the highest x by less than a step, and there holds
    the last value; one of more than MOST_GRID points gives way to MOST_GRID even points."""
    if not len(x):
        return np.zeros(0), np.zeros(0)
    order = np.argsort(x, kind="stable")
    x, y = np.asarray(x, float)[order], np.asarray(y, float)[order]
    count = np.ceil((x[-1] + step - x[0]) / step)
    grid = np.linspace(x[0], x[-1], MOST_GRID) if count > MOST_GRID else x[0] + step * np.arange(int(count))
    return grid, np.interp(grid, x, y)


def process_curve(x: np.ndarray, y: np.ndarray, base: np.ndarray, step: float = 0.02, window: int = 11, order: int = 3, scale: float = 1.0) -> tuple[np.ndarray, np.ndarray, list[tuple[float, float]]]:
    """Baseline off, zero at the 5th percentile, scaled to 100, resampled, smoothed, scaled again; its highest peaks. What
    is left under 1 at most is no signal: zeros on the grid, no peaks."""
    rest = np.asarray(y, float) - base
    rest = np.maximum(rest - np.percentile(rest, 5), 0) if len(rest) else rest
    top = float(rest.max(initial=0.0))
    flat = len(rest) > 0 and top < 1
    grid, v = interpolate(x, 0 * rest if flat or top <= 0 else 100 * rest / top, step)
    if flat or not len(rest):
        return grid, v, []
    v = np.maximum(smooth(v, window, order), 0)
    v = v * (100 / v.max()) if v.max() > 0 else v
    return grid, v, pick_peaks(grid, v, scale)


def pick_peaks(x: np.ndarray, y: np.ndarray, scale: float = 1.0, most: int = 8) -> list[tuple[float, float]]:
    """(position, height) of the highest peaks, heights of two decimals, by a parabola through three samples where it bends
    down and its top lies within a sample."""
    if not len(y):
        return []
    peaks, _ = find_peaks(y, max(0.5, max(2.5, 0.08 * float(np.nanmax(y))) * max(0.05, scale)), max(1, len(y) // 20))
    out = []
    for p in peaks:
        a, b, c = (float(v) for v in y[p - 1 : p + 2])
        bend = a - 2 * b + c
        shift = 0.5 * (a - c) / bend if bend < 0 else 0.0
        shift = shift if abs(shift) <= 1 else 0.0
        side = x[p + 1] - x[p] if shift >= 0 else x[p] - x[p - 1]
        out.append((float(x[p] + shift * side), round(b - 0.25 * (a - c) * shift, 2)))
    return sorted(out, key=lambda t: -t[1])[:most]


def first_peak(x: np.ndarray, y: np.ndarray) -> dict | None:
    """Lowest-angle Bragg peak: status, two_theta, snr, fwhm; None where the curve is too short or its x doesn't rise.

    Candidates are peaks of a 0.10 degree smoothing that persist within 0.12 degrees in those of 0.30 and 0.60. On the raw
    curve they have to stand out of the noise (over a wide running percentile), have prominence and a plausible width. One
    whose left flank runs into the window's start, and a curve that opens on a descent, are signs that the true first peak
    may lie outside: they lower a peak found to low_confidence, and name the status where there is none.
    """
    n = len(y)
    step = float(np.median(np.diff(x))) if n >= 60 else 0.0
    odd = lambda degrees: max(5, int(degrees / step)) | 1
    if step <= 0 or odd(NOISE_DEGREES) >= n:
        return None
    span = float(np.ptp(y))
    if span <= 0:
        return {"status": "no_bragg_peak"}
    residual = y - savgol(y, odd(NOISE_DEGREES), 2)
    sigma = max(1.4826 * float(np.median(np.abs(residual - np.median(residual)))), 1e-3 * span)

    def candidates(degrees: float) -> np.ndarray:
        if odd(degrees) >= n:
            return np.zeros(0, int)
        return find_peaks(savgol(y, odd(degrees), 2), max(2 * sigma, 0.005 * span), max(1, int(PEAK_APART / step)))[0]

    fine, *coarse = (candidates(s) for s in SCALES)
    lasting = np.ones(len(fine), bool)
    for other in coarse:
        lasting &= (np.abs(x[fine][:, None] - x[other]) <= PERSIST_DEGREES).any(1)
    peaks = fine[lasting]
    base = percentile_filter(y, 10, min(odd(BASE_DEGREES), n - 1 + n % 2))
    prom, left, right = prominences(y, peaks)
    width, begins = widths(y, peaks, prom, left, right)
    snr, fwhm = (y[peaks] - base[peaks]) / sigma, width * step
    bragg = (snr >= SNR_LOW) & (prom >= max(3 * sigma, 0.02 * span)) & (fwhm >= FWHM_RANGE[0]) & (fwhm <= FWHM_RANGE[1])
    cut = bragg & ((x[peaks] - x[0] < EDGE_DEGREES) | (begins <= 2))

    near = max(3, int(0.30 / step))
    start = int(np.argmax(y[:near]))
    fall = float(y[start] - y[start : max(near + 1, int(1.0 / step))].min())
    opens_falling = start <= 2 and fall > max(SNR_OK * sigma, 0.08 * span) and y[start] > y.min() + 0.30 * span
    truncated = bool(opens_falling or cut.any())
    whole = np.flatnonzero(bragg & ~cut)
    if not len(whole):
        return {"status": "truncated_at_window_start" if truncated else "no_bragg_peak"}
    j = whole[0]
    return {"status": "low_confidence" if truncated or snr[j] < SNR_OK else "ok", "two_theta": float(x[peaks[j]]), "snr": float(snr[j]), "fwhm": float(fwhm[j])}


def with_spacing(found: dict, wavelength: float | None) -> dict:
    """A first peak as it is written: with its spacing, the wavelength used and whether that was assumed (both only where there
    is a peak), d and fwhm of three decimals, snr of one."""
    t = found.get("two_theta")
    if t is None:
        return found | {"two_theta": None, "snr": None, "fwhm": None, "d": None, "wavelength": None, "assumed": None}
    given = wavelength is not None and WAVELENGTHS[0] < wavelength < WAVELENGTHS[1]
    used = wavelength if given else WAVELENGTH
    d = used / (2 * np.sin(np.radians(t / 2)))
    return found | {"snr": round(found["snr"], 1), "fwhm": round(found["fwhm"], 3), "d": round(float(d), 3), "wavelength": used, "assumed": int(not given)}


def descriptors(x: np.ndarray, y: np.ndarray, peak: float | None = None, fwhm: float | None = None) -> dict:
    """Crystalline fraction, the hump between 15 and 35 degrees over a chord, and the ratio of the first peak to it.

    Heights are in the curve's own units. Each value is None where the curve is too short, the window is not covered, or no
    hump stands; the width also where it runs into the window's end.
    """
    names = ("crystalline_fraction", "hump_center", "hump_fwhm", "hump_height", "intensity_ratio_100_001")
    out: dict = dict.fromkeys(names) | {"hump_window_covered": 0}
    if len(x) < 2:
        return out
    step = max(float(np.median(np.diff(x))), 1e-3)
    grid = x[0] + step * np.arange(int(np.ceil((x[-1] + step / 2 - x[0]) / step)))
    v = np.interp(grid, x, y)
    if len(grid) < 50:
        return out
    size = max(round(FRACTION_BASE_DEGREES / step) | 1, 21)
    above = np.maximum(v - gaussian_filter(percentile_filter(v, 10, min(size, len(v))), max(size / 6, 1.0)), 0)
    total = float((v - v.min()).sum())
    if total > 0:
        out["crystalline_fraction"] = round(float(above.sum()) / total, 4)

    low, high = max(HUMP_WINDOW[0], grid[0]), min(HUMP_WINDOW[1], grid[-1])
    if high - low < HUMP_SPAN:
        return out
    out["hump_window_covered"] = 1
    inside = (grid >= low) & (grid <= high)
    gx, raw, soft = grid[inside], v[inside], gaussian_filter(v, HUMP_SIGMA / step)[inside]
    edge = max(round(1.0 / step), 3)
    chord = np.interp(gx, gx[[0, -1]], [np.percentile(soft[:edge], 10), np.percentile(soft[-edge:], 10)])
    rise = np.maximum(soft - chord, 0)
    free = (gx >= low + 0.5) & (gx <= high - 0.5)
    if peak is not None:
        free &= np.abs(gx - peak) > max(MASK_DEGREES, 3 * (fwhm or 0.0))
    where = np.flatnonzero(free)
    if len(where) < 10:
        return out
    top = int(where[np.argmax(rise[where])])
    masked = top == where[0] and rise[max(top - 1, 0)] > rise[top] or top == where[-1] and rise[min(top + 1, len(rise) - 1)] > rise[top]
    if rise[top] < HUMP_LEAST or masked:  # the true maximum is masked out
        return out
    under = rise <= rise[top] / 2
    a = int(np.flatnonzero(under[:top]).max(initial=0))
    b = top + int(under[top:].argmax()) if under[top:].any() else len(gx) - 1
    center = float(gx[top])
    out["hump_center"] = round(center, 3)
    if a > 0 and b < len(gx) - 1:
        out["hump_fwhm"] = round(float(gx[b] - gx[a]), 3)
    height = float(np.maximum(raw - chord, 0)[np.abs(gx - center) <= 0.5].max(initial=0.0))
    if height > 0:
        out["hump_height"] = round(height, 4)
        first = float(above[np.abs(grid - peak) <= HEIGHT_DEGREES].max(initial=0.0)) if peak is not None else 0.0
        out["intensity_ratio_100_001"] = round(first / height, 3) if first > 0 else None
    return out


def shape_verdict(y: np.ndarray) -> dict:
    """Counts of drawn artefacts on the min-max scaled curve, and whether they condemn it (with the reasons)."""
    y = np.asarray(y, float)
    y = y[np.isfinite(y)]
    if len(y) < 60 or np.ptp(y) <= 0:
        return {"flagged": True, "reasons": "degenerate", "steps": None, "notches": None, "rev_frac": None, "tv": None}
    z = (y - y.min()) / np.ptp(y)
    std = np.lib.stride_tricks.sliding_window_view(z, FLAT_WIDTH).std(1)
    ends = np.flatnonzero(np.diff(np.concatenate([[0], (std < FLAT_STD).astype(int), [0]])))
    runs = [(a, b + FLAT_WIDTH - 1) for a, b in zip(ends[::2], ends[1::2]) if b - a + FLAT_WIDTH - 1 >= FLAT_LEAST]
    levels = [float(z[a:b].mean()) for a, b in runs]
    steps = sum(q[0] - p[1] <= STEP_GAP and abs(m - k) > STEP_RISE for p, q, k, m in zip(runs, runs[1:], levels, levels[1:]))
    r = NOTCH_REACH
    deep = (z[: -2 * r] - z[r:-r] > NOTCH_DEPTH) & (z[2 * r :] - z[r:-r] > NOTCH_DEPTH)
    notches, free = 0, 0
    for i in np.flatnonzero(deep):
        if i >= free:
            notches, free = notches + 1, i + r
    d = np.diff(z)
    turns = (d[1:] * d[:-1] < 0) & (np.minimum(np.abs(d[1:]), np.abs(d[:-1])) > REVERSAL_AMPLITUDE)
    rev, tv = float(turns.mean()), float(np.abs(d).sum())
    why = [(steps > MOST_STEPS, f"steps={steps}"), (notches > MOST_NOTCHES, f"notches={notches}"), (rev > MOST_REVERSALS, f"sawtooth={rev:.3f}"), (tv > MOST_VARIATION, f"tv={tv:.1f}")]
    reasons = ";".join(text for bad, text in why if bad)
    return {"flagged": bool(reasons), "reasons": reasons, "steps": int(steps), "notches": notches, "rev_frac": rev, "tv": tv}


def scaled_profile(v: np.ndarray, known: np.ndarray) -> np.ndarray:
    """A profile from its 5th (0) to its 99.5th percentile (1), cut to 0 and 1.3; NaN where unknown, or flat."""
    low, high = np.percentile(v[known], (5, 99.5)) if known.any() else (0.0, 0.0)
    scaled = np.clip((v - low) / (high - low), 0, 1.3) if high > low else np.full(len(v), np.nan)
    return np.where(known, scaled, np.nan)


def local_prominence(v: np.ndarray, p: int, reach: int) -> float:
    """Highest value within four samples over the lowest within `reach`."""
    top, base = v[max(0, p - 4) : p + 5], v[max(0, p - reach) : p + reach]
    return float(np.nanmax(top) - np.nanmin(base)) if not (np.isnan(top).all() or np.isnan(base).all()) else 0.0


def profile_losses(source: np.ndarray, other: np.ndarray, inner: np.ndarray) -> list[tuple[int, float, float]]:
    """(place, local prominence in source, in other) of the peaks of source at inner places. Peaks whose top is about as wide
    as their middle are drawn bars and do not count."""
    filled = np.where(np.isnan(source), 0, source)
    peaks, _ = find_peaks(filled, PROFILE_PROMINENCE)
    prom, left, right = prominences(filled, peaks)
    half, top = (widths(filled, peaks, prom, left, right, r)[0] for r in (0.5, 0.1))
    rows = []
    for p, w, t in zip(peaks.tolist(), half, top):
        if inner[p] and PROFILE_WIDTHS[0] <= w <= PROFILE_WIDTHS[1] and t <= TOP_SHARE * w:
            reach = int(max(8, 1.5 * w))
            here = local_prominence(source, p, reach)
            if here >= PROFILE_PROMINENCE:
                rows.append((p, round(here, 3), round(local_prominence(other, p, reach), 3)))
    return rows


def peak_fidelity(drawn: np.ndarray, traced: np.ndarray) -> dict:
    """How much of the drawn profile's peaks the traced one lost, and gained elsewhere; both by column, NaN where unknown."""
    known = ~np.isnan(drawn) & ~np.isnan(traced)
    out: dict = {"status": "little_overlap", "n_peaks": None, "worst_loss": None, "worst_gain": None, "ratio_distortion_log2": None, "flagged": None}
    if known.sum() < 0.3 * len(drawn):
        return out
    middle = np.median(drawn[known])
    if np.mean(np.abs(drawn[known] - middle) <= 1.5) > 0.6:
        return out | {"status": "env_occluded"}
    seen = np.flatnonzero(~np.isnan(traced))
    inner = known & (np.arange(len(drawn)) >= seen[0] + 10) & (np.arange(len(drawn)) <= seen[-1] - 10)
    a, b = scaled_profile(drawn, known), scaled_profile(traced, known)
    peaks = profile_losses(a, b, inner)
    loss = max([0.0, *(e - t for _, e, t in peaks)])
    gain = max([0.0, *(t - e for _, t, e in profile_losses(b, a, inner))])
    ratio = None
    if len(peaks) >= 2:
        (_, e1, t1), (_, e2, t2) = sorted(peaks, key=lambda r: -r[1])[:2]
        t1, t2 = max(t1, 1e-3), max(t2, 1e-3)
        if e1 > 0.2 and e2 > 0.1 and t1 > 0.02:
            ratio = round(abs(float(np.log2(t2 / t1 * e1 / e2))), 3)
    return {"status": "ok", "n_peaks": len(peaks), "worst_loss": round(loss, 3), "worst_gain": round(gain, 3), "ratio_distortion_log2": ratio, "flagged": bool(max(loss, gain) >= LOSS_LIMIT)}


def amputated(y: np.ndarray) -> np.ndarray:
    """A positive control: the curve with its highest peak, 25 samples to each side, cut to three tenths over the 20th percentile."""
    y = np.array(y, float)
    top, base = int(np.argmax(y)), np.percentile(y, 20)
    part = slice(max(0, top - 25), top + 25)
    y[part] = base + 0.30 * (y[part] - base)
    return y


Kernel = Callable[[np.ndarray, np.ndarray], list[tuple]]


def per_curve(curves: DataFrame, key: str, x: str | Callable[[int], np.ndarray], y: str, kernel: Kernel | None, schema: str, *more: str, many: Callable | None = None) -> DataFrame:
    """Runs kernel(x, y, *more) -> list of tuples once for each row of curves held as arrays: (key, *tuple), in Arrow batches
    without a shuffle. x is an array column, or a function that gives the x of n samples. Samples without x or y go, the
    others come in order of x. `many` takes lists of all a slice's arguments instead. A kernel that yields nothing drops the row.
    Batches are cut into slices of at most CURVES_AT_ONCE curves and SAMPLES_AT_ONCE samples, or one longer curve, since results
    are Python tuples until they are Arrow again.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [key, *([x] if isinstance(x, str) else []), y, *more]
    rows = curves.select(*names)
    fields = to_arrow_schema(StructType([StructField(key, rows.schema[key].dataType), *StructType.fromDDL(schema).fields]))

    def arrays(column: pa.Array) -> list[np.ndarray]:
        ends = np.asarray(column.offsets)
        flat = column.values.slice(ends[0], ends[-1] - ends[0])
        flat, ends = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), float), ends - ends[0]
        return [flat[a:b] if ok else flat[:0] for a, b, ok in zip(ends[:-1], ends[1:], column.is_valid().to_pylist())]

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ends, at = np.asarray(batch.column(y).offsets), 0
        while at < batch.num_rows:
            end = int(np.searchsorted(ends, ends[at] + SAMPLES_AT_ONCE, "right")) - 1
            end = min(max(end, at + 1), at + CURVES_AT_ONCE, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            ys = arrays(batch.column(y))
            xs = arrays(batch.column(x)) if isinstance(x, str) else [x(len(v)) for v in ys]
            for i, (u, v) in enumerate(zip(xs, ys)):
                good = ~(np.isnan(u) | np.isnan(v))
                if not good.all():
                    u, v = u[good], v[good]
                if (u[1:] < u[:-1]).any():
                    order = np.argsort(u, kind="stable")
                    u, v = u[order], v[order]
                xs[i], ys[i] = u, v
            rest = [batch.column(c).to_pylist() for c in more]
            done = many(xs, ys, *rest) if many else [kernel(*a) for a in zip(xs, ys, *rest)]
            keys = [k for k, d in zip(batch.column(key).to_pylist(), done) for _ in d]
            columns = list(zip(*(t for d in done for t in d))) if keys else [[]] * (len(fields) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([keys, *columns], fields)], schema=fields)

    return rows.mapInArrow(run, StructType([StructField(key, rows.schema[key].dataType), *StructType.fromDDL(schema).fields]))


def gathered(points: DataFrame, series: str, x: str, y: str) -> DataFrame:
    """Curves (series, x, y as arrays) of points that come as rows: one shuffle on the series."""
    both = points.select(series, F.col(x).cast(DoubleType()).alias("x"), F.col(y).cast(DoubleType()).alias("y")).where("x is not null and y is not null")
    held = both.groupBy(series).agg(F.collect_list(F.struct("x", "y")).alias("p"))
    return held.select(series, F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def per_series(points: DataFrame, series: str, x: str, y: str, kernel: Kernel, schema: str) -> DataFrame:
    """per_curve of points that come as rows."""
    return per_curve(gathered(points, series, x, y), series, "x", "y", kernel, schema)


def suppress_boxes(boxes: np.ndarray, limit: float = 0.68) -> list[int]:
    """Boxes (x0, y0, x1, y1) in order that overlap no kept one by more than a limit."""
    kept: list[int] = []
    for i, b in enumerate(boxes):
        for k in kept:
            a = boxes[k]
            w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
            common = max(0.0, w) * max(0.0, h)
            union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - common
            if union > 0 and common / union > limit:
                break
        else:
            kept.append(i)
    return kept
