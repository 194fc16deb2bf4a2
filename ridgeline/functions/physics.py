"""Arithmetic of curves and their axes: expressions from Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Wavelength in angstrom that is assumed where none is reported, and the range a reported one must lie in.
WAVELENGTH = 1.5406
WAVELENGTHS = (0.4, 3.0)


def d_spacing(two_theta: Column, wavelength: Column | float = WAVELENGTH) -> Column:
    """Bragg spacing; null outside (0, 180)."""
    w = F.lit(wavelength) if isinstance(wavelength, float) else wavelength
    return F.when((two_theta > 0) & (two_theta < 180), w / (2.0 * F.sin(F.radians(two_theta / 2.0))))


def two_theta(d: Column, wavelength: Column | float = WAVELENGTH) -> Column:
    """The angle of a spacing; null where no angle exists."""
    w = F.lit(wavelength) if isinstance(wavelength, float) else wavelength
    ratio = F.try_divide(w, 2.0 * d)
    return F.when((d > 0) & (ratio <= 1), 2.0 * F.degrees(F.asin(ratio)))


def tolerance(asked: Column, own: Column) -> Column:
    """Tolerance in [0.02, 1.0], widened to a curve's own uncertainty."""
    return F.greatest(F.least(F.greatest(asked, F.lit(0.02)), F.lit(1.0)), F.coalesce(own, F.lit(0.0)))


def reliability(similarity: Column, ticks: Column, flags: Column) -> Column:
    return F.least(F.greatest(similarity + F.least(F.lit(0.15), 0.03 * ticks) - 0.1 * flags, F.lit(0.0)), F.lit(1.0))


def nice_step(span: Column, count: int) -> Column:
    """The 1-2-5 step that cuts a span into about `count` parts."""
    raw = span / count
    power = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    part = raw / power
    return power * F.when(part < 1.5, 1.0).when(part < 3.5, 2.0).when(part < 7.5, 5.0).otherwise(10.0)


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of boxes (x0, y0, x1, y1); 0 for empty boxes."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return F.coalesce(F.try_divide(w * h, union), F.lit(0.0))


def line_gap(a: tuple[Column, Column], b: tuple[Column, Column], x0: Column, x1: Column) -> Column:
    """Largest distance of two lines (slope, intercept) over [x0, x1]: it is reached at an end."""
    at = lambda x: F.abs((a[0] - b[0]) * x + a[1] - b[1])
    return F.greatest(at(x0), at(x1))


def differences(values: Column) -> Column:
    n = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(2), n), F.slice(values, F.lit(1), n), lambda b, a: b - a)


def median_of(values: Column) -> Column:
    """Median of an array; null if empty."""
    s, n = F.array_sort(values), F.size(values)
    at = lambda i: F.get(s, i.cast("int"))
    return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2.0)


def arithmetic(values: Column, relative: float = 0.08) -> Column:
    """Whether an array's steps differ from their median by at most a share of it."""
    steps = differences(values)
    middle = median_of(steps)
    return (F.size(values) >= 3) & F.forall(steps, lambda d: F.abs(d - middle) <= relative * F.abs(middle))


def delta_to_nearest(reported: Column, extracted: Column) -> Column:
    """Mean over reported values of the distance to the nearest extracted one."""
    near = F.transform(reported, lambda r: F.array_min(F.transform(extracted, lambda e: F.abs(e - r))))
    return F.try_divide(F.aggregate(near, F.lit(0.0), lambda a, x: a + x), F.size(near))


def cost_range(pages: Column, figures: Column, per_page: float, per_figure: float) -> tuple[Column, Column]:
    low = pages * per_page + figures * per_figure
    return low, low * 1.25
