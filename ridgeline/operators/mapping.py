"""Scalar mappings: statuses, roles, gates. Null stays apart from every named kind of absence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridgeline.functions import vocabulary as V


def lookup(value: Column, names: dict[str, str], default: str | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    found = F.try_element_at(table, value)
    return found if default is None else F.coalesce(found, F.lit(default))


def admission(kind: Column, reason: Column, table=V.ADMISSION) -> Column:
    """Published class of a (class, reason) pair by a generated chain of cases; null for pairs that the table lacks."""
    empty = F.coalesce(F.trim(reason), F.lit("")) == ""
    fits = lambda pair: (kind == pair[0]) & (empty if pair[1] is None else reason == pair[1])
    return reduce(lambda c, p: c.when(fits(p[0]), p[1]), table, F.when(F.lit(False), F.lit("")))


def verification(status: Column) -> Column:
    return lookup(F.lower(F.trim(status)), dict(V.VERIFICATION), "axis_unverified")


def quality(figure_status: Column, verified: Column) -> tuple[Column, Column]:
    """('pending' or 'flagged', reasons)."""
    why = reasons({"axis_arbitrated": verified == "axis_arbitrated", "series_incomplete": F.lower(F.trim(figure_status)) == "partial"})
    return F.when(F.size(why) > 0, "flagged").otherwise("pending"), why


def role(context: Column, label: Column, state: Column) -> Column:
    """A known context role; else experimental by its state; else by marks in the label, in order; else unclassified."""
    low = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    rules = F.when(context.isin(V.ROLES), context).when(F.lower(F.trim(state)).isin(V.EXPERIMENTAL_STATES), "experimental")
    has = lambda marks: reduce(lambda a, b: a | b, [F.contains(low, F.lit(m)) for m in marks])
    return reduce(lambda c, r: c.when(has(r[1]), r[0]), V.ROLE_MARKS, rules).otherwise("unclassified")


def reasons(rules: dict[str, Column]) -> Column:
    """Names of the rules that hold, in order."""
    return F.filter(F.array(*[F.when(c, n) for n, c in rules.items()]), lambda x: x.isNotNull())


def ratio_band(ratio: Column) -> Column:
    return F.when(ratio <= 1, "low").when((ratio > 1) & (ratio <= 10), "middle").when(ratio > 10, "high")


def hump_status(value: Column, computed: Column, covered: Column, detected: Column) -> Column:
    """Four states, and null where nothing was recorded."""
    return F.when(value.isNull(), F.lit(None).cast("string")).when(~computed, "not_computed").when(~covered, "window_not_covered").when(detected, "hump_detected").otherwise("no_hump_detected")


def wavelength(assumed: Column, reported: Column, default: float = 1.5406) -> Column:
    """struct<wavelength, source, anomaly> of the flag that a default was used (1, 0, null) and a reported value.

    A reported value counts only where the flag says that it was used; every disagreement is named.
    """
    used = F.coalesce((assumed == 0) & reported.isNotNull(), F.lit(False))
    odd = F.when(used | (F.coalesce(assumed == 1, F.lit(False)) & reported.isNull()), F.lit(None)).when(assumed == 1, "stale_paper_wavelength").otherwise("unverifiable_wavelength")
    return F.struct(F.when(used, reported).otherwise(F.lit(default)).alias("wavelength"), F.when(used, "paper_reported").otherwise("assumed_cu_ka").alias("source"), odd.alias("anomaly"))


def bounded(value: Column, kind: str, low: float, high: float) -> Column:
    number = value.try_cast(kind)
    return F.when(number.between(low, high), number)


def one_of(value: Column, names: list[str]) -> Column:
    plain = F.lower(F.trim(value))
    return F.when(plain.isin(names), plain)


def computed(state: Column, label: Column) -> Column:
    """Whether a curve is model-derived: a non-empty state decides alone, else marks in the label and name."""
    s, text = F.lower(F.trim(F.coalesce(state, F.lit("")))), F.lower(F.coalesce(label, F.lit("")))
    has = lambda c, marks: reduce(lambda a, b: a | b, [F.contains(c, F.lit(m)) for m in marks])
    return F.when(s != "", s.isin(V.COMPUTED_WHOLE) | has(s, V.COMPUTED_STATE)).otherwise(has(text, V.COMPUTED_LABEL))


def plausible_fit(slope: Column, intercept: Column, x0: Column, x1: Column) -> Column:
    span = slope * (x1 - x0)
    return (slope * x0 + intercept >= -5) & (slope * x1 + intercept <= 130) & span.between(1.5, 135)


def evidence_reasons(precision: Column, snap: Column, recall: Column, residual: Column) -> Column:
    """Gates that fail; absent evidence passes."""
    one = F.lit(1.0)
    return reasons({"precision": F.coalesce(precision, one) < 0.80, "snap": F.coalesce(snap, one) < 0.80, "recall": F.coalesce(recall, one) < 0.70, "residual": F.coalesce(residual, F.lit(0.0)) > 15})


def acceptance(snap: Column, precision: Column, recall: Column, deviation: Column) -> Column:
    """struct<accepted, confidence>; the gate uses the confidence before rounding to four decimals."""
    c = 0.30 * snap + 0.30 * precision + 0.25 * recall + 0.15 * F.greatest(F.lit(0.0), 1.0 - deviation / 0.25)
    ok = (snap >= 0.55) & (precision >= 0.70) & (recall >= 0.60) & (c >= 0.55)
    return F.struct(ok.alias("accepted"), (F.floor(c * 10000 + 0.5) / 10000).alias("confidence"))
