"""The query API: validated parameters, declarative filters, orders with unique ends, pages with totals."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import physics, text
from ridgeline.functions import vocabulary as V


class BadParameter(ValueError):
    """A request that names an unknown parameter or gives a value out of its bounds."""


class Params:
    """Parameters of a request. Every read is checked; `done` refuses names that nobody read."""

    def __init__(self, given: dict[str, object]):
        self.given, self.read = given, set()

    def _raw(self, name: str):
        self.read.add(name)
        return self.given.get(name)

    def text(self, name: str, longest: int = 200) -> str | None:
        v = self._raw(name)
        if v is None or str(v).strip() == "":
            return None
        if len(str(v)) > longest:
            raise BadParameter(f"{name} is longer than {longest} characters")
        return str(v).strip()

    def number(self, name: str, low: float, high: float, default: float | None = None, whole: bool = False):
        v = self._raw(name)
        if v is None or v == "":
            return default
        try:
            x = float(str(v))
        except ValueError as e:
            raise BadParameter(f"{name} must be a number") from e
        if not low <= x <= high or whole and x != int(x):
            raise BadParameter(f"{name} must be {'a whole number ' if whole else ''}from {low} to {high}")
        return int(x) if whole else x

    def flag(self, name: str, default: bool) -> bool:
        v = self._raw(name)
        if v is None or v == "":
            return default
        if str(v).lower() not in ("true", "false", "1", "0"):
            raise BadParameter(f"{name} must be true or false")
        return str(v).lower() in ("true", "1")

    def choice(self, name: str, allowed: list[str], default: str | None = None) -> str | None:
        v = self.text(name) or default
        if v is not None and v not in allowed:
            raise BadParameter(f"{name} must be one of {', '.join(allowed)}")
        return v

    def subset(self, name: str, allowed: list[str]) -> list[str] | None:
        v = self.text(name)
        if v is None:
            return None
        parts = [p.strip() for p in v.split(",") if p.strip()]
        if bad := [p for p in parts if p not in allowed]:
            raise BadParameter(f"{name}: unknown {', '.join(bad)}; allowed: {', '.join(allowed)}")
        return parts

    def identifier(self, name: str) -> str | None:
        v = self.text(name)
        if v is not None and not re.fullmatch(V.IDENTIFIER, v):
            raise BadParameter(f"{name} is no identifier")
        return v

    def interval(self, low: str, high: str, least: float, most: float) -> tuple[float | None, float | None]:
        a, b = self.number(low, least, most), self.number(high, least, most)
        if a is not None and b is not None and a > b:
            raise BadParameter(f"{low} is above {high}")
        return a, b

    def done(self) -> None:
        if bad := sorted(set(self.given) - self.read):
            raise BadParameter(f"unknown parameters {', '.join(bad)}; allowed: {', '.join(sorted(self.read))}")


@dataclass
class Page:
    """A page of an ordered result. `rows` stays lazy; `total` is a second job, as the API's exact count is."""

    found: DataFrame
    order: list[Column]
    limit: int
    offset: int

    @property
    def rows(self) -> DataFrame:
        return self.found.orderBy(*self.order).offset(self.offset).limit(self.limit)

    def total(self) -> int:
        return self.found.count()

    def next_offset(self, total: int) -> int | None:
        end = self.offset + min(self.limit, max(0, total - self.offset))
        return end if end < total else None


def within(c: Column, low: float | None, high: float | None) -> Column:
    """Inclusive bounds; a null never matches a bound that is given."""
    parts = [c >= low] * (low is not None) + [c <= high] * (high is not None)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def contains(q: str | None, *columns: str) -> Column:
    return F.lit(True) if q is None else reduce(lambda a, b: a | b, [F.col(c).ilike(text.like_pattern(q)) for c in columns])


def _paged(p: Params, found: DataFrame, order: list[Column]) -> Page:
    limit, offset = p.number("limit", 1, 1000, 100, True), p.number("offset", 0, 1_000_000, 0, True)
    p.done()
    return Page(found, order, limit, offset)


def papers(index: DataFrame, **given) -> Page:
    """Papers of an index (paper_id, paper_number, title, doi, authors, journal, year, publication_status, clean_curve_count, curve_count)."""
    p = Params(given)
    q, year, journal, status = p.text("q"), p.number("year", 1800, 2200, None, True), p.text("journal"), p.text("publication_status")
    low, high = p.interval("year_min", "year_max", 1800, 2200)
    found = index.where(contains(q, "title", "doi", "authors")).where(within(F.col("year"), low, high))
    found = found.where(F.lit(True) if year is None else F.col("year") == year).where(F.lit(True) if journal is None else F.col("journal") == journal)
    found = found.where(F.lit(True) if status is None else F.col("publication_status") == status)
    if not p.flag("include_readmitted", True):
        found = found.where("clean_curve_count > 0")
    orders = {"paper_number": F.col("paper_number").asc_nulls_last(), "year": F.col("year").asc_nulls_last(), "-year": F.col("year").desc_nulls_last(), "-curves": F.col("curve_count").desc_nulls_last()}
    return _paged(p, found, [orders[p.choice("sort", list(orders), "paper_number")], F.col("paper_id").asc()])


def curves(rows: DataFrame, **given) -> Page:
    """Curves by paper, figure, material, group, role, admission classes, first peak and statuses."""
    p = Params(given)
    low, high = p.interval("first_peak_min", "first_peak_max", 0, 180)
    found = rows.where(within(F.col("first_peak"), low, high)).where(contains(p.text("material"), "material"))
    for name in ("paper_id", "figure_id", "material_group"):
        if (v := p.identifier(name)) is not None:
            found = found.where(F.col(name) == v)
    for name in ("role", "stacking_hump_status", "axis_verification"):
        if (v := p.text(name)) is not None:
            found = found.where(F.col(name) == v)
    for name, allowed in (("admission", ["clean", "axis_verified", "shape_flagged", "axis_unconfirmed", "model_derived"]), ("first_peak_status", ["ok", "low_confidence", "truncated_at_window_start", "no_bragg_peak"])):
        if (v := p.subset(name, allowed)) is not None:
            found = found.where(F.col(name).isin(v))
    orders = {"series_id": F.col("series_id").asc(), "first_peak": F.col("first_peak").asc_nulls_last(), "-first_peak": F.col("first_peak").desc_nulls_last()}
    return _paged(p, found, [orders[p.choice("sort", list(orders), "series_id")], F.col("series_id").asc()])


def materials(groups: DataFrame, **given) -> Page:
    """Label groups by normalised key; an exact match shows whatever its specificity."""
    p = Params(given)
    q, kind = p.text("q"), p.choice("specificity", ["specific", "all"], "specific")
    found = groups
    if q is not None:
        key = text.label_key(F.lit(q))
        found = found.where(F.contains("key", key)).withColumn("exact_match", F.col("key") == key)
    else:
        found = found.withColumn("exact_match", F.lit(False))
    if kind == "specific":
        found = found.where((F.col("specificity") == "specific") | F.col("exact_match"))
    orders = {"-papers": F.col("paper_count").desc(), "-curves": F.col("curve_count").desc(), "name": F.lower("display_name").asc()}
    return _paged(p, found, [orders[p.choice("sort", list(orders), "-papers")], F.col("key").asc()])


def first_peak_search(rows: DataFrame, target: float, tolerance: float, unit: str = "two_theta", disputed: list[str] | None = None) -> DataFrame:
    """Papers with curves whose first peak lies near a target, by an exact predicate with each curve's own uncertainty."""
    if unit == "d":
        target = 2 * math.degrees(math.asin(min(1.0, physics.WAVELENGTH / (2 * target))))
    near = rows.where(F.abs(F.col("first_peak") - target) <= F.greatest(F.lit(tolerance), F.coalesce("uncertainty", F.lit(0.0))))
    return near.groupBy("paper_id").agg(F.count(F.lit(1)).alias("matches"), F.count_if(F.col("axis_verification").isin(disputed or ["axis_arbitrated"])).alias("disputed"))


#: Units that travel with a curve's points.
UNITS = {"two_theta_deg": "degrees of two theta, from the figure's calibrated axis", "relative_intensity": "scaled for each curve to a highest value near 100; not comparable between curves"}


def curve_data(curves: DataFrame, points: DataFrame, **given) -> DataFrame:
    """The points of one curve: as `json`, one row with both axes as arrays, their count and the axis uncertainty; as `csv`, the
    lines of a file in order (n, line). points need the columns series_id, two_theta_deg and relative_intensity, and hold them as
    published; a curve without points gives no row."""
    p = Params(given)
    series, kind = p.identifier("series_id"), p.choice("format", ["json", "csv"], "json")
    p.done()
    if series is None:
        raise BadParameter("series_id is missing")
    if lacking := [c for c in ("series_id", "two_theta_deg", "relative_intensity") if c not in points.columns]:
        raise BadParameter(f"the data have no {', '.join(lacking)}")
    own = points.where(F.col("series_id") == series).select("two_theta_deg", "relative_intensity")
    held = own.agg(F.array_sort(F.collect_list(F.struct("two_theta_deg", "relative_intensity"))).alias("p")).where(F.size("p") > 0)  # one curve
    if kind == "csv":
        lines = F.concat(F.array(F.lit("two_theta_deg,relative_intensity")), F.transform("p", lambda r: F.concat_ws(",", r["two_theta_deg"].cast("string"), r["relative_intensity"].cast("string"))))
        return held.select(F.posexplode(lines).alias("n", "line"))
    one = curves.where(F.col("series_id") == series).select(F.col("uncertainty").alias("two_theta_uncertainty_deg")).limit(1)
    shaped = held.select(F.lit(series).alias("series_id"), F.size("p").alias("point_count"), F.col("p.two_theta_deg").alias("two_theta_deg"), F.col("p.relative_intensity").alias("relative_intensity"))
    return shaped.join(one, F.lit(True), "left")


def figure_data(curves: DataFrame, **given) -> DataFrame:
    """Where a figure's data file stands: (figure_id, data_path), no row for an unknown figure or one without a file."""
    p = Params(given)
    figure = p.identifier("figure_id")
    p.done()
    if figure is None:
        raise BadParameter("figure_id is missing")
    return curves.where((F.col("figure_id") == figure) & F.col("data_path").isNotNull() & (F.col("data_path") != "")).select("figure_id", "data_path").orderBy("data_path").limit(1)


def target_angle(entered: Column, unit: str = "two_theta", low: float = 0.1, high: float = 90.0) -> Column:
    """peak_target of a column of numbers: the angle, null where a search would be refused."""
    ratio = physics.WAVELENGTH / (2 * entered)
    angle = F.when(ratio <= 1, 2 * F.degrees(F.asin(ratio))) if unit == "d" else entered
    return F.when((entered > 0) & (angle >= low) & (angle <= high), angle)


def peak_target(entered: str, unit: str = "two_theta", low: float = 0.1, high: float = 90.0) -> float | None:
    """A search box's target as an angle; None for an empty box; BadParameter for what addresses no peak."""
    if not entered.strip():
        return None
    try:
        value = float(entered)
    except ValueError as e:
        raise BadParameter("enter a positive number") from e
    if not math.isfinite(value) or value <= 0:
        raise BadParameter("enter a positive number")
    if unit == "d":
        ratio = physics.WAVELENGTH / (2 * value)
        if ratio > 1:
            raise BadParameter(f"no reflection exists at d = {value} for the assumed wavelength")
        value = 2 * math.degrees(math.asin(ratio))
    if not low <= value <= high:
        raise BadParameter(f"{value:.2f} lies outside {low} to {high} degrees")
    return value


def describe(target: float | None, tolerance: float, entered: float | None = None, low_confidence: bool = False, filters: tuple[str, ...] = ()) -> str:
    """One line that says what a search asked for; a spacing names the wavelength it assumed."""
    parts = []
    if target is not None:
        asked = f"{target:.6g}° 2θ" if entered is None else f"{entered:.6g} Å, that is {target:.3f}° 2θ at an assumed {physics.WAVELENGTH} Å"
        parts = [f"lowest peak near {asked}", f"within {tolerance:g}° or the curve's own axis uncertainty", "peaks of low confidence included" if low_confidence else "sure peaks only"]
    return "; ".join([*parts, *filters])
