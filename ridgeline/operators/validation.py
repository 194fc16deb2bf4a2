"""Declared invariants as queries for the rows that break them. As in SQL checks, an unknown result passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(rule, key) of each broken rule, in one pass."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(True)), n) for n, c in rules.items()]), lambda x: x.isNotNull())
    return rows.select(F.explode(broken).alias("rule"), F.col(key).alias("key"))


def orphans(child: DataFrame, foreign: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null key no parent has."""
    return child.where(F.col(foreign).isNotNull()).join(parent.select(F.col(key).alias("__key")), F.col(foreign) == F.col("__key"), "left_anti")


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def between(column: str, low: float, high: float, open_low: bool = False, open_high: bool = False) -> Column:
    c = F.col(column)
    return ((c > low) if open_low else (c >= low)) & ((c < high) if open_high else (c <= high))


def paper_rules() -> dict[str, Column]:
    """c1: a paper is unchecked exactly while it has no time of a check."""
    return {"c1": (F.col("status") == "unchecked") == F.col("checked_at").isNull()}


def figure_rules() -> dict[str, Column]:
    """c2: pages count from 1, sizes and residuals are not negative."""
    return {"c2_page": F.col("page") > 0, "c2_rmse": F.col("rmse") >= 0, "c2_points": F.col("n_points") >= 0}


def group_rules() -> dict[str, Column]:
    """c3: a group has as many curves as papers at least, and a spelling."""
    return {"c3_counts": F.col("curve_count") >= F.col("paper_count"), "c3_variants": F.size("label_variants") >= 1}


def curve_rules() -> dict[str, Column]:
    """c4 to c10: the clean flag, fidelity, the first peak's ranges and coherence, the hump's, and the extents."""
    peak = ["two_theta", "d", "fwhm", "wavelength", "source"]
    none, some = [F.col(c).isNull() for c in peak], F.col("two_theta").isNotNull()
    together = reduce(lambda a, b: a & b, [x == none[0] for x in none[1:]])
    hump = F.col("hump_status").eqNullSafe(F.lit("hump_detected"))
    return {
        "c4": F.col("in_clean_set") == (F.col("admission") == "clean"),
        "c5": between("fidelity", 0, 1),
        "c6_two_theta": between("two_theta", 0, 180, True, True),
        "c6_fwhm": between("fwhm", 0.05, 3),
        "c6_wavelength": between("wavelength", 0.4, 3, True, True),
        "c7_together": together,
        "c7_absent": ~(F.col("status").isin("truncated_at_window_start", "no_bragg_peak") & some),
        "c8_fraction": between("crystalline_fraction", 0, 1),
        "c8_center": between("hump_center", 15, 35),
        "c9_geometry": hump | (F.col("hump_center").isNull() & F.col("hump_fwhm").isNull()),
        "c9_computed": ~(F.col("hump_status").eqNullSafe(F.lit("not_computed")) & F.col("crystalline_fraction").isNotNull()),
        "c10": F.col("two_theta_min") <= F.col("two_theta_max"),
    }
