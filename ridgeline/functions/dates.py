"""Dates from parts and text; whatever is no date gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_parts(year: Column, month: Column, day: Column) -> Column:
    """Missing month or day counts as 1."""
    two = lambda c: F.lpad(F.coalesce(c, F.lit(1)).cast("string"), 2, "0")
    return F.concat_ws("-", year.cast("string"), two(month), two(day)).try_cast("date")


def first_year(*years: Column) -> Column:
    """The first year within 1800 to 2200."""
    return F.coalesce(*[F.when(y.between(1800, 2200), y) for y in years])


def iso_date(text: Column) -> Column:
    return F.left(text, F.lit(10)).try_cast("date")
