"""JSON columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridgeline.functions import vocabulary as V

def peak_list(text: Column) -> Column:
    """array<struct<two_theta, rel_height, prominence>> by angle; null for what is no array, bad entries dropped."""
    raw = F.from_json(text, "array<struct<two_theta: string, rel_height: string, prominence: string>>")

    def number(c, most):
        x = c.try_cast("double")
        return F.when(x.between(0, most), x)

    rows = F.transform(raw, lambda p: F.struct(number(p["two_theta"], 180).alias("two_theta"), number(p["rel_height"], 1).alias("rel_height"), number(p["prominence"], 1).alias("prominence")))
    good = F.filter(rows, lambda p: p["two_theta"].isNotNull())
    return F.when(F.try_parse_json(text).isNotNull() & F.trim(text).startswith("["), F.array_sort(good))


def lifecycle(kinds: Column, is_notice: Column) -> Column:
    """The state that the most severe of a work's updates gives it; a notice, and a work without updates, is active."""
    states = F.transform(kinds, lambda k: F.try_element_at(F.create_map(*[F.lit(x) for p in V.UPDATES for x in p]), k))
    rules = reduce(lambda c, s: c.when(F.array_contains(states, s[0]), s[0]), sorted(V.SEVERITY, key=lambda s: -s[1])[:-1], F.when(is_notice, "active"))
    return rules.otherwise("active")
