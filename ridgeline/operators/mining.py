"""Text mining that yields rows: sentences and overlapping chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sentences(rows: DataFrame, key: str, text: str, keyword: str, most: int) -> DataFrame:
    """The first `most` different sentences with a keyword, of 41 to 499 characters; equal first 60 characters are one.

    All inside the row: arrays, no explode before the choice and no shuffle.
    """
    every = F.transform(F.split(text, "[.!?]"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " ")))
    fit = F.filter(every, lambda s: (F.length(s) > 40) & (F.length(s) < 500) & F.contains(F.lower(s), F.lit(keyword)))
    heads = F.transform("fit", lambda s: F.left(s, F.lit(60)))
    found = rows.select(key, fit.alias("fit")).withColumn("heads", heads)
    found = found.withColumn("fit", F.filter("fit", lambda s, i: F.array_position("heads", F.left(s, F.lit(60))) == i + 1))
    return found.select(key, F.posexplode(F.slice("fit", 1, most)).alias("i", "sentence")).select(key, (F.col("i") + 1).cast("long").alias("place"), "sentence")


def chunks(rows: DataFrame, key: str, order: str, text: str, size: int, overlap: int) -> DataFrame:
    """Windows of `size` consecutive orders that start every size - overlap, while any order is left: (key, start, turns, text).

    Each row goes straight to the windows that hold it: one shuffle by window.
    """
    step = size - overlap
    first = F.greatest(F.lit(0), F.ceil((F.col(order) - (size - 1)) / step) * step).cast("long")
    last = (F.floor(F.col(order) / step) * step).cast("long")
    placed = rows.select(key, F.explode(F.sequence(first, last, F.lit(step).cast("long"))).alias("start"), F.struct(F.col(order), F.col(text)).alias("t"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda x: x[text]), "\n")
    return placed.groupBy(key, "start").agg(F.count(F.lit(1)).alias("turns"), joined.alias("text"))
