"""Grouping of labels and estimates over groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import text


def label_groups(rows: DataFrame, label: str, paper: str) -> DataFrame:
    """Groups of labels with one key: counts, variants, a display name (the most frequent; then shortest, then first).

    Two aggregations: spellings of a key first, so that a common key never gathers its rows in one place.
    """
    named = rows.select(F.col(paper).alias("paper"), text.published(F.col(label)).alias("label"), text.label_key(F.col(label)).alias("key")).where("key <> ''")
    spelled = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    names = spelled.groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("a"), F.length("label").alias("b"), F.col("label").alias("c"))).alias("best"), F.sum("n").alias("curve_count"), F.count(F.lit(1)).alias("n_variants"), F.array_sort(F.collect_list("label")).alias("label_variants"))
    papers = named.groupBy("key").agg(F.count_distinct("paper").alias("paper_count"))
    out = names.join(papers, "key").select("key", F.col("best.c").alias("display_name"), "curve_count", "paper_count", "n_variants", "label_variants", text.specificity(F.col("key")).alias("specificity"))
    return out.withColumns({"match_basis": F.when(F.col("n_variants") == 1, "label_identical").otherwise("label_normalised"), "publishable": (F.col("paper_count") >= 2) & (F.col("specificity") == "specific")})


def prior_grid(grid: int = 120) -> np.ndarray:
    """Values that either parameter of the prior may take (fixed values: 0.3 to 60, evenly)."""
    return np.linspace(0.3, 60, grid)


def beta_prior(counted: DataFrame, grid: int = 120) -> tuple[float, float, float]:
    """a and b of the likeliest prior of groups (n, hits, groups: how many have them) on a grid, and the pooled share.

    Each task sums the likelihood of its rows at every grid point, so that the driver gets one grid a task, whatever the groups.
    """
    axis = prior_grid(grid)

    def summed(batches):
        total, hits, rows = np.zeros((grid, grid)), 0, 0
        for batch in batches:
            n, h, k = (np.asarray(batch.column(c), float) for c in ("n", "hits", "groups"))
            for at in range(0, len(n), 64):
                m, x, w = (v[at : at + 64, None, None] for v in (n, h, k))
                part = log_gamma(axis[:, None] + x) + log_gamma(axis + m - x) - log_gamma(axis[:, None] + axis + m)
                total += (w * part).sum(0)
            hits, rows = hits + (h * k).sum(), rows + (n * k).sum()
            total -= k.sum() * (log_gamma(axis)[:, None] + log_gamma(axis) - log_gamma(axis[:, None] + axis))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([float(hits)]), pa.array([float(rows)])], names=["grid", "hits", "rows"])

    total, hits, rows = np.zeros((grid, grid)), 0.0, 0.0
    for r in counted.select("n", "hits", "groups").mapInArrow(summed, "grid binary, hits double, rows double").toLocalIterator():
        total, hits, rows = total + np.frombuffer(r.grid).reshape(grid, grid), hits + r.hits, rows + r.rows
    i, j = np.unravel_index(int(np.argmax(np.round(total, 9))), total.shape)
    return float(axis[i]), float(axis[j]), hits / rows if rows else 0.0


def beta_binomial(groups: DataFrame, key: str, least: int = 15) -> DataFrame:
    """Empirical-Bayes shares of groups (key, n, hits) of at least `least` rows: posterior mean, equal-tailed 95 % interval, lift
    over the pooled share, and whether the interval leaves that out. Intervals are computed once for each (n, hits)."""
    rows = groups.where(F.col("n") >= least).select(key, "n", "hits")
    counted = rows.groupBy("n", "hits").agg(F.count(F.lit(1)).alias("groups"))
    a, b, pooled = beta_prior(counted)

    def shares(batches):
        for batch in batches:
            n, h = np.asarray(batch.column("n"), float), np.asarray(batch.column("hits"), float)
            mean, low, high = (h + a) / (n + a + b), beta_quantile(0.025, a + h, b + n - h), beta_quantile(0.975, a + h, b + n - h)
            out = [pa.array(v) for v in (mean, low, high, mean - pooled, (low > pooled) | (high < pooled))]
            yield pa.RecordBatch.from_arrays([batch.column("n"), batch.column("hits"), *out], names=["n", "hits", "mean", "low", "high", "lift", "off_pool"])

    found = counted.select("n", "hits").mapInArrow(shares, "n long, hits long, mean double, low double, high double, lift double, off_pool boolean")
    return rows.join(found, ["n", "hits"]).select(key, "n", "hits", "mean", "low", "high", "lift", "off_pool")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after raising the argument to ten or more."""
    x = np.array(x, float)
    raised = np.zeros_like(x)
    while (small := x < 10).any():
        raised -= np.where(small, np.log(np.where(small, x, 1.0)), 0.0)
        x = np.where(small, x + 1, x)
    inverse = 1 / x**2
    tail = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse * (1 / 1680 - inverse / 1188)))) / x
    return raised + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + tail


def beta_share(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction, mirrored where that converges slowly."""
    mirror = x > (a + 1) / (a + b + 2)
    x, a, b = np.where(mirror, 1 - x, x), np.where(mirror, b, a), np.where(mirror, a, b)
    tiny = 1e-300
    c, d = np.ones_like(x), 1 / (1 - (a + b) * x / (a + 1))
    value = d
    for m in range(1, 400):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d, c = 1 / np.maximum(1 + term * d, tiny), np.maximum(1 + term / c, tiny)
            value = value * d * c
        if np.abs(d * c - 1).max(initial=0.0) < 1e-15:
            break
    with np.errstate(divide="ignore"):
        front = np.exp(a * np.log(x) + b * np.log1p(-x) + log_gamma(a + b) - log_gamma(a) - log_gamma(b)) / a
    return np.where(mirror, 1 - front * value, front * value)


def beta_quantile(share: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where the distribution function of Beta(a, b) reaches a share, by halving."""
    low, high = np.zeros_like(a), np.ones_like(a)
    for _ in range(60):
        middle = (low + high) / 2
        under = beta_share(middle, a, b) < share
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return (low + high) / 2


def random_effects(rows: DataFrame, mean: str, error: str) -> DataFrame:
    """rows with `shrunk`: group means drawn to the pooled one by the method-of-moments variance between groups."""
    m, v = F.col(mean), F.col(error) * F.col(error)
    fixed = rows.agg(F.sum(1 / v).alias("w"), (F.sum(m / v) / F.sum(1 / v)).alias("mu"), F.sum(1 / v / v).alias("w2"), F.count(F.lit(1)).alias("k"))
    q = rows.crossJoin(F.broadcast(fixed)).agg(F.sum((m - F.col("mu")) * (m - F.col("mu")) / v).alias("q"), F.first("w").alias("w"), F.first("w2").alias("w2"), F.first("k").alias("k"))
    tau = q.select(F.greatest(F.lit(0.0), F.try_divide(F.col("q") - (F.col("k") - 1), F.col("w") - F.col("w2") / F.col("w"))).alias("tau2"))
    pooled = rows.crossJoin(F.broadcast(tau)).agg((F.sum(m / (v + F.col("tau2"))) / F.sum(1 / (v + F.col("tau2")))).alias("pooled"), F.first("tau2").alias("tau2"))
    shrunk = F.when(F.col("tau2") > 0, (m / v + F.col("pooled") / F.col("tau2")) / (1 / v + 1 / F.col("tau2"))).otherwise(F.col("pooled"))
    return rows.crossJoin(F.broadcast(pooled)).withColumn("shrunk", shrunk).drop("pooled", "tau2")
