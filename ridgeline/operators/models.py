"""Corpus models on pyspark.ml: grouped folds, multi-label forests, neighbours, components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(group: Column, folds: int = 5, seed: str = "42") -> Column:
    """Fold of a group by a seeded hash: a group stays whole, and any engine can repeat it."""
    return F.pmod(F.conv(F.left(F.sha2(F.concat(F.lit(seed + ":"), group.cast("string")), 256), F.lit(8)), 16, 10).cast("long"), F.lit(folds)).cast("int")


def permuted(rows: DataFrame, key: str, columns: list[str], seed: str = "42") -> DataFrame:
    """rows with `columns` dealt anew: the row n-th by key gets those of the row n-th by sha2 of its key. Keys are unique.

    Rows are numbered within 256 ranges whose counts the driver adds up, so that no task orders all of them."""
    by_hash = F.sha2(F.concat(F.lit(seed + ":"), F.col(key).cast("string")), 256)

    def numbered(df: DataFrame, order: Column) -> DataFrame:
        ranged = df.withColumn("__o", order).repartitionByRange(256, "__o").sortWithinPartitions("__o", key)
        return ranged.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])).toDF(df.schema.add("__o", ranged.schema["__o"].dataType).add("__n", "long")).drop("__o")

    rest = numbered(rows.drop(*columns), F.col(key))
    dealt = numbered(rows.select(key, *columns), by_hash).drop(key)
    return rest.join(dealt, "__n").drop("__n")


#: As in pyspark.ml: bins of a feature. Distinct values of a feature that the driver holds for exact bins; beyond, they follow
#: percentile_approx over all rows. Cells of bins that a forest is grown from; beyond, pyspark.ml grows it from the rows.
MOST_BINS, MOST_VALUES, MOST_CELLS = 32, 4096, 1 << 16
#: Trees that are grown in one task, and trees times cells at a time.
TREES_AT_ONCE, GROWN_AT_ONCE = 60, 1 << 18


def split_points(values: np.ndarray, counts: np.ndarray, bins: int = MOST_BINS) -> np.ndarray:
    """pyspark.ml's candidate splits of a feature from its sorted distinct values: middles between all of them, or between those
    where the running count is nearest to even strides."""
    if len(values) < 2:
        return np.zeros(0)
    middles, at = (values[:-1] + values[1:]) / 2, np.cumsum(counts)
    if len(middles) < bins:
        return middles
    stride, out = at[-1] / bins, []
    target = stride
    for i in range(1, len(values)):
        if abs(at[i - 1] - target) < abs(at[i] - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out[: bins - 1])


def grown(cells: np.ndarray, n0: np.ndarray, n1: np.ndarray, dice: list[np.random.Generator], least: int = 3, depth: int = 30) -> np.ndarray:
    """Sum over trees, one for each generator, of the chance of label 1 in each cell (its bin of each feature).

    A random forest as pyspark.ml grows it: n0 and n1 rows of a cell drawn with Poisson weights (the sum over a cell's rows is
    Poisson of their number), Gini gain, a root's share of the features at each node, leaves of `least` rows, sibling leaves that
    say the same merged. Rows of a cell are never told apart by a split, so that cells stand for any number of rows.
    """
    size, trees, features = len(cells), len(dice), cells.shape[1]
    w = np.stack([[d.poisson(n0), d.poisson(n1)] for d in dice]).astype(float)
    w = [w[:, 0].ravel(), w[:, 1].ravel()]
    bins, some = int(cells.max(initial=0)) + 1, int(np.ceil(np.sqrt(features)))
    at, here, tree = np.arange(trees * size), np.repeat(np.arange(trees), size), np.arange(trees)
    leaf, first, parents, totals, levels = np.zeros(trees * size, int), 0, [np.full(trees, -1)], [], []
    for level in range(depth + 1):
        m = len(tree)
        leaf[at] = first + here
        total = [np.bincount(here, x[at], m) for x in w]
        totals.append(np.stack(total, 1))
        levels.append((first, m))
        n = total[0] + total[1]
        if level == depth or bins < 2:
            break
        best, best_f, best_b = np.full(m, 1e-12), np.full(m, -1), np.zeros(m, int)
        asked = np.ones((m, features), bool)
        if some < features:
            order = np.concatenate([d.random((k, features)) for d, k in zip(dice, np.bincount(tree, minlength=trees))])
            asked = order.argsort(1).argsort(1) < some
        with np.errstate(divide="ignore", invalid="ignore"):
            whole = (total[0] ** 2 + total[1] ** 2) / n**2
            for f in range(features):
                slot = here * bins + cells[at % size, f]
                left = [np.bincount(slot, x[at], m * bins).reshape(m, bins).cumsum(1)[:, :-1] for x in w]
                right = [t[:, None] - x for t, x in zip(total, left)]
                nl, nr = left[0] + left[1], right[0] + right[1]
                gain = ((left[0] ** 2 + left[1] ** 2) / nl + (right[0] ** 2 + right[1] ** 2) / nr) / n[:, None] - whole[:, None]
                gain[(nl < least) | (nr < least) | ~asked[:, f, None]] = -np.inf
                b = gain.argmax(1)
                g = gain[np.arange(m), b]
                better = g > best
                best[better], best_f[better], best_b[better] = g[better], f, b[better]
        split = best_f >= 0
        if not split.any():
            break
        rank = np.cumsum(split) - 1
        goes = split[here]
        at, was = at[goes], here[goes]
        here = 2 * rank[was] + (cells[at % size, best_f[was]] > best_b[was])
        parents.append(np.repeat(first + np.flatnonzero(split), 2))
        tree, first = np.repeat(tree[split], 2), first + m
    parent, total = np.concatenate(parents)[: levels[-1][0] + levels[-1][1]], np.concatenate(totals)
    says, is_leaf, merged = total[:, 1] > total[:, 0], np.ones(len(total), bool), np.zeros(len(total), bool)
    is_leaf[parent[parent >= 0]] = False
    for begin, m in levels[:0:-1]:
        pairs = np.arange(begin, begin + m).reshape(-1, 2)
        same = is_leaf[pairs].all(1) & (says[pairs[:, 0]] == says[pairs[:, 1]])
        merged[parent[pairs[same, 0]]] = is_leaf[parent[pairs[same, 0]]] = True
    stands = np.arange(len(total))
    for begin, m in levels[1:]:
        up = parent[begin : begin + m]
        stands[begin : begin + m] = np.where(merged[up] | (stands[up] != up), stands[up], stands[begin : begin + m])
    chance = total[:, 1] / np.maximum(total.sum(1), 1)
    return chance[stands[leaf]].reshape(trees, size).sum(0)


def _binned(data: DataFrame, features: list[str], folds: list[int]) -> dict[tuple[int, str], tuple[float, list[float]]]:
    """Median of each fold's training rows and, nulls set to it, their split points, by fold and feature."""
    out = {}
    for f in features:
        held = data.where("__fold is not null").groupBy("__fold", F.col(f).alias("v")).agg(F.count(F.lit(1)).alias("n")).limit(MOST_VALUES * len(folds) + 1).toPandas()
        if len(held) <= MOST_VALUES * len(folds):
            for k in folds:
                train = held[held["__fold"] != k]
                known = train.groupby("v")["n"].sum().sort_index()
                if not len(known):  # no value at all: one bin
                    out[k, f] = (0.0, [])
                    continue
                median = known.index[int(np.searchsorted(known.cumsum(), known.sum() / 2))]
                known[median] += train["n"].sum() - known.sum()
                out[k, f] = (float(median), split_points(known.index.to_numpy(float), known.to_numpy()).tolist())
        else:
            trained = lambda k, x: F.when(F.col("__fold") != k, x)
            medians = data.agg(*(F.percentile_approx(trained(k, F.col(f)), 0.5, 100_000).alias(str(k)) for k in folds)).first()
            shares = [i / MOST_BINS for i in range(1, MOST_BINS)]
            cuts = data.agg(*(F.percentile_approx(trained(k, F.coalesce(f, F.lit(medians[str(k)]))), shares, 100_000).alias(str(k)) for k in folds)).first()
            out |= {(k, f): (float(medians[str(k)]), sorted(set(map(float, cuts[str(k)])))) for k in folds}
    return out


def _cells(data: DataFrame, features: list[str], labels: list[str], cuts: dict, folds: list[int]) -> DataFrame:
    """(k, b: bin of each feature, rows and labels of the training and the test rows), one row for each fold and cell."""

    def bin_of(f: str, median: float, points: list[float]) -> Column:
        x = F.coalesce(f, F.lit(median))
        return F.size(F.filter(F.array(*map(F.lit, points)).cast("array<double>"), lambda c: c < x))

    place = lambda k: F.struct(F.lit(k).alias("k"), F.array(*(bin_of(f, *cuts[k, f]) for f in features)).alias("b"))
    placed = data.where("__fold is not null").select("__fold", *labels, F.explode(F.array(*map(place, folds))).alias("p"))
    test = F.col("__fold") == F.col("p.k")
    sums = [F.count_if(c & (F.col(x) == 1)).alias(f"{name}{i}") for name, c in (("train", ~test), ("test", test)) for i, x in enumerate(labels)]
    return placed.groupBy(F.col("p.k").alias("k"), F.col("p.b").alias("b")).agg(F.count_if(~test).alias("train"), F.count_if(test).alias("test"), *sums)


def forest_scores(rows: DataFrame, features: list[str], labels: list[str], group: str, folds: int = 5, trees: int = 300, seed: int = 42, key: str | None = None) -> DataFrame:
    """(run, label, positives, f1) of one forest for each label by grouped cross-validation: imputed features.

    Each label's f1 is over all folds; labels `macro` and `micro` are means over the folds of the fold's figure. With a
    unique `key` the run `shuffled` repeats all with the label rows permuted by a hash of it.

    All forests grow at once, some trees of one to a task, from counts of rows in cells of binned features (`grown`). Scaling a
    feature moves no row over a split, so that there is none here; where cells are too many, forests grow from the rows."""
    spark = rows.sparkSession
    rows = rows.select(*([key] if key else []), *(F.col(f).cast("double") for f in features), *labels, fold(F.col(group), folds).alias("__fold"))
    rows = rows.withColumns({f: F.when(~F.isnan(f), F.col(f)) for f in features})
    there = {r[0] for r in rows.select("__fold").distinct().collect()} - {None}
    done = sorted(there) if len(there) > 1 else []  # a fold needs rows to test and rows to train on
    cuts = _binned(rows, features, done)
    found = {}
    for run, data in ({"given": rows} | ({"shuffled": permuted(rows, key, labels)} if key else {})).items():
        if not done:
            continue
        cells = _cells(data, features, labels, cuts, done).cache()
        grow = _forest_of_rows if cells.groupBy("k").count().agg(F.max("count")).first()[0] > MOST_CELLS else _forest_of_cells
        found |= {(run, *k): v for k, v in grow(data, cells, features, labels, done, trees, seed, run).items()}
        cells.unpersist()
    f1 = lambda tp, fp, fn: 2.0 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0
    total = lambda picked: tuple(map(sum, zip((0, 0, 0), *picked)))
    out = []
    for run in ("given", "shuffled") if key else ("given",):
        each = {label: total(found[run, k, label] for k in done) for label in labels}
        out += [(run, label, t[0] + t[2], f1(*t)) for label, t in each.items()]
        positives = sum(t[0] + t[2] for t in each.values())
        out.append((run, "macro", positives, sum(f1(*found[run, k, x]) for k in done for x in labels) / max(1, len(done) * len(labels))))
        out.append((run, "micro", positives, sum(f1(*total(found[run, k, x] for x in labels)) for k in done) / max(1, len(done))))
    return spark.createDataFrame(out, "run string, label string, positives long, f1 double")


def _forest_of_cells(data: DataFrame, cells: DataFrame, features: list[str], labels: list[str], folds: list[int], trees: int, seed: int, run: str) -> dict:
    """(true positives, false positives, false negatives) of each fold and label; a task grows some trees of one forest."""
    each = F.array(*(F.struct(F.lit(i).alias("label"), F.col(f"train{i}").alias("train1"), F.col(f"test{i}").alias("test1")) for i in range(len(labels))))
    blocks = F.sequence(F.lit(0), F.lit((trees - 1) // TREES_AT_ONCE))
    held = cells.select("k", "b", "train", "test", F.explode(each).alias("e")).select("k", "b", "train", "test", "e.*", F.explode(blocks).alias("block"))

    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        b = np.stack(pdf["b"])
        order = np.lexsort(b.T[::-1])
        pdf, b = pdf.iloc[order], b[order]
        k, label, block = (int(pdf[c].iloc[0]) for c in ("k", "label", "block"))
        n1 = pdf["train1"].to_numpy()
        n0, chance = pdf["train"].to_numpy() - n1, np.zeros(len(b))
        mine, step = range(block * TREES_AT_ONCE, min(trees, (block + 1) * TREES_AT_ONCE)), max(1, GROWN_AT_ONCE // len(b))
        for at in range(0, len(mine), step):
            chance += grown(b, n0, n1, [np.random.default_rng([seed, run == "shuffled", k, label, t]) for t in mine[at : at + step]])
        return pdf[["k", "label", "b", "test", "test1"]].assign(chance=np.round(chance * 1e9).astype(np.int64))[pdf["test"] > 0]

    said = held.repartition(len(folds) * len(labels) * (1 + (trees - 1) // TREES_AT_ONCE), "k", "label", "block").groupBy("k", "label", "block").applyInPandas(task, "k int, label int, b array<int>, test long, test1 long, chance long")
    voted = said.groupBy("k", "label", "b").agg((2 * F.sum("chance") > trees * 1_000_000_000).alias("hit"), F.first("test").alias("test"), F.first("test1").alias("test1"))
    sums = {"tp": ("hit", "test1"), "fp": ("hit", "test - test1"), "fn": ("not hit", "test1")}
    counts = voted.groupBy("k", "label").agg(*(F.sum(F.when(F.expr(c), F.expr(x)).otherwise(0)).alias(name) for name, (c, x) in sums.items()))
    return {(r.k, labels[r.label]): (r.tp, r.fp, r.fn) for r in counts.collect()}


def _forest_of_rows(data: DataFrame, cells: DataFrame, features: list[str], labels: list[str], folds: list[int], trees: int, seed: int, run: str) -> dict:
    """The same from the rows by pyspark.ml, one forest after another."""
    data, found = data.cache(), {}
    for k in folds:
        train, test = data.where(F.col("__fold") != k), data.where(F.col("__fold") == k)
        imputed = [f"{f}__i" for f in features]
        ready = Pipeline(stages=[Imputer(strategy="median", inputCols=features, outputCols=imputed), VectorAssembler(inputCols=imputed, outputCol="__raw"), StandardScaler(inputCol="__raw", outputCol="__x", withMean=True)]).fit(train)
        train, test = ready.transform(train).cache(), ready.transform(test).cache()
        for label in labels:
            kinds = [r[0] for r in train.select(label).distinct().limit(2).collect()]
            if len(kinds) < 2:  # a label with one value is predicted as that
                said = test.withColumn("prediction", F.lit(float(kinds[0])))
            else:
                said = RandomForestClassifier(featuresCol="__x", labelCol=label, numTrees=trees, minInstancesPerNode=3, maxDepth=30, seed=seed).fit(train).transform(test)
            hit, true = F.col("prediction") == 1, F.col(label) == 1
            r = said.agg(F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & true).alias("fn")).first()
            found[k, label] = (r.tp, r.fp, r.fn)
        train.unpersist()
        test.unpersist()
    data.unpersist()
    return found


def principal(rows: DataFrame, vector: str, k: int) -> DataFrame:
    """rows with `components`: the first k principal components of an array column."""
    data = rows.withColumn("__v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    return PCA(k=k, inputCol="__v", outputCol="__p").fit(data).transform(data).withColumn("components", vector_to_array("__p")).drop("__v", "__p")


def neighbour_enrichment(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Observed and expected share of neighbours from one's own paper, and of one's own family in other papers.

    pairs (q, vec_id) of every asked row, labels (vec_id, family, paper). Rows without a family, or whose family is in no
    other paper, count for papers only; each row's chance is its number of such rows over all others."""
    n = lambda name, *by: F.count(F.lit(1)).over(Window.partitionBy(*by)).alias(name)
    total = labels.agg(F.count(F.lit(1)).alias("total"))
    own = labels.select("vec_id", "family", "paper", n("in_paper", "paper"), n("in_family", "family"), n("in_both", "family", "paper")).crossJoin(F.broadcast(total))
    a = own.select(F.col("vec_id").alias("q"), F.col("family").alias("f"), F.col("paper").alias("p"), ((F.col("in_paper") - 1) / (F.col("total") - 1)).alias("cp"), F.when(F.coalesce(F.col("family").cast("string"), F.lit("")) != "", (F.col("in_family") - F.col("in_both")) / (F.col("total") - 1)).alias("cf"))
    same = F.col("p").eqNullSafe(F.col("paper"))
    rows = pairs.select("q", "vec_id").join(a, "q").join(labels.select("vec_id", "family", "paper"), "vec_id")
    each = rows.groupBy("q").agg(F.avg(same.cast("double")).alias("op"), F.avg((~same & F.col("f").eqNullSafe(F.col("family"))).cast("double")).alias("of"), F.first("cp").alias("cp"), F.first("cf").alias("cf"))
    counts = F.col("cf") > 0
    seen = each.agg(F.count(F.lit(1)).alias("n_asked"), F.avg("op").alias("paper_observed"), F.avg("cp").alias("paper_chance"), F.count_if(counts).alias("n_family"), F.avg(F.when(counts, F.col("of"))).alias("family_observed"), F.avg(F.when(counts, F.col("cf"))).alias("family_chance"))
    return seen.select("*", F.try_divide("paper_observed", "paper_chance").alias("paper_enrichment"), F.try_divide("family_observed", "family_chance").alias("family_enrichment"))


#: Rows of a block of all_neighbours, blocks at least where rows allow it; distances and candidate pairs at a time.
BLOCK, BLOCKS, BLOCK_LEAST, DISTANCES_AT_ONCE, PAIRS_AT_ONCE = 32_768, 20, 256, 1 << 20, 1 << 15


def nearest_of(x: np.ndarray, x_ids: np.ndarray, y: np.ndarray, y_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in x, place in y, squared distance) of the k rows of y nearest to each row of x, its own id left out; ties by id.

    A matrix product in single precision bounds all distances; those that the bound can't rule out are computed exactly."""
    k1, centre = min(k + 1, len(y)), y.mean(0)
    a, b = x - centre, y - centre
    unit = max(np.abs(a).max(), np.abs(b).max()) or 1.0  # single precision would overflow or vanish
    a, b = (a / unit).astype(np.float32), (b / unit).astype(np.float32)
    a2, b2 = ((v.astype(float) ** 2).sum(1) for v in (a, b))
    slack = (x.shape[1] + 16) * 2.0**-22 * (np.sqrt(a2) + np.sqrt(b2.max())) ** 2  # of both bounds together
    b2, groups = b2.astype(np.float32), max(1, min(len(y) // 16, len(y) // k1))
    out, strip = [], max(1, DISTANCES_AT_ONCE // len(y))
    for at in range(0, len(x), strip):
        d = a[at : at + strip] @ b.T
        d *= -2
        d += b2
        d += a2[at : at + strip, None].astype(np.float32)
        # k1 groups of rows have a row each under the k1-th least of the groups' minima
        width = len(y) // max(groups, k1) if len(y) >= 2 * k1 else 1
        least = d[:, : width * (len(y) // width)].reshape(len(d), width, -1).min(1)
        limit = np.partition(least, k1 - 1, axis=1)[:, k1 - 1] + slack[at : at + strip]
        i, j = np.divmod(np.flatnonzero(d <= limit[:, None].astype(np.float32)), len(y))
        exact = np.empty(len(i))
        for p in range(0, len(i), PAIRS_AT_ONCE):
            s = slice(p, p + PAIRS_AT_ONCE)
            exact[s] = ((y[j[s]] - x[at + i[s]]) ** 2).sum(1)
        other = y_ids[j] != x_ids[at + i]
        i, j, exact = i[other], j[other], exact[other]
        order = np.lexsort((y_ids[j], exact, i))
        i, j, exact = i[order], j[order], exact[order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((at + i[first], j[first], exact[first]))
    return tuple(np.concatenate(c) for c in zip(*out))


def all_neighbours(rows: DataFrame, k: int = 10, block: int | None = None) -> DataFrame:
    """(q, vec_id, place): exact nearest rows of every row by Euclidean distance over `components`, block against block.

    All pairs are looked at, each pair of blocks by one task, which holds two blocks and DISTANCES_AT_ONCE distances. A row goes
    to as many tasks as there are blocks."""
    n = rows.count()
    blocks = max(1, -(-n // block) if block else max(-(-n // BLOCK), min(BLOCKS, n // BLOCK_LEAST)))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    placed = rows.select("vec_id", F.col("components").cast("array<double>").alias("v"), own.alias("own")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tiles = placed.select("vec_id", "v", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))

    def nearest(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        ids, own, a, b = (tile.column(c).to_numpy() for c in ("vec_id", "own", "a", "b"))
        v = tile.column("v").combine_chunks()
        v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
        v = v.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        sides = [np.flatnonzero(own == side) for side in (a[0], b[0])]
        found = []
        for p, q in ((0, 1), (1, 0)) if a[0] != b[0] else ((0, 0),):
            if len(sides[p]) and len(sides[q]):
                i, j, d = nearest_of(v[sides[p]], ids[sides[p]], v[sides[q]], ids[sides[q]], k)
                found.append((ids[sides[p]][i], ids[sides[q]][j], d))
        q, vec_id, d = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"q": pa.array(q, pa.int64()), "vec_id": pa.array(vec_id, pa.int64()), "d": pa.array(d, pa.float64())})

    tasks = blocks * (blocks + 1) // 2
    found = tiles.repartition(tasks, "a", "b").groupBy("a", "b").applyInArrow(nearest, "q long, vec_id long, d double")
    return found.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy("d", "vec_id"))).where(F.col("place") <= k).select("q", "vec_id", "place")


def frequency_baseline(rows: DataFrame, label: str, seed: str = "42") -> DataFrame:
    """Accuracy of always naming the commonest label, and of labels permuted by a seeded hash."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("majority"), (F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("permuted_expected"))


#: Bytes of query vectors that are broadcast at a time.
ASKED_BYTES = 4 << 20


def top_neighbours(rows: DataFrame, queries: Column, k: int = 10, vector: str = "components") -> DataFrame:
    """(q, vec_id, place, d): exact nearest rows of stated queries by Euclidean distance (of nine decimals; ties by id).

    The queries come in blocks of ASKED_BYTES that are broadcast one after another; each task keeps its k best rows of each
    query, so that only those meet. No pair of rows is ever a row.
    """
    spark = rows.sparkSession
    held = rows.select("vec_id", F.col(vector).cast("array<double>").alias("v"))
    asked = held.where(queries)
    size = asked.agg(F.max(F.size("v")).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    block = max(1, ASKED_BYTES // (8 * max(1, size.n or 1)))
    blocks = -(-size["rows"] // block)
    out = None
    for b in range(max(1, blocks)):
        mine = asked if blocks <= 1 else asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        got = mine.orderBy("vec_id").toArrow()  # a block of bounded size
        shared = spark.sparkContext.broadcast((got["vec_id"].to_numpy(), np.stack(got["v"].to_pylist()) if len(got) else np.zeros((0, 1))))

        def best(batches, shared=shared):
            ids, x = shared.value
            near_d, near_i = np.full((len(ids), 0), np.inf), np.zeros((len(ids), 0), np.int64)
            for batch in batches:
                there, y = np.asarray(batch.column(0)), np.stack(batch.column(1).to_pylist()) if batch.num_rows else np.zeros((0, 1))
                for at in range(0, len(there) if len(ids) else 0, 512):
                    some = y[at : at + 512]
                    d = np.empty((len(ids), len(some)))
                    for q in range(0, len(ids), 64):
                        d[q : q + 64] = np.round(np.sqrt(((x[q : q + 64, None] - some) ** 2).sum(2)), 9)
                    d[ids[:, None] == there[at : at + 512]] = np.inf
                    near_d = np.concatenate([near_d, d], 1)
                    near_i = np.concatenate([near_i, np.broadcast_to(there[at : at + 512], d.shape)], 1)
                    order = np.lexsort((near_i, near_d), axis=1)[:, :k]
                    near_d, near_i = np.take_along_axis(near_d, order, 1), np.take_along_axis(near_i, order, 1)
            good = np.isfinite(near_d)
            q = np.broadcast_to(ids[:, None], near_d.shape)[good]
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(near_i[good]), pa.array(near_d[good])], names=["q", "vec_id", "d"])

        part = held.mapInArrow(best, "q long, vec_id long, d double")
        out = part if out is None else out.unionByName(part)
    first = F.row_number().over(Window.partitionBy("q").orderBy("d", "vec_id"))
    return out.withColumn("place", first).where(F.col("place") <= k).select("q", "vec_id", "place", "d")
