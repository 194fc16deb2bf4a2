"""Queries over whole tables against brute force."""

import re

import numpy as np
import pytest

from ridgeline.operators import models
from ridgeline.plans import registry


def test_tiered_match_reads_whole_tables(spark, tmp_path):
    parts = [(1, "X", "Red Cup", "RED"), (2, "X", "red-cup large", "red cup"), (3, "X", "blue", "steel"), (4, "Y", "pan", "tin"), (5, "Z", "!", "iron"), (6, "Z", "wood", "oak wood"), (11, "W", "Tin Pan", "tin")]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    key = lambda x: re.sub("[^a-z0-9]", "", x.lower())
    want = set()
    for i, brand, name, _ in parts:
        there = [(j, key(t)) for j, b, _, t in parts if b == brand]
        hits = sorted((-len(t), j) for j, t in there if t and key(name) and (t in key(name) or key(name) in t))
        tier = "A" if len(hits) == 1 else "A_ambiguous" if hits else "B" if len(there) == 1 else "C"
        want.add((i, hits[0][1] if hits else there[0][0] if tier == "B" else None, tier, len(there)))
    got = {tuple(r) for r in registry.queries()["j12_tiered_match"](spark, str(tmp_path)).collect()}
    assert got == want and {w[2] for w in want} == {"A", "A_ambiguous", "B", "C"}


def test_tiered_match_makes_no_pairs(spark):
    from ridgeline.operators import joins

    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("ab"), rng.integers(0, 6))) for _ in range(400)]
    rows = [(i % 390, None if i % 40 == 0 else "xyz"[i % 3], None if i % 31 == 0 else words[i], None if i % 29 == 0 else words[-i]) for i in range(400)]
    rows = spark.createDataFrame(rows, "i long, k string, a string, b string").cache()
    left, right = rows.select("i", "k", "a"), rows.select(rows.i.alias("j"), "k", "b")
    rows.createOrReplaceTempView("tiered")
    want = spark.sql("""WITH m AS (SELECT l.i, r.i AS j, r.b, coalesce(l.a <> '' AND r.b <> '' AND (contains(l.a, r.b) OR contains(r.b, l.a)), false) AS hit FROM tiered l JOIN tiered r USING (k))
    SELECT i, count_if(hit) AS hits, count(*) AS n, min(CASE WHEN hit THEN struct(-length(b), j) END).j AS best, min(j) AS any FROM m GROUP BY i""").collect()
    want = {(w.i, w.best if w.hits else w.any if w.n == 1 else None, "A" if w.hits == 1 else "A_ambiguous" if w.hits else "B" if w.n == 1 else "C", w.n) for w in want}
    assert {tuple(r) for r in joins.tiered_match(left, right, "k", "a", "b", "i", "j").collect()} == want
    many = spark.range(60_000).selectExpr("id AS i", "'x' AS k", "'red cup' AS a", "if(id % 2 = 0, 'cup', 'pan') AS b")  # 3.6e9 pairs
    got = joins.tiered_match(many.select("i", "k", "a"), many.selectExpr("i AS j", "k", "b"), "k", "a", "b", "i", "j")
    assert [tuple(r) for r in got.groupBy("j", "match_tier", "n_candidates").count().collect()] == [(0, "A_ambiguous", 60_000, 60_000)]


def test_enrichment_asks_every_row(spark, tmp_path):
    rng = np.random.default_rng(3)
    n, k = 120, 10
    x, labels = rng.normal(size=(n, 64)), rng.integers(0, 5, n)
    x[:, :3] += 3 * np.eye(5, 3)[labels]
    spark.createDataFrame([(i, x[i].tolist(), int(labels[i])) for i in range(n)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = registry.queries()["a18_neighbour_enrichment"](spark, str(tmp_path)).first()
    y = x.astype(np.float32).astype(float)
    y = y - y.mean(0)
    y = y @ np.linalg.svd(y, full_matrices=False)[2][:50].T
    near = np.argsort(((y[:, None] - y[None]) ** 2).sum(2) + np.diag([np.inf] * n), 1)[:, :k]
    paper = np.arange(n) % 50
    op = np.mean(paper[near] == paper[:, None])
    cross = (labels[:, None] == labels[None]) & (paper[:, None] != paper[None])
    of, cf = np.mean([cross[i, near[i]].mean() for i in range(n)]), cross.sum(1).mean() / (n - 1)
    cp = np.mean([(np.sum(paper == p) - 1) / (n - 1) for p in paper])
    assert (got.n_asked, got.n_family) == (n, n)
    assert [got.paper_observed, got.paper_chance, got.family_observed, got.family_chance] == pytest.approx([op, cp, of, cf])
    assert [got.paper_enrichment, got.family_enrichment] == pytest.approx([op / cp, of / cf])


def test_blocks_find_the_same_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(i, rng.integers(0, 3, 4).astype(float).tolist()) for i in range(60)], "vec_id long, components array<double>")
    got = {tuple(r) for r in models.all_neighbours(rows, 5, block=16).collect()}
    assert got == {tuple(r)[:3] for r in models.top_neighbours(rows, rows["vec_id"] >= 0, 5).collect()} and len(got) == 300


def test_query_blocks_find_the_same_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 4, (90, 3)).astype(float)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, components array<double>").repartition(7)
    monkeypatch.setattr(models, "ASKED_BYTES", 8 * 3 * 4)
    got = {tuple(r)[:3] for r in models.top_neighbours(rows, rows["vec_id"] % 5 == 0, 4).collect()}
    want = set()
    for q in range(0, 90, 5):
        d = np.round(np.sqrt(((x - x[q]) ** 2).sum(1)), 9)
        want |= {(q, i, place + 1) for place, i in enumerate([i for i in np.lexsort((np.arange(90), d)) if i != q][:4])}
    assert got == want and models.top_neighbours(rows, rows["vec_id"] < 0, 4).count() == 0


def test_forest_scores_have_means_and_a_shuffled_run(spark):
    rows = spark.createDataFrame([(i, f"g{i % 12}", float(i % 7), float(i % 7 > 3), float(i % 7 < 2)) for i in range(240)], "id long, g string, x double, a double, b double")
    got = {(r.run, r.label): r for r in models.forest_scores(rows, ["x"], ["a", "b"], "g", folds=2, trees=3, key="id").collect()}
    assert set(got) == {(run, x) for run in ("given", "shuffled") for x in ("a", "b", "macro", "micro")}
    assert all(got["given", x].f1 == 1.0 > got["shuffled", x].f1 and got["given", x].positives == got["shuffled", x].positives for x in ("a", "b", "macro", "micro"))


def _ml_and_own(spark, rows, label, features, trees):
    """Chances of pyspark.ml's forest and of the operator's, grown from the same bins."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=features, outputCol="both").transform(spark.createDataFrame(rows)).cache()
    fit = RandomForestClassifier(featuresCol="both", labelCol=label, numTrees=trees, minInstancesPerNode=3, maxDepth=30, seed=1).fit(df)
    ml = np.array([r.probability[1] for r in fit.transform(df).select("probability").collect()])
    cuts = [models.split_points(*np.unique(rows[f], return_counts=True)) for f in features]
    b = np.stack([np.searchsorted(c, rows[f], "left") for c, f in zip(cuts, features)], 1)
    cells, which = np.unique(b, axis=0, return_inverse=True)
    n1 = np.bincount(which.ravel(), rows[label], len(cells)).astype(int)
    n0 = np.bincount(which.ravel(), minlength=len(cells)) - n1
    own = models.grown(cells, n0, n1, [np.random.default_rng([7, t]) for t in range(trees)]) / trees
    return ml, own[which.ravel()]


def test_forest_of_cells_says_what_the_forest_of_rows_says(spark):
    import pandas as pd

    rng = np.random.default_rng(5)
    x, z = rng.integers(0, 50, 1500), rng.normal(size=1500).round(2)
    rows = pd.DataFrame({"x": x.astype(float), "z": z, "y": ((x > 20) ^ (z > 0.4) ^ (rng.random(1500) < 0.25)).astype(float)})
    ml, own = _ml_and_own(spark, rows, "y", ["x", "z"], 150)
    assert abs(ml - own).mean() < 0.02 and abs(ml.mean() - own.mean()) < 0.005 and np.mean((ml > 0.5) == (own > 0.5)) > 0.98


def test_forest_scores_take_few_jobs(spark):
    """One job for each forest and level would be hundreds."""
    rows = spark.createDataFrame([(i, f"g{i % 12}", float(i % 7) if i % 5 else None, float(i % 31 % 2), float(i % 7 < 2)) for i in range(300)], "id long, g string, x double, a double, b double")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("forests", "")
    try:
        got = {(r.run, r.label): r.f1 for r in models.forest_scores(rows, ["x"], ["a", "b"], "g", trees=40, key="id").collect()}
        assert len(got) == 8 and 0 < len(status.getJobIdsForGroup("forests")) < 60
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert got == {(r.run, r.label): r.f1 for r in models.forest_scores(rows.repartition(3), ["x"], ["a", "b"], "g", trees=40, key="id").collect()}


def test_products_bound_all_neighbours(spark, monkeypatch):
    """All distances by one subtraction a row, and each row sent twice to every block, took quadratic time and disk."""
    rng = np.random.default_rng(12)
    for n, m, scale, shift in ((500, 700, 1, 0), (64, 9, 1, 0), (300, 300, 1e-4, 1e3), (90, 80, 1e30, 0), (90, 80, 1e-30, 0), (200, 400, 0, 5), (1, 1, 1, 0), (50, 23, 1, 0)):
        x, y = (np.round(rng.normal(size=(c, 12)), 1) * scale + shift for c in (n, m))
        x_ids, y_ids = rng.permutation(n + m)[:n], rng.permutation(n + m)[:m]
        monkeypatch.setattr(models, "DISTANCES_AT_ONCE", 7000)
        i, j, d = models.nearest_of(x, x_ids, y, y_ids, 10)
        got = {}
        for a, b in zip(i.tolist(), j.tolist()):
            got.setdefault(a, []).append(int(y_ids[b]))
        exact = ((y[None] - x[:, None]) ** 2).sum(2)
        want = {a: [int(y_ids[b]) for b in np.lexsort((y_ids, exact[a])) if y_ids[b] != x_ids[a]][:10] for a in range(n)}
        assert got == {a: w for a, w in want.items() if w} and (d == exact[i, j]).all()
    rows = spark.range(3000).selectExpr("id AS vec_id", "array(cast(id % 97 AS double), cast(id % 13 AS double)) AS components")
    monkeypatch.undo()
    got = models.all_neighbours(rows, 3)
    assert {tuple(r) for r in got.collect()} == {tuple(r)[:3] for r in models.top_neighbours(rows, rows["vec_id"] >= 0, 3).collect()}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1  # a row goes once to each block
