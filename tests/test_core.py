"""Unit vectors, kernels on synthetic curves, invariants of the search API, files, streaming, and queries against SQL."""

import datetime
import decimal
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.functions import markup, text
from ridgeline.operators import calibration, joins, search, signal
from ridgeline.plans import registry
from ridgeline.sources import files
from ridgeline.streaming import ingest as streaming

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("token,value", [("28.0o", 28.0), ("I2.5", 12.5), ("abc", None), ("l0.5", 10.5), ("-.5", -0.5), ("1.2.3", 1.23), ("", None), (None, None)])
def test_numeric_value(spark, token, value):
    assert one(spark, text.numeric_value(F.lit(token).cast("string"))) == value


@pytest.mark.parametrize("label,yes", [("2θ (degree)", True), ("2 theta degree", True), ("20 (degree)", True), ("Wavelength (nm)", False), ("10 20 30 40", True), ("", False)])
def test_angle_axis(spark, label, yes):
    assert one(spark, text.angle_axis(F.lit(label))) is yes


def test_label_keys(spark):
    key = lambda s: one(spark, text.label_key(F.lit(s)))
    assert {key(s) for s in ("TpPa1", "Tp-Pa-1", "TpPa-1", "TpPa<sub>1</sub>", "TpPa₁")} == {"tppa1"}
    assert key("COF@S") != key("COFs") and key("α-X") == "alphax"
    kinds = {"tppa1": "specific", "cof": "generic", "iminecof": "generic", "cof1": "serial", "mcof": "paper_local", "cof300": "specific", "ab": "paper_local"}
    assert {k: one(spark, text.specificity(F.lit(k))) for k in kinds} == kinds


def test_figure_label(spark):
    assert one(spark, text.figure_label(F.lit("Figure 3. Pattern of a thing"))) == "Figure 3"


def test_markup():
    assert markup.strip("Fe<sub>3</sub>O<sub>4</sub> films<br/>on glass") == "Fe3O4 films on glass" and markup.strip(None) is None


def curve(peaks, noise=0.2, low=2.0, high=40.0, n=1900, seed=1):
    x = np.linspace(low, high, n)
    y = 20 * np.exp(-x / 30) + sum(h * np.exp(-0.5 * ((x - c) / w) ** 2) for c, h, w in peaks)
    return x, y + np.random.default_rng(seed).normal(0, noise, n)


def test_first_peak_of_a_curve():
    x, y = curve([(4.7, 100, 0.1), (8.1, 40, 0.1), (26.0, 15, 2.0)])
    r = signal.first_peak(x, y)
    assert r["status"] == "ok" and abs(r["two_theta"] - 4.7) < 0.02 and abs(r["fwhm"] - 2.3548 * 0.1) < 0.02
    assert signal.first_peak(x[:50], y[:50]) is None and signal.first_peak(np.zeros(100), y[:100]) is None
    assert signal.first_peak(x, 0 * x) == {"status": "no_bragg_peak"}


def test_first_peak_statuses():
    # a broad hump alone is no Bragg peak
    assert signal.first_peak(*curve([(20.0, 60, 4.0)], noise=0.05))["status"] == "no_bragg_peak"
    # a peak whose flank runs into the start, and one that a descent at the start makes doubtful
    assert signal.first_peak(*curve([(2.2, 100, 0.06)]))["status"] == "truncated_at_window_start"
    x, y = curve([(8.0, 60, 0.1)])
    y = y + 100 * np.exp(-(x - 2.0) / 0.4)
    r = signal.first_peak(x, y)
    assert r["status"] == "low_confidence" and abs(r["two_theta"] - 8.0) < 0.02


def test_write_back_of_a_first_peak():
    found = {"status": "ok", "two_theta": 4.7, "snr": 57.36, "fwhm": 0.23604}
    made = signal.with_spacing(found, None)
    assert made == {"status": "ok", "two_theta": 4.7, "snr": 57.4, "fwhm": 0.236, "d": round(1.5406 / (2 * math.sin(math.radians(2.35))), 3), "wavelength": 1.5406, "assumed": 1}
    assert [(signal.with_spacing(found, w)["wavelength"], signal.with_spacing(found, w)["assumed"]) for w in (0.7107, 0.4, 3.0, 0.39)] == [(0.7107, 0), (1.5406, 1), (1.5406, 1), (1.5406, 1)]
    assert signal.with_spacing({"status": "no_bragg_peak"}, 1.0)["d"] is None


def test_detect_peaks_by_hand():
    y = np.array([50, 60, 50, 100, 50, 55, 52, 70, 50.0])
    x = np.arange(9.0)
    # range 50; prominences 10, 50, 3 and 20; heights over the floor of 50
    assert signal.detect_peaks(x, y) == [(1.0, 0.2, 0.2, 60.0), (3.0, 1.0, 1.0, 100.0), (5.0, 0.1, 0.06, 55.0), (7.0, 0.4, 0.4, 70.0)]
    # 0.1 degrees are five steps of 0.02, or four as floats divide and are cut: of peaks 3 samples apart the higher stays
    close = np.zeros(30)
    close[[5, 8, 15]] = 3, 2, 1
    assert [p[0] for p in signal.detect_peaks(0.02 * np.arange(30), close)] == [0.1, 0.3]
    assert signal.detect_peaks(x, 0 * y) == [] and signal.detect_peaks(x[:0], y[:0]) == []
    many = np.tile([0.0, 1.0], 60)
    many[1::2] += np.arange(60) / 100
    assert len(signal.detect_peaks(np.arange(120.0), many)) == 40 and signal.detect_peaks(np.arange(120.0), many)[0][0] == 39.0


def test_prominences_and_widths_by_hand():
    y = np.array([0, 2, 1, 5, 0, 3, 3, 0, 4.0])
    peaks = signal.maxima(y)
    prom, left, right = signal.prominences(y, peaks)
    assert peaks.tolist() == [1, 3, 5] and prom.tolist() == [1, 5, 3] and left.tolist() == [0, 0, 4] and right.tolist() == [2, 4, 7]
    width, begins = signal.widths(y, peaks, prom, left, right)
    assert np.allclose(begins, [0.75, 2.375, 4.5]) and np.allclose(width, [1 + 0.5 - 0.75, 3.5 - 2.375, 6.5 - 4.5])


def test_descriptors_by_hand():
    x = np.arange(2, 40.01, 0.02)
    y = 30 * np.exp(-0.5 * ((x - 24) / 2.5) ** 2)
    d = signal.descriptors(x, y)
    assert d["hump_window_covered"] == 1 and abs(d["hump_center"] - 24) < 0.05 and abs(d["hump_height"] - 30) < 0.6 and abs(d["hump_fwhm"] - 2.3548 * math.hypot(2.5, 0.6)) < 0.25
    assert d["intensity_ratio_100_001"] is None
    both = signal.descriptors(x, y + 60 * np.exp(-0.5 * ((x - 5) / 0.1) ** 2), 5.0, 0.24)
    assert abs(both["intensity_ratio_100_001"] - 2.0) < 0.1 and both["hump_center"] == d["hump_center"]
    # the only rise lies under the mask of the first peak: no hump
    assert signal.descriptors(x, y, 24.0, 3.0)["hump_center"] is None
    short = signal.descriptors(x[:600], y[:600])
    assert short["hump_window_covered"] == 0 and short["crystalline_fraction"] is not None
    assert set(signal.descriptors(x[:40], y[:40]).values()) == {None, 0} and signal.descriptors(x, 0 * x)["crystalline_fraction"] is None
    assert signal.descriptors(x, 0.01 * np.exp(-0.5 * ((x - 24) / 2) ** 2))["hump_center"] is None  # under the floor of 0.02


def test_shape_verdicts_by_hand():
    line = np.linspace(0, 1, 200)
    assert signal.shape_verdict(line + 0.015 * (np.arange(200) % 2))["reasons"] == "sawtooth=1.000"
    assert signal.shape_verdict(line + 0.0035 * (np.arange(200) % 2))["flagged"] is False
    stairs = np.repeat([0.0, 0.5, 1.0], 40)
    assert signal.shape_verdict(stairs)["reasons"] == "steps=2" and signal.shape_verdict(stairs[:80])["steps"] == 1
    cut = line.copy()
    cut[[60, 100, 140]] -= 0.3
    assert signal.shape_verdict(cut)["reasons"].startswith("notches=3")
    assert signal.shape_verdict(np.zeros(100))["reasons"] == signal.shape_verdict(line[:59])["reasons"] == "degenerate"
    wild = np.where(np.arange(60) % 2 == 0, 0.0, 1.0)
    assert signal.shape_verdict(np.append(wild, np.nan))["reasons"].endswith("sawtooth=1.000;tv=59.0")


def test_processing_by_hand():
    x = np.arange(0, 20, 0.05)
    y = 5 + 80 * np.exp(-0.5 * ((x - 8) / 0.3) ** 2)
    grid, v, peaks = signal.process_curve(x, y, np.full(400, 5.0), 0.02)
    assert len(grid) == math.ceil((19.95 + 0.02) / 0.02) and v.max() == pytest.approx(100) and v.min() >= 0
    assert len(peaks) == 1 and abs(peaks[0][0] - 8) < 0.01 and peaks[0][1] == 100.0
    grid, v, peaks = signal.process_curve(x, np.full(400, 7.0), np.full(400, 7.0), 0.02)
    assert len(v) == len(grid) == 999 and not v.any() and peaks == []
    grid, v = signal.interpolate(np.array([0.0, 1.0]), np.array([2.0, 4.0]), 0.3)
    assert np.allclose(grid, [0, 0.3, 0.6, 0.9, 1.2]) and np.allclose(v, [2, 2.6, 3.2, 3.8, 4])
    grid, _ = signal.interpolate(np.array([0, 1e6]), np.array([0, 1.0]), 0.02)
    assert len(grid) == 20_000 and grid[0] == 0 and grid[-1] == 1e6
    # the prominence asked is 8 % of the top, 2.5 at least, times the scale, 0.5 at least
    y = np.zeros(60)
    y[[10, 30, 50]] = 20, 2, 0.6
    at = lambda scale: [round(p) for p, _ in signal.pick_peaks(np.arange(60.0), y, scale)]
    assert at(1.0) == [10] and at(0.7) == [10, 30] and at(0.1) == [10, 30, 50]
    got = signal.pick_peaks(np.arange(5.0), np.array([0, 6, 10, 8, 0.0]))
    assert got[0][0] == pytest.approx(2 + 0.5 * (6 - 8) / (6 - 20 + 8)) and got[0][1] == round(10 - 0.25 * (6 - 8) / 6, 2)
    short = np.arange(6.0) ** 2
    assert (signal.smooth(short, 7, 2) == short).all() and (signal.smooth(short[:3], 3, 2) == short[:3]).all()


def test_kernels():
    y = np.arange(50.0) ** 2
    assert np.allclose(signal.smooth(y, 7, 2), y) and np.allclose(signal.smooth(y, 6, 2), y)
    assert np.allclose(signal.gaussian_filter(np.ones(40), 3), 1)
    assert signal.percentile_filter(np.array([5.0, 1, 4, 2, 3]), 50, 3).tolist() == [5, 4, 2, 3, 3]
    ramp = np.linspace(0, 10, 200)
    base = signal.asls(ramp + 50 * (np.abs(np.arange(200) - 100) < 4), 1e5)
    assert np.abs(base - ramp).max() < 1.5 and signal.asls(np.ones(2)).tolist() == [0, 0]
    rng = np.random.default_rng(0)
    curves = [rng.random(n) for n in (30, 41, 30, 2, 0)]
    assert all(np.allclose(a, signal.asls(c, 1e3)) for a, c in zip(signal.asls_many(curves, stiffness=1e3), curves))
    for n in (3, 4, 30):
        a, b, c, v = rng.random((2, n)) + 5, rng.random((2, n)), rng.random((2, n)), rng.random((2, n))
        for i in range(2):
            full = np.diag(a[i]) + np.diag(b[i, :-1], 1) + np.diag(b[i, :-1], -1) + np.diag(c[i, :-2], 2) + np.diag(c[i, :-2], -2)
            assert np.allclose(signal.solve_five(a, b, c, v)[i], np.linalg.solve(full, v[i])) and np.allclose(signal.solve_five(a[i], b[i], c[i], v[i]), np.linalg.solve(full, v[i]))
    assert signal.maxima(np.array([0, 1, 1, 0, 2, 0])).tolist() == [1, 4]


def test_fidelity_of_profiles():
    x = np.arange(400.0)
    drawn = 60 * np.exp(-x / 150) + sum(100 * h * np.exp(-0.5 * ((x - c) / 6) ** 2) for c, h in ((100, 1.0), (250, 0.5)))
    same = signal.peak_fidelity(drawn, drawn)
    assert (same["status"], same["n_peaks"], same["worst_loss"], same["worst_gain"], same["ratio_distortion_log2"], same["flagged"]) == ("ok", 2, 0.0, 0.0, 0.0, False)
    cut = signal.amputated(drawn)
    assert cut.max() < 0.6 * drawn.max() and signal.peak_fidelity(drawn, cut)["flagged"]
    bar = drawn.copy()
    bar[300:330] = 80  # a flat top with upright sides is no peak
    assert signal.peak_fidelity(bar, bar)["n_peaks"] == 2
    assert signal.peak_fidelity(np.full(400, 3.0), drawn)["status"] == "env_occluded"
    assert signal.peak_fidelity(np.where(x < 100, drawn, np.nan), np.where(x > 50, drawn, np.nan))["status"] == "little_overlap"


def test_curves_as_arrays_and_as_points(spark):
    rows = [(1, [1.0, None, 3.0, float("nan"), 2.0]), (2, None), (3, []), (4, [9.0])]
    arrays = spark.createDataFrame([(k, y, "c") for k, y in rows], "k long, y array<double>, label string")
    kernel = lambda x, y: [(float(a), float(b)) for a, b in zip(x, y)]
    got = signal.per_curve(arrays, "k", lambda n: -np.arange(n), "y", kernel, "a double, b double")
    assert [tuple(r) for r in got.collect()] == [(1, -4.0, 2.0), (1, -2.0, 3.0), (1, 0.0, 1.0), (4, 0.0, 9.0)]
    assert got._jdf.queryExecution().toString().count("Exchange") == 0
    points = spark.createDataFrame([("a", 2.0, 5.0), ("a", 1.0, 6.0), ("b", None, 1.0)], "s string, x double, y double")
    assert [tuple(r) for r in signal.per_series(points, "s", "x", "y", kernel, "a double, b double").collect()] == [("a", 1.0, 6.0), ("a", 2.0, 5.0)]
    assert signal.per_curve(arrays.limit(0), "k", lambda n: np.arange(n), "y", kernel, "a double, b double").count() == 0


def test_beta_shares(spark):
    from ridgeline.operators import groups

    t = np.linspace(0, 1, 400_001)
    for a, b in ((2.3, 5.0), (30.0, 4.5), (300.0, 700.0)):
        density = t ** (a - 1) * (1 - t) ** (b - 1)
        share = np.cumsum(density) / density.sum()
        for q in (0.025, 0.5, 0.975):
            assert groups.beta_quantile(q, np.array([a]), np.array([b]))[0] == pytest.approx(t[np.searchsorted(share, q)], abs=1e-4)
    rng = np.random.default_rng(5)
    given = [(f"g{i}", int(n), int(rng.binomial(n, p))) for i, (n, p) in enumerate(zip(rng.integers(5, 200, 40), rng.beta(4, 8, 40)))]
    rows = spark.createDataFrame(given, "g string, n long, hits long").repartition(5)
    kept = [(n, h) for _, n, h in given if n >= 15]
    axis = np.linspace(0.3, 60, 120)
    ln = lambda a, b: math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    a, b = max(((a, b) for a in axis for b in axis), key=lambda ab: sum(ln(ab[0] + h, ab[1] + n - h) - ln(*ab) for n, h in kept))
    pooled = sum(h for _, h in kept) / sum(n for n, _ in kept)
    got = {r.g: r for r in groups.beta_binomial(rows, "g").collect()}
    assert set(got) == {g for g, n, _ in given if n >= 15}
    for r in got.values():
        assert r["mean"] == pytest.approx((a + r.hits) / (a + b + r.n)) and r.lift == pytest.approx(r["mean"] - pooled)
        assert r.low < r["mean"] < r.high and r.off_pool == (r.low > pooled or r.high < pooled)
    assert groups.beta_binomial(rows.limit(0), "g").count() == 0


def test_lines():
    x = np.arange(7.0) * 10
    y = x / 2 + 1
    y[3] = 99.0
    assert calibration.robust_line(x, y)[2] < 0.1 and calibration.robust_line([1], [1]) is None
    m, c, r = calibration.paired([0, 10, 20, 30, 40, 50, 60, 70, 80], [10, 20, 30, 40, 50])
    assert (round(m, 6), round(c, 6)) == (0.5, 10.0)


def test_upsert_changes_only_given_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, s string")
    assert sorted(map(tuple, joins.upsert(old, new, "k").collect())) == [(1, "a", 1), (2, None, 2), (3, "c", None)]


def test_search_refuses_and_pages(spark):
    rows = spark.range(25).selectExpr("concat('s', id) AS series_id", "'p' AS paper_id", "'f' AS figure_id", "'m' AS material", "CAST(id AS DOUBLE) AS first_peak", "'clean' AS admission", "'ok' AS first_peak_status", "'v' AS axis_verification", "NULL AS uncertainty")
    for bad in ({"nope": 1}, {"limit": 0}, {"limit": "x"}, {"first_peak_min": 3, "first_peak_max": 2}, {"admission": "dirty"}, {"sort": "size"}, {"paper_id": "a b"}):
        with pytest.raises(search.BadParameter):
            search.curves(rows, **bad)
    seen, offset = [], 0
    while offset is not None:
        page = search.curves(rows, sort="first_peak", limit=7, offset=offset)
        seen += [r.series_id for r in page.rows.collect()]
        offset = page.next_offset(page.total())
    assert seen == [f"s{i}" for i in range(25)]
    past = search.curves(rows, offset=100)
    assert past.rows.count() == 0 and past.total() == 25 and past.next_offset(25) is None


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "t.csv").write_text('﻿series_id,label,two_theta_deg,relative_intensity\r\ns1,"a ""b""\nc",1.0,2\r\ns1,x,bad,3\r\ns1,x,2.0,4\r\ns2,x,1,1\r\n', encoding="utf-8")
    rows = files.csv_table(spark, str(tmp_path / "t.csv"), {"series_id": [], "series_label": ["label"], "two_theta_deg": [], "relative_intensity": []})
    assert rows.first().series_label.replace("\r", "") == 'a "b"\nc'
    points = files.curve_points(rows).withColumn("figure_id", F.lit("f1"))
    assert points.count() == 2
    files.write_figures(points, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 2 and len(list((tmp_path / "out" / "figure_id=f1").glob("*.csv.gz"))) == 1
    assert files.content_hash(points).first().hash == files.content_hash(points.orderBy(F.desc("two_theta_deg"))).first().hash
    manifest = files.export(points, points, points, str(tmp_path / "release")).first()
    assert manifest.curves == 2


def test_reports(spark, tmp_path):
    for i, s in enumerate(("accepted", "rejected", "partial")):
        (tmp_path / f"p{i}").mkdir()
        (tmp_path / f"p{i}" / "result.json").write_text(f'{{"figure_id": "f{i}",\n "status": "{s}", "series": []}}')
    assert sorted(r.figure_id for r in files.reports(spark, str(tmp_path)).collect()) == ["f0", "f2"]


def test_streaming_ingest_is_resumable(spark, tmp_path):
    schema = "doc_id long, text string"
    for n in range(2):
        spark.createDataFrame([(n * 2 + i, "t") for i in range(2)], schema).write.parquet(str(tmp_path / "in" / f"b{n}"))
        for f in (tmp_path / "in" / f"b{n}").glob("*.parquet"):
            f.rename(tmp_path / "in" / f"{n}-{f.name}")
        streaming.ingest(spark, str(tmp_path / "in" / "*.parquet"), schema, str(tmp_path / "out"), str(tmp_path / "check"), "doc_id")
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2, 3]
    streaming.ingest(spark, str(tmp_path / "in" / "*.parquet"), schema, str(tmp_path / "out"), str(tmp_path / "check"), "doc_id")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_content_hash_tells_repeated_rows(spark):
    rows = spark.createDataFrame([("f1", "a"), ("f1", "a"), ("f2", "b"), ("f2", "b"), ("f3", None), ("f4", "\x00")], "figure_id string, v string")
    found = {r.figure_id: r.hash for r in files.content_hash(rows.withColumn("figure", F.col("figure_id")).drop("figure").selectExpr("figure_id", "v")).collect()}
    alike = files.content_hash(rows.selectExpr("'g' AS figure_id", "v", "figure_id AS f").where("f in ('f1')").drop("f")).first().hash
    other = files.content_hash(rows.selectExpr("'g' AS figure_id", "v", "figure_id AS f").where("f in ('f2')").drop("f")).first().hash
    assert len(set(found.values())) == 4 and alike != other


def test_curve_data(spark):
    curves = spark.createDataFrame([("s1", "f1", 0.2, "figures/1.csv.gz"), ("s2", "f2", None, None)], "series_id string, figure_id string, uncertainty double, data_path string")
    points = spark.createDataFrame([("s1", 2.0, 5.0), ("s1", 1.0, 7.5), ("s3", 1.0, 1.0)], "series_id string, two_theta_deg double, relative_intensity double")
    one = search.curve_data(curves, points, series_id="s1").first()
    assert (one.point_count, one.two_theta_deg, one.relative_intensity, one.two_theta_uncertainty_deg) == (2, [1.0, 2.0], [7.5, 5.0], 0.2)
    assert [r.line for r in search.curve_data(curves, points, series_id="s1", format="csv").orderBy("n").collect()] == ["two_theta_deg,relative_intensity", "1.0,7.5", "2.0,5.0"]
    assert search.curve_data(curves, points, series_id="s9").count() == 0 and search.figure_data(curves, figure_id="f2").count() == 0
    assert search.figure_data(curves, figure_id="f1").first().data_path == "figures/1.csv.gz"
    for bad, rows in (({"series_id": "s1", "format": "xml"}, points), ({}, points), ({"series_id": "s1"}, points.drop("two_theta_deg")), ({"series_id": "s1", "x": 1}, points)):
        with pytest.raises(search.BadParameter):
            search.curve_data(curves, rows, **bad)


def test_pixels(spark):
    from ridgeline.operators import pixels

    rng = np.random.default_rng(9)
    h, w = 100, 40
    mask = rng.random((h, w)) < 0.05
    mask[:, 5] = mask[:, 38] = mask[:, 39] = False
    anchor = 40 + 10 * np.sin(np.arange(w) / 6)
    anchor[:2] = np.nan
    trace = np.where(np.arange(w) % 7 == 0, np.nan, np.round(anchor) + rng.integers(-4, 5, w))
    num = lambda v: None if np.isnan(v) else float(v)
    cols = spark.createDataFrame([("p", c, num(anchor[c]), num(trace[c])) for c in range(w)], "key string, col long, anchor double, trace double")
    ink = spark.createDataFrame([("p", int(c), int(r)) for r, c in zip(*np.nonzero(mask))], "key string, col long, row long")
    off = np.where(mask, np.abs(np.arange(h)[:, None] - np.nan_to_num(trace, nan=1e9)), np.inf)
    band = mask & (np.abs(np.arange(h)[:, None] - np.nan_to_num(anchor, nan=1e9)) <= 10)
    got = pixels.trace_fidelity(cols, ink, "key", F.lit(h)).first()
    assert got.n_eval_cols == np.isfinite(trace).sum() and got.precision == pytest.approx((off.min(0) <= 3).sum() / np.isfinite(trace).sum())
    assert got.recall == pytest.approx((np.where(band, off, np.inf).min(0) <= 3).sum() / band.any(0).sum())
    everywhere = pixels.trace_fidelity(cols, ink, "key", F.lit(h), anchored=False).first()
    assert everywhere.recall == pytest.approx((off.min(0) <= 3).sum() / mask.any(0).sum())
    y, hit = np.full(w, np.nan), np.zeros(w, bool)
    for c in range(2, w):
        rows = [r for r in np.flatnonzero(mask[:, c]) if int(anchor[c]) - 4 <= r <= int(anchor[c]) + 4]
        weights = [1 / (1 + ((r - anchor[c]) / 2) ** 2) for r in rows]
        y[c], hit[c] = (np.average(rows, weights=weights), True) if rows else (anchor[c], False)
    v = y[2:].copy()
    wide = np.concatenate([[v[0]] * 2, v, [v[-1]] * 2])
    mid = np.array([np.median(wide[i : i + 5]) for i in range(len(v))])
    v = np.where(np.abs(v - mid) > 6, mid, v)
    ends = np.flatnonzero(hit)
    want = {c: (v[c - 2], bool(hit[c])) for c in range(ends[0], ends[-1] + 1)}
    found = {r.col: (r.y, r.snapped) for r in pixels.snapped(cols, ink, "key", F.lit(h)).collect()}
    assert found.keys() == want.keys() and all(found[c][0] == pytest.approx(want[c][0]) and found[c][1] == want[c][1] for c in want)
    dots = [(250.0 - i % 3, 10.0, 10.0 + i % 2, 5.0) for i in range(60)] + [(10.0, 20.0, 240.0, 9.0)] * 40 + [(10.0, 200.0, 20.0, 1.0)] * 10
    colours = pixels.ink_colours(spark.createDataFrame(dots, "r double, g double, b double, row double"), 3).collect()
    assert sorted((r["size"], r.row) for r in colours) == [(40, 9.0), (60, 5.0)]
    assert pixels.ink_colours(spark.createDataFrame([], "r double, g double, b double, row double"), 3).count() == 0
    white = spark.range(1).select(*(c.alias(n) for c, n in zip(pixels.lab(F.lit(255.0), F.lit(255.0), F.lit(255.0)), "lab"))).first()
    assert white.l == pytest.approx(100, abs=0.01) and abs(white.a) < 0.02 and abs(white.b) < 0.02


def test_sitemap_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "SITEMAP_ROWS", 10)
    papers = spark.createDataFrame([(f"p {i}",) for i in range(35)] + [(None,)], "paper_id string")
    files.write_sitemap(files.sitemap(papers, "https://x.org"), str(tmp_path / "s"), "https://x.org")
    found = [f.read_text() for f in (tmp_path / "s" / "sitemap").rglob("*.txt")]
    assert all(t.startswith("<?xml") and t.count("<loc>") <= 10 for t in found) and sum(t.count("<loc>") for t in found) == 37
    assert any("https://x.org/paper/p%207<" in t for t in found)
    assert "Disallow: /auth/" in next((tmp_path / "s" / "robots").glob("*.txt")).read_text()


def test_spread_equals_the_walk(spark):
    rng = np.random.default_rng(4)
    rows = [(int(k), int(i), float(v)) for k in range(6) for i, v in enumerate(rng.uniform(-5, 60, rng.integers(1, 12)))]
    got = calibration.spread(spark.createDataFrame(rows, "k long, i long, v double"), "k", "v", "i", 4.0, 0.0, 50.0).collect()
    for k in range(6):
        assert sorted(r.v for r in got if r.k == k) == pytest.approx(sorted(calibration.spread_labels([v for a, _, v in rows if a == k], 4.0, 0.0, 50.0)))


def _plain(v):
    if v is None or isinstance(v, (str, bool, datetime.date)):
        return str(v)
    if isinstance(v, (float, int, decimal.Decimal)):
        return "nan" if math.isnan(v) else repr(float(f"{float(v):.12g}"))
    return str(v)


@pytest.fixture(scope="module")
def duck():
    import os

    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{DATA}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    rows = [[_plain(v) for v in r] for r in df.collect()]
    found = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    expected = [[_plain(r[names.index(c)]) for c in df.columns] for r in found.fetchall()]
    assert sorted(rows) == sorted(expected)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, DATA).count() >= 1


def test_targets_and_descriptions():
    assert search.peak_target("  ") is None and search.peak_target("3.4") == 3.4
    assert search.peak_target("26", "d") == pytest.approx(3.3955, abs=1e-3)
    for bad, unit in (("x", "two_theta"), ("-1", "two_theta"), ("95", "two_theta"), ("0.5", "d")):
        with pytest.raises(search.BadParameter):
            search.peak_target(bad, unit)
    assert "0.1°" in search.describe(3.4, 0.1) and "assumed" in search.describe(3.4, 0.1, 26.0)


@pytest.mark.parametrize(
    "seen,meant",
    [
        ([10, 20, 3, 40], [10, 20, 30, 40]),  # lost zero, one step further
        ([5, 15, 25, 5, 45], [5, 15, 25, 35, 45]),  # lost leading digit
        ([20, 40, 60, 6], [20, 40, 60, 80]),
        ([10, 12], [10, 12]),
        ([10, 4], [10, 14]),  # no step is known: the least reading above
        ([10, 20, 32, 90], [10, 20, 32, 44]),  # off the line of the last two: the nearest reading, one step of 12 on
        ([10, 20, 33], [10, 20, 33]),  # within five of the line
        ([7], [7]),
        ([], []),
    ],
)
def test_tick_repair(spark, seen, meant):
    rows = spark.createDataFrame([(1, [(50.0 * i, float(v)) for i, v in enumerate(seen)])], "k int, ticks array<struct<px: double, value: double>>")
    got = calibration.repair_ticks(rows, "k").first().ticks
    assert [(t.px, t.value) for t in got] == [(50.0 * i, float(v)) for i, v in enumerate(meant)]


def test_tick_repair_names_its_steps_once(spark):
    """The fold's lambda said its steps over and over: 15,253 characters of plan."""
    rows = spark.createDataFrame([(1, [(0.0, 1.0), (50.0, 2.0)])], "k int, ticks array<struct<px: double, value: double>>")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        assert len(calibration.repair_ticks(rows, "k")._jdf.queryExecution().optimizedPlan().toString()) < 8000
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def _paired_one(ticks, labels):
    """One row at a time, each fit by robust_line."""
    t, v, best = sorted(ticks), sorted(labels), None
    if len(v) < 2 or len(t) < len(v):
        return None
    for k in (1,) if len(t) == len(v) else (1, 2, 5):
        for offset in range(len(t) - k * (len(v) - 1)):
            x = np.array([t[offset + k * i] for i in range(len(v))])
            fit = calibration.robust_line(x, np.array(v), 0)
            if fit is None or fit[2] >= 0.25:
                continue
            wide = (x[-1] - x[0]) >= 0.75 * (t[-1] - t[0]) if t[-1] > t[0] else False
            rank = (not wide, round(fit[2], 9), k, offset)
            if best is None or rank < best[0]:
                best = (rank, fit)
    return best[1][:3] if best else None


def test_ticks_are_paired_many_rows_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(300):
        v = (10.0 + 10 * np.arange(rng.integers(0, 7))).tolist()
        t = (rng.integers(0, 40) + 7.0 * np.arange(rng.integers(0, 12)) + rng.choice([0, 0.05, 0.5]) * rng.normal(size=1)).tolist()
        rows.append((i, t[::-1], v) if i % 5 else (i, [4.0] * 6, v))
    want = {i: _paired_one(t, v) for i, t, v in rows}
    rows += [(300, None, [1.0, 2.0]), (301, [0.0, 1.0, 2.0], None), (302, [0.0, None, 1.0, float("nan")], [1.0, 2.0])]
    want |= {300: None, 301: None, 302: (1.0, 1.0, 0.0)}
    asked = []
    real = calibration.robust_line
    monkeypatch.setattr(calibration, "robust_line", lambda *a: asked.append(1) or real(*a))
    df = spark.createDataFrame(rows, "k long, ticks array<double>, labels array<double>").coalesce(1)
    got = {r.k: None if r.slope is None else (r.slope, r.intercept, r.rmse) for r in calibration.pair_ticks(df, "k").collect()}
    assert set(got) == set(want) and all((got[k] is None) == (want[k] is None) and (got[k] is None or got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12)) for k in want)
    assert sum(w is not None for w in want.values()) > 60
    many = np.tile(20.0 + 40 * np.arange(9), (200_000, 1)), np.tile(10.0 + 10 * np.arange(5), (200_000, 1))
    start = __import__("time").process_time()
    assert calibration.paired_many(*many)[-1] == pytest.approx([0.125, 7.5, 0]) and __import__("time").process_time() - start < 8 and not asked  # a row at a time: over a minute


def test_tick_repair_sorts_and_drops(spark):
    kind = "k int, ticks array<struct<px: double, value: double>>"
    rows = spark.createDataFrame([(1, [(100.0, 30.0), (0.0, 10.0), (50.0, 20.0)]), (2, [(0.0, 10.0), (0.5, 20.0), (1.0, -400.0)]), (3, None)], kind)
    got = {r.k: r.ticks and [(t.px, t.value) for t in r.ticks] for r in calibration.repair_ticks(rows, "k").collect()}
    assert got == {1: [(0.0, 10.0), (50.0, 20.0), (100.0, 30.0)], 2: [(0.0, 10.0), (0.5, 20.0), (1.0, 30.0)], 3: None}
    assert calibration.repair_ticks(rows, "k")._jdf.queryExecution().toString().count("Python") == 0


def test_label_spread():
    assert calibration.spread_labels([1, 1, 9.5], 2, 0, 10) == [1, 3, 9.5]


def test_curves_are_held_in_slices(spark):
    """A batch of 10,000 curves used to be held as Python tuples all at once: `many` got them in one call."""
    sizes = [(i % 7) * 9 for i in range(3000)] + [40_000, 0, 3, 50_000, 5]
    rows = spark.range(len(sizes)).select("id", F.get(F.array(*map(F.lit, [0, 9, 18, 27, 36, 45, 54])), (F.col("id") % 7).cast("int")).alias("n"))
    for i in range(3000, len(sizes)):
        rows = rows.withColumn("n", F.when(F.col("id") == i, sizes[i]).otherwise(F.col("n")))
    curves = rows.select("id", F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), F.col("n")), lambda v: (v + F.col("id")).cast("double"))).when(F.col("id") % 2 == 0, F.array().cast("array<double>")).alias("y")).coalesce(1)

    def many(xs, ys):
        return [[(len(ys), sum(map(len, ys)), len(v), float(v.sum()))] for v in ys]

    got = signal.per_curve(curves, "id", lambda n: np.arange(n, dtype=float), "y", None, "curves long, samples long, n long, total double", many=many).collect()
    assert {r.id: (r.n, r.total) for r in got} == {i: (n, n * (n + 1) / 2 + n * i) for i, n in enumerate(sizes)} and len(got) == len(sizes)
    assert max(r.curves for r in got) <= signal.CURVES_AT_ONCE and all(r.samples <= signal.SAMPLES_AT_ONCE or r.curves == 1 for r in got)
