"""Unmixing of two planes, flags of stages, and the geometry of scanned regions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenflow.functions import kernels
from lumenflow.operators import decrosstalk, planes

PLACES = "region int, x double, y double, width double, height double, columns int, rows int"


def _sources(n=3000, seed=4):
    rng = np.random.default_rng(seed)
    events = (rng.random((2, n)) < 0.04) * rng.exponential(5, (2, n))
    decay = 0.8 ** np.arange(30)
    x = np.array([np.convolve(x, decay)[:n] for x in events]) + rng.normal(0, 0.05, (2, n))
    # chance correlation of the sources would be taken for mixing: none is left in them
    u, _, v = np.linalg.svd(x - x.mean(axis=1, keepdims=True), full_matrices=False)
    return u @ v * math.sqrt(n)


def _pairs(spark, *mixed):
    return spark.createDataFrame([(k, t, float(x[0, t]), float(x[1, t])) for k, x in enumerate(mixed) for t in range(x.shape[1])], "roi int, t int, signal double, crosstalk double")


def test_whitening(spark):
    x = np.array([[0.8, 0.2], [0.3, 0.7]]) @ _sources(400) + 5
    white, root = kernels.whitened(x)
    assert np.allclose(np.cov(white, ddof=0), np.eye(2)) and np.allclose(root, root.T)
    u, s, v = np.linalg.svd((x - x.mean(axis=1, keepdims=True)).T, full_matrices=False)
    assert np.allclose(white.T, u @ v * np.sqrt(x.shape[1]))
    flat = np.ones((2, 5))
    rows = decrosstalk.whitened(_pairs(spark, x, flat)).orderBy("roi", "t").collect()
    assert np.allclose(np.array([(r.x0, r.x1) for r in rows[:400]]).T, white) and all(r.x0 is None for r in rows[400:])


def test_unmixing_finds_the_matrix(spark):
    truth = np.array([[0.85, 0.15], [0.25, 0.75]])
    x = truth @ _sources()
    out, mixing, done = kernels.unmixed(x, 10, 0)
    assert done and np.abs(mixing - truth).max() < 0.03 and np.allclose(mixing @ out, x) and np.allclose(mixing.sum(axis=1), 1)
    turned, _, fine = kernels.unmixed(np.array([[0.3, 0.7], [0.8, 0.2]]) @ _sources(), 3, 0)
    assert not fine and abs(np.corrcoef(turned[0], _sources()[1])[0, 1]) > 0.98
    same = kernels.unmixed(np.vstack([x[0], x[0]]), 3, 0)
    assert not same[2] and (same[1] == np.eye(2)).all()
    rows = decrosstalk.unmixed(_pairs(spark, x[:, :900], x[:, :2])).orderBy("roi", "t").collect()
    want, m, good = kernels.unmixed(x[:, :900], 10, 0)
    assert len(rows) == 902 and np.allclose([r.signal for r in rows[:900]], want[0]) and rows[0].done == good and math.isclose(rows[0].m01, m[0, 1])
    assert not rows[-1].done and rows[-1].signal == x[0, 1]


def test_stage_flags(spark):
    lists = {1: ["raw"], 2: ["raw", "raw_active"], 3: ["unmixed"], 4: ["unmixed", "unmixed_active"], 5: [], 6: ["ghost"], 7: ["raw_active", "unmixed_active"]}
    regions = spark.createDataFrame([(k,) for k in lists], "roi int")
    failed = spark.createDataFrame([(k, s) for k, v in lists.items() for s in v], "roi int, stage string")
    got = {r.roi: tuple(int(x) for x in r[1:]) for r in decrosstalk.stage_flags(regions, failed).collect()}
    assert got == {1: (0, 0, 0, 0, 0), 2: (1, 0, 0, 0, 0), 3: (1, 1, 0, 0, 0), 4: (1, 1, 1, 0, 0), 5: (1, 1, 1, 1, 0), 6: (1, 1, 1, 1, 1), 7: (1, 0, 0, 0, 0)}


def test_invalid_regions_follow_as_gaps(spark):
    regions = spark.createDataFrame([(1,), (2,)], "roi int")
    trace = spark.createDataFrame([(1, t, 1.0) for t in range(4)], "roi int, t int, f double")
    rows = decrosstalk.with_invalid(trace, regions).collect()
    assert len(rows) == 8 and all(math.isnan(r.f) == (r.roi == 2) for r in rows)
    assert decrosstalk.with_invalid(trace.limit(0), regions).count() == 20_000
    mixing = spark.createDataFrame([(3, 0.5, False), (2, 0.7, False), (1, 0.9, True)], "roi int, m00 double, converged boolean")
    assert [tuple(r) for r in decrosstalk.first_open_mixing(mixing).collect()] == [(2, 0.7)]
    parts = decrosstalk.labelled_frames(spark.createDataFrame([(0, "train"), (1, "train"), (2, "validation")], "t int, part string"), trace.withColumn("f", F.col("t").cast("double")))
    assert sorted(tuple(r) for r in parts.collect()) == [("train", [0, 1], 0.5, 0.5), ("validation", [2], 0.5, 0.5)]


def test_scan_regions_must_agree(spark):
    row = (0, 1.0, 2.0, 3.0, 4.0, 5, 6)
    make = lambda *rows: spark.createDataFrame(list(rows), PLACES)
    assert [tuple(r) for r in planes.scan_regions(make(row, (0, 1.000001, *row[2:]))).drop("x").collect()] == [(0, *row[2:])]
    for other in ((0, 1.1, *row[2:]), (*row[:3], 3.1, *row[4:]), (*row[:5], 6, 6)):
        with pytest.raises(ValueError):
            planes.scan_regions(make(row, other))


def test_stitching(spark):
    regions = [(0, 30.0, 10.0, 20.0, 12.0, 10, 6), (1, 10.0, 10.0, 20.0, 12.0, 10, 6)]
    image = np.arange(15 * 10, dtype=float).reshape(15, 10) + 1
    pixels = spark.createDataFrame([(r, c, float(image[r, c])) for r in range(15) for c in range(10)], "r int, c int, v double")
    got = np.zeros((6, 20))
    for r in planes.stitched(pixels, spark.createDataFrame(regions, PLACES)).collect():
        got[r.r, r.c] = r.v
    assert (got == np.hstack([image[9:], image[:6]])).all()
    with pytest.raises(ValueError):
        planes.stitched(pixels.where("c < 9"), spark.createDataFrame(regions, PLACES))
    with pytest.raises(ValueError):
        planes.stitched(pixels, spark.createDataFrame([regions[0], (*regions[1][:5], 10, 5)], PLACES))


def test_stacks_need_one_owner(spark):
    pages = spark.createDataFrame([("a", p, 0, 0, float(p)) for p in range(4)], "path string, page int, r int, c int, v double")
    depths = spark.createDataFrame([("a", 0, 1.0), ("a", 0, 2.0), ("a", 1, 5.0)], "path string, side int, z double")
    modes = lambda *m: spark.createDataFrame([("a", g, x) for g, x in enumerate(m)], "path string, region int, mode int")
    got = sorted(tuple(r) for r in planes.stack_pages(pages, modes(0), depths).collect())
    assert got == [(0, 1.5, 0, 0, 0, 0.0), (0, 1.5, 1, 0, 0, 2.0), (0, 5.0, 0, 0, 0, 1.0), (0, 5.0, 1, 0, 0, 3.0)]
    for bad in (modes(1), modes(0, 0), modes(0, 1)):
        with pytest.raises(ValueError):
            planes.stack_pages(pages, bad, depths)


def test_shared_shift_and_decay_times(spark):
    shift = "up double, down double, right double, left double"
    assert tuple(planes.shared_shift(spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)] * 2, shift)).first()) == (1, 2, 3, 4)
    with pytest.raises(ValueError):
        planes.shared_shift(spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (1.0, 2.0, 3.0, 5.0)], shift))
    lookup = spark.createDataFrame([("g", 0.7)], "genotype string, decay double")
    session = lambda *rows: spark.createDataFrame(list(rows), "genotype string, decay double")
    got = [tuple(r) for r in planes.decay_times(session(("g", 0.1), ("g", None), (None, 0.2)), lookup).collect()]
    assert sorted(got, key=str) == sorted([("g", 0.7, True), ("g", 0.7, False), (None, 0.2, False)], key=str)
    for bad in (("h", 0.1), (None, None)):
        with pytest.raises(ValueError):
            planes.decay_times(session(bad), lookup).collect()


def test_outlines_windows_and_attributes(spark):
    image = spark.createDataFrame([(0, c, 100, 40, 0) for c in range(3)], "r int, c int, red int, green int, blue int")
    pixels = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (2, 0, 1)], "roi int, r int, c int")
    got = {r.c: (r.red, r.green, r.blue) for r in planes.outlined(image, pixels, (200, 41, 255), 0.5).collect()}
    assert got == {0: (150, 40, 128), 1: (175, 40, 192), 2: (100, 40, 0)}
    movie = spark.createDataFrame([(0, c, 0, float(c)) for c in range(10)], "r int, c int, t int, v double")
    assert [r.v for r in planes.scaled_window(movie, (0, 2), (1, 3), shares=(0.0, 1.0)).orderBy("c").collect()] == [0, 128, 255]
    for both in ({}, {"shares": (0, 1), "limits": (0, 1)}):
        with pytest.raises(ValueError):
            planes.scaled_window(movie, (0, 0), (1, 1), **both)
    graph = spark.createDataFrame([(0, 0, 0, 1, 0.5, 0.6)], "r0 int, c0 int, r1 int, c1 int, a double, b double")
    assert planes.attribute(graph.drop("b")) == "a" and planes.attribute(graph, "b") == "b"
    for name in (None, "z"):
        with pytest.raises(ValueError):
            planes.attribute(graph, name)


def test_edge_metrics_by_name(spark):
    rng = np.random.default_rng(0)
    movie = spark.createDataFrame([(r, c, t, float(rng.normal())) for r in range(3) for c in range(3) for t in range(12)], "r int, c int, t int, v double")
    for name, metric in planes.METRICS.items():
        rows = metric(movie, share=0.5, radius=2.0).collect()
        assert len(rows) == 20, name


def test_pairs_fitted_together_are_those_fitted_alone():
    rng = np.random.default_rng(8)
    pairs = [np.array([[0.9, 0.1], [0.2, 0.8]]) @ rng.laplace(size=(2, n)) for n in (40, 2, 300, 55, 41)] + [np.ones((2, 30)), np.vstack([np.arange(9.0)] * 2)]
    together = kernels.unmixed_all(pairs, 3, range(len(pairs)))
    for k, (x, got) in enumerate(zip(pairs, together)):
        want = kernels.unmixed(x, 3, k)
        assert got[2] == want[2] and np.allclose(got[0], want[0]) and np.allclose(got[1], want[1]) and got[0].shape == x.shape
    spread, axes = np.linalg.eigh((w := rng.normal(size=(2, 2))) @ w.T)
    assert np.allclose(kernels._orthonormal(w), axes / np.sqrt(spread) @ axes.T @ w) and np.allclose(kernels._orthonormal(w[::-1]), kernels._orthonormal(w)[::-1])


def test_whole_deviations_are_not_cut(spark):
    """Orders in which running means end below a deviation of just 1."""
    values = {0: [1.0, 0, -2, 0, 0, -1, 0, -2], 1: [0.0, -2, -2, 1, -1, 0, 0, 0], 2: [65535.0, 65533, 65535, 65533], 3: [1.0, 2, 4]}
    for order in (1, -1):
        rows = [(r, 0, 8 * k, float(v)) for r, own in values.items() for k, v in enumerate(own[::order])]
        got = {x.r: (x.mean, x.deviation) for x in planes.pixel_figures(spark.createDataFrame(rows, "r int, c int, t int, v double").coalesce(1)).collect()}
        assert got == {0: (0, 1), 1: (0, 1), 2: (65534, 1), 3: (2, 1)}
