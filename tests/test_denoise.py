"""Resampling against a direct convolution, and principal components against a dense decomposition."""

import math

import numpy as np
import pytest

from lumenflow.operators import denoise, resampling


def _plain(x, up, down):
    """Zeros between the frames, the whole convolution, every ``down``-th value."""
    h = resampling.low_pass(up, down)
    m = np.median(x)
    wide = np.zeros(len(x) * up)
    wide[::up] = x - m
    whole = np.convolve(wide, h)[len(h) // 2 :]
    n = math.ceil(len(x) * up / down)
    return whole[::down][:n] + m


@pytest.mark.parametrize("rates", [(31, 4), (11, 4), (30, 10), (12, 8)])
def test_resampling_against_a_convolution(spark, rates):
    rng = np.random.default_rng(rates[0])
    traces = {1: rng.normal(5, 1, 400), 2: np.sin(np.arange(97) / 9), 3: np.array([2.0])}
    df = spark.createDataFrame([(k, t * 3, float(v)) for k, x in traces.items() for t, v in enumerate(x)], "roi int, t int, f double").repartition(4)
    got = {}
    for r in resampling.resampled(df, *rates).orderBy("roi", "t").collect():
        got.setdefault(r.roi, []).append(r.f)
    up, down = resampling.ratio(*rates)
    for k, x in traces.items():
        assert np.allclose(got[k], _plain(x, up, down))


def test_the_filter():
    h = resampling.low_pass(4, 31)
    assert len(h) == 621 and math.isclose(h.sum(), 4) and np.allclose(h, h[::-1])
    # a constant stays, a slow wave passes, a fast one doesn't
    t = np.arange(3000)
    assert np.allclose(_plain(np.full(300, 7.0), 4, 31), 7)
    slow, fast = (_plain(np.sin(2 * np.pi * f * t / 31), 4, 31)[40:-40] for f in (0.5, 3.5))
    assert slow.std() > 0.69 and fast.std() < 0.02


def test_gaps_and_rates(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, None), (2, 0, float("nan")), (2, 1, 1.0)], "roi int, t int, f double")
    assert {r.f for r in resampling.resampled(df, 31, 4).collect()} == {None}
    assert resampling.resampled(df.where("false"), 31, 4).count() == 0
    assert resampling.resampled(df, 5, 5).count() == 4
    with pytest.raises(ValueError):
        resampling.resampled(df, 4, 31)


def _movie(spark, frames):
    t, r, c = np.meshgrid(*map(np.arange, frames.shape), indexing="ij")
    return spark.createDataFrame(list(zip(*(x.ravel().tolist() for x in (r, c, t, frames)))), "r int, c int, t int, v double").repartition(4)


@pytest.mark.parametrize("kind", ["low rank", "noise"])
def test_components_against_a_dense_decomposition(spark, kind, monkeypatch):
    monkeypatch.setattr(denoise, "PIECE", 17)
    monkeypatch.setattr(denoise, "PIXELS_AT_ONCE", 13)
    rng = np.random.default_rng(1)
    frames = rng.normal(3, 1, (60, 9, 8))
    if kind == "low rank":
        frames = np.einsum("tk,kp->tp", rng.normal(size=(60, 3)), rng.normal(size=(3, 72))).reshape(60, 9, 8) * 5 + frames * 0.1
    flat = frames.reshape(60, -1)
    u, s, v = np.linalg.svd(flat - flat.mean(axis=0), full_matrices=False)
    want = (flat.mean(axis=0) + u[:, :4] @ np.diag(s[:4]) @ v[:4]).reshape(frames.shape)
    movie = _movie(spark, frames)
    got = {(r.t, r.r, r.c): r.v for r in denoise.denoised(movie, 4).collect()}
    assert np.allclose([got[t, r, c] for t in range(60) for r in range(9) for c in range(8)], want.ravel(), atol=1e-6)
    weights = np.zeros((4, 72))
    for r in denoise.pixel_weights(movie, 4).collect():
        weights[r.component, r.r * 8 + r.c] = r.weight
    assert np.allclose(np.abs((weights * v[:4]).sum(axis=1)), 1, atol=1e-6) and np.allclose(weights @ weights.T, np.eye(4), atol=1e-6)


def test_few_frames_and_odd_movies(spark):
    frames = np.random.default_rng(2).normal(size=(3, 4, 5))
    movie = _movie(spark, frames)
    whole = {(r.t, r.r, r.c): r.v for r in denoise.denoised(movie, 9).collect()}
    assert all(np.isclose(v, frames[k]) for k, v in whole.items()) and len(whole) == 60
    flat = denoise.denoised(_movie(spark, np.ones((4, 2, 2))), 2).collect()
    assert {r.v for r in flat} == {1.0}
    assert denoise.denoised(movie.where("false"), 2).count() == 0
    with pytest.raises(ValueError):
        denoise.denoised(movie.where("not (r = 1 and c = 1 and t = 2)"), 2)
