"""Registration against planted shifts and direct loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenflow.functions import phase
from lumenflow.operators import registration as reg
from lumenflow.operators import rois

N, ROWS, COLUMNS = 40, 30, 36


def _image(seed=0, rows=ROWS, columns=COLUMNS):
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[:rows, :columns]
    return sum(rng.uniform(1, 3) * np.exp(-((y - rng.uniform(0, rows)) ** 2 + (x - rng.uniform(0, columns)) ** 2) / 6) for _ in range(25)) * 100 + 50


def _drift(seed=1):
    rng = np.random.default_rng(seed)
    planted = rng.integers(-4, 5, (N, 2))
    wide = _image(seed, ROWS + 20, COLUMNS + 20)
    frames = np.array([wide[10 - dy : 10 - dy + ROWS, 10 - dx : 10 - dx + COLUMNS] for dy, dx in planted]) + rng.normal(0, 4, (N, ROWS, COLUMNS))
    return planted, frames


def _movie(spark, frames):
    t, r, c = np.meshgrid(*map(np.arange, frames.shape), indexing="ij")
    return spark.createDataFrame(list(zip(*(x.ravel().tolist() for x in (r, c, t, frames)))), "r int, c int, t int, v double")


@pytest.fixture(scope="module")
def drift(spark):
    planted, frames = _drift()
    return planted, frames, _movie(spark, frames).cache()


def test_planted_shifts_are_found(drift):
    planted, frames, movie = drift
    settings = reg.Settings(most=0.4, sigma=1.0, frames=25)
    rows = reg.register(movie, settings).orderBy("t").collect()
    found = np.array([(r.dy, r.dx) for r in rows])
    off = found - planted
    assert len(rows) == N and (off == off[0]).all() and np.abs(off[0]).max() <= 2
    border = rois.motion_border(reg.register(movie, settings, reg.reference_image(movie, settings)).select("t", F.col("dx").cast("double").alias("x"), F.col("dy").cast("double").alias("y"))).first()
    assert border["left_side"] == max(0, -found[:, 1].min()) and border["bottom"] == max(0, found[:, 0].max())


def test_moved_pixels_are_rolled_back(spark, drift):
    planted, frames, movie = drift
    shifts = spark.createDataFrame([(t, int(dy), int(dx)) for t, (dy, dx) in enumerate(planted) if t != 3], "t int, dy int, dx int")
    got = {(r.t, r.r, r.c): r.v for r in reg.moved(movie, shifts).collect()}
    want = np.array([np.roll(f, (-dy, -dx), (0, 1)) if t != 3 else f for t, (f, (dy, dx)) in enumerate(zip(frames, planted))])
    assert all(got[t, r, c] == want[t, r, c] for t in range(N) for r in range(0, ROWS, 7) for c in range(0, COLUMNS, 5)) and len(got) == want.size
    average = {(r.r, r.c): r.v for r in reg.registered_average(movie, shifts).collect()}
    assert np.allclose([average[r, c] for r in range(ROWS) for c in range(COLUMNS)], want.mean(axis=0).ravel())


def test_correlation_against_direct_sums():
    image, frame = _image(2, 8, 9), _image(3, 8, 9)
    ref = phase.Reference(image, 0.7, 0.5)
    (got,) = ref.maps(frame[None])
    held = frame * ref.weight + image.mean() * (1 - ref.weight)
    f, g = np.fft.fft2(held), np.fft.fft2(image)
    y, x = np.mgrid[-4:4, -4:5]
    kernel = np.exp(-(y**2 + x**2) / (2 * 0.7**2))
    smooth = np.zeros((8, 9), complex)
    for a in range(8):
        for b in range(9):
            smooth[a, b] = sum(kernel[i, j] / kernel.sum() * np.exp(-2j * np.pi * (a * (i - 4) / 8 + b * (j - 4) / 9)) for i in range(8) for j in range(9))
    spectrum = f / (abs(f) + 1e-5) * np.conj(g / (abs(g) + 1e-5)) * np.real(smooth)
    for dy in range(-4, 5):
        for dx in (-4, 0, 3):
            direct = sum(spectrum[a, b] * np.exp(2j * np.pi * (a * dy / 8 + b * dx / 9)) for a in range(8) for b in range(9)).real / 72
            assert abs(got[dy + 4, dx + 4] - direct) < 1e-9
    assert ref.weight[0, 0] < ref.weight[4, 4] and phase.taper(3, 4, 0).min() == 1


def test_smoothing_in_time_doesn_t_depend_on_the_runs(drift, monkeypatch):
    planted, frames, movie = drift
    image = frames[0]
    settings = reg.Settings(most=0.3, sigma=1.0, sigma_time=1.5)
    packed = reg.packed_frames(movie)
    monkeypatch.setattr(reg, "RUN", 7)
    got = reg.find_shifts(packed, image, settings).orderBy("t").collect()
    ref = phase.Reference(image, 1.0, 0.3)
    maps, w = ref.maps(frames), phase.gaussian_weights(1.5)
    mirrored = np.concatenate([maps[: len(w) // 2][::-1], maps, maps[-(len(w) // 2) :][::-1]])
    smooth = np.array([np.tensordot(w, mirrored[i : i + len(w)], 1) for i in range(N)])
    dy, dx, score = ref.shifts(smooth)
    assert [(r.dy, r.dx) for r in got] == list(zip(dy, dx)) and np.allclose([r.score for r in got], score)


def test_first_reference_and_sums(spark, drift, monkeypatch):
    planted, frames, movie = drift
    monkeypatch.setattr(reg, "PIECE", 100)
    packed = reg.packed_frames(movie.repartition(5)).repartition(4)
    like = np.corrcoef(frames.reshape(N, -1))
    best = np.sort(like, axis=1)[:, ::-1][:, 1:20].mean(axis=1).argmax()
    assert reg.likest_frames(packed, N) == np.argsort(-like[best], kind="stable")[:20].tolist()
    shifts = {t: tuple(map(int, p)) for t, p in enumerate(planted) if t % 2}
    got = reg.mean_image(packed, (ROWS, COLUMNS), shifts, (5, 6))
    canvas = np.full((N, ROWS + 10, COLUMNS + 12), np.nan)
    for t, (dy, dx) in shifts.items():
        canvas[t, 5 - dy : 5 - dy + ROWS, 6 - dx : 6 - dx + COLUMNS] = frames[t]
    with np.errstate(all="ignore"):
        import warnings

        warnings.simplefilter("ignore")
        want = np.nanmean(canvas, axis=0)
    assert np.allclose(got, want, equal_nan=True) and np.isnan(got[0, 0])
    assert np.isnan(reg.mean_image(packed, (ROWS, COLUMNS), {})).all()


def test_extreme_and_odd_frames(spark):
    frames = np.array([_image(5, 6, 7)] * 30)
    frames[4] = 5000
    kept = reg.usual_packed(reg.packed_frames(_movie(spark, frames))).select("t").collect()
    assert sorted(r.t for r in kept) == [t for t in range(30) if t != 4]
    assert reg.usual_packed(reg.packed_frames(_movie(spark, frames[5:]))).count() == 25  # equal means stay
    rows = [(0, 0, 0, 1.0), (1, 2, 0, None), (0, 1, 0, float("nan")), (1, 2, 1, 4.0)]
    got = reg.packed_frames(spark.createDataFrame(rows, "r int, c int, t int, v double")).orderBy("t").collect()
    assert [np.frombuffer(r.pixels).tolist() for r in got] == [[1, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0, 4]]
    with pytest.raises(ValueError):
        reg.reference_image(spark.createDataFrame([], "r int, c int, t int, v double"), reg.Settings())


def test_the_sharpest_settings(drift):
    planted, frames, movie = drift
    still, value = reg.sharpest(movie, [reg.Settings(most=0.01, sigma=1.0, frames=15, steps=2), reg.Settings(most=0.4, sigma=1.0, frames=15, steps=2)])
    assert still.most == 0.4 and value > 0
