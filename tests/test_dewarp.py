"""Sine dewarping against a plain loop over columns, and movies in blocks and tiles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenflow.operators import dewarp
from lumenflow.sources import movies


def _movie(spark, frames):
    t, r, c = np.meshgrid(*map(np.arange, frames.shape), indexing="ij")
    return spark.createDataFrame(list(zip(*(x.ravel().tolist() for x in (r, c, t, frames.astype(float))))), "r int, c int, t int, v double")


def _plain(frames, left, right, noise):
    """Column by column on dense frames, square ones."""
    n, rows, width = frames.shape
    common = lambda x: np.array([min(v for v in set(k.tolist()) if (k == v).sum() == max((k == u).sum() for u in set(k.tolist()))) for k in x.T])
    level = common(frames.mean(axis=0).astype(int))
    deviation = common(frames[::8].std(axis=0).astype(int))
    out = frames.astype(float).copy()
    margins = []
    for flip, (reach, strength) in ((False, left), (True, right)):
        seen, made = frames[:, :, ::-1] if flip else frames, out[:, :, ::-1] if flip else out
        column, border = dewarp.places(reach, strength, width // 2)
        first = next(j for j in range(width // 2) if column[j] >= 0 and border[j] >= 0)
        margins.append(first)
        gain = 1 if noise else border[first + 1] - border[first]
        for j in range(int(reach)):
            if column[j] < 0:
                made[:, :, j] = level * gain
            elif border[j - 1] < 0:
                made[:, :, j] = seen[:, :, column[j]] * gain
            else:
                lo, hi = border[j - 1], border[j]
                s, e = int(math.floor(lo)), int(math.floor(hi))
                x = (s + 1 - lo) * seen[:, :, s] + (hi - e) * seen[:, :, e] + (seen[:, :, s + 1] if e - s > 1 else 0)
                x = {1: x - 2 * deviation * (hi - lo - 1), 2: x / (hi - lo) - deviation * (hi - lo - 1), 3: x / (hi - lo)}.get(noise, x)
                made[:, :, j] = np.clip(x, 0, 65535)
    return np.floor(np.round(out, 9)).astype(int), margins


@pytest.mark.parametrize("noise", [0, 1, 2, 3])
def test_dewarping_against_a_loop(spark, noise):
    rng = np.random.default_rng(noise)
    frames = rng.integers(0, 60, (10, 24, 24)) * rng.integers(1, 1500, (1, 24, 1))
    left, right = (9.0, 4.5), (7.0, 3.0)
    want, (low, high) = _plain(frames, left, right, noise)
    movie = _movie(spark, frames)
    got = {(r.t, r.r, r.c): r.v for r in dewarp.dewarped(movie, left, right, noise, 24, True).collect()}
    assert len(got) == want.size and all(got[t, r, c] == want[t, r, c] for t in range(10) for r in range(24) for c in range(24))
    cut = {(r.t, r.r, r.c): r.v for r in dewarp.dewarped(movie, left, right, noise, 24).collect()}
    assert (low, high) == dewarp.margins(left, right, 24) and low > 0
    assert cut == {(t, r, c - low): v for (t, r, c), v in got.items() if low <= c < 24 - high}


def test_index_tables():
    column, border = dewarp.places(160.0, 85.0)
    assert len(column) == len(border) == 256
    assert np.flatnonzero(column)[-1] + 1 == 160 == np.flatnonzero(border)[-1] + 1
    assert dewarp.places(0.0, 7.0) == ([0] * 256, [0.0] * 256)
    table = dewarp.warp_table((0.0, 7.0), (3.0, 11.0), 3)
    assert [x for x in table if x[1] < 509] == [(c, c, 1.0, 1.0, 0.0, 0.0, False) for c in range(509)]
    assert max(sum(1 for x in table if x[1] == c) for c in range(512)) <= 3
    low, high = dewarp.margins((160.0, 85.0), (160.0, 90.0))
    assert 0 < low < high < 160


def test_wide_and_empty_movies(spark):
    frames = np.arange(2 * 30 * 24).reshape(2, 30, 24) % 97
    levels = {r.r: r.level for r in dewarp.row_levels(_movie(spark, frames)).collect()}
    assert len(levels) == 30 and levels[25] == levels[1]
    empty = spark.createDataFrame([], "r int, c int, t int, v double")
    assert dewarp.dewarped(empty, (9.0, 4.5), (7.0, 3.0), 0, 24).count() == 0


def test_one_shuffle_of_the_movie(spark, tmp_path):
    _movie(spark, np.ones((2, 24, 24))).write.parquet(str(tmp_path / "m"))
    movie = spark.read.parquet(str(tmp_path / "m"))
    table = F.broadcast(spark.createDataFrame(dewarp.warp_table((9.0, 4.5), (7.0, 3.0), 0, 24), dewarp._WARP))
    plan = movie.join(table, "c").groupBy("t", "r", "out").agg(F.sum("v"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_windows_read_few_files(spark, tmp_path):
    frames = np.random.default_rng(1).integers(0, 9, (25, 20, 30))
    path = str(tmp_path / "movie")
    movies.write_movie(_movie(spark, frames), path, block=10, tile=8, rate=31.0)
    assert movies.about(spark, path) == {"rate": 31.0, "block": 10, "tile": 8}
    whole = movies.read_movie(spark, path)
    assert whole.count() == frames.size and len(whole.select("*", F.input_file_name().alias("f")).select("f").distinct().collect()) == 3 * 3 * 4
    part = movies.read_movie(spark, path, t=(12, 18), r=(9, 15), c=(8, 17))
    read = part.select("*", F.input_file_name().alias("f"))
    assert {r.f for r in read.collect()} == {r.f for r in read.select("f").distinct().collect()} and read.select("f").distinct().count() == 2
    metrics = part.where("v >= 0")
    metrics.collect()
    plan = metrics._jdf.queryExecution().executedPlan()
    scans, todo = [], [plan]
    while todo:
        node = todo.pop()
        node = node.executedPlan() if node.nodeName().startswith("AdaptiveSparkPlan") else node
        if node.metrics().contains("numFiles"):
            scans.append(node.metrics().apply("numFiles").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert scans == [2]
    got = {(r.t, r.r, r.c): r.v for r in part.collect()}
    assert got == {(t, r, c): frames[t, r, c] for t in range(12, 18) for r in range(9, 15) for c in range(8, 17)}
    pixels = spark.createDataFrame([(9, 9), (11, 14)], "r int, c int")
    assert movies.read_region(spark, path, pixels, 1).agg(F.min("r"), F.max("r"), F.min("c"), F.max("c")).first()[0:] == (8, 12, 8, 15)
    assert movies.read_region(spark, path, pixels.where("r < 0")).count() == 0
    assert [b.count() for b in movies.read_in_blocks(spark, path, 2)] == [20 * 600, 5 * 600]


def test_a_dewarped_movie_is_written(spark, tmp_path):
    frames = np.random.default_rng(2).integers(0, 99, (3, 24, 24))
    dewarp.write_dewarped(_movie(spark, frames), str(tmp_path / "d"), (9.0, 4.5), (7.0, 3.0), 3, 24)
    low, high = dewarp.margins((9.0, 4.5), (7.0, 3.0), 24)
    told = movies.about(spark, str(tmp_path / "d"))
    assert told["width"] == 24 - low - high and told["noise"] == 3
    assert movies.read_movie(spark, str(tmp_path / "d")).agg(F.max("c")).first()[0] == 24 - low - high - 1
