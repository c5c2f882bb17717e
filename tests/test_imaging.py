"""Every imaging query against its SQL in DuckDB, and small golden cases."""

import math

import duckdb
import numpy as np
import pytest

from lumenflow.functions import scalars
from lumenflow.operators import checks, images, movies, rois, signals, traces
from lumenflow.plans import imaging, recordings, records
from lumenflow.sources import adapters

DATA = "/root/testdata/sf0.001"
SQL = imaging.SQL | recordings.SQL | records.SQL
QUERIES = imaging.QUERIES | recordings.QUERIES | records.QUERIES


def _plain(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in "supplier orders events embeddings customer nation".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr(tuple(_plain(r[names.index(c)]) for c in df.columns)) for r in cur.fetchall())
    assert sorted(repr(tuple(_plain(v) for v in r)) for r in df.collect()) == want


def test_scalar_rules():
    assert [scalars.frames_per_bin(*x) for x in ((22, 50 / 3), (100, 25), (100, 7), (100, 8), (100, 7.9))] == [1, 4, 14, 12, 13]
    assert (scalars.odd_frames(30, 3.3), scalars.odd_frames(30, 600), scalars.odd_frames(11.1, 10)) == (99, 18001, 111)
    assert (scalars.noise_multiplier(11), scalars.noise_multiplier(31)) == (2.6, 2.0)
    with pytest.raises(ValueError):
        scalars.noise_multiplier(60)


def test_robust_std(spark):
    rows = [("a", -1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 4.0), ("c", None)]
    got = {r.k: r.robust_std for r in traces.robust_std(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert math.isclose(got["a"], 1.4826) and got["b"] == 0 and got["c"] is None


def test_masked_mean_of_a_two_level_movie(spark):
    movie = spark.createDataFrame([(r, c, t, 2.0 if r > 1 else 1.0) for r in range(4) for c in range(4) for t in range(3)], "r int, c int, t int, v double")
    pixels = spark.createDataFrame([(0, 0, 0, 1.0), (0, 3, 3, 1.0), (1, 0, 1, 1.0)], "roi int, r int, c int, w double")
    assert {(x.roi, x.t): x.f for x in traces.masked_mean(movie, pixels).collect()} == {(k, t): v for k, v in ((0, 1.5), (1, 1.0)) for t in range(3)}


def test_closing_fills_a_hole_and_opening_removes_single_pixels(spark):
    block = {(r, c) for r in range(2, 7) for c in range(2, 7)}
    rows = [(0, r, c) for r, c in (block - {(4, 4)}) | {(10, 10)}] + [(1, 0, 0)]
    got = {(x.roi, x.r, x.c) for x in images.close_and_open(spark.createDataFrame(rows, "roi int, r int, c int"), 12, 12).collect()}
    assert got == {(0, r, c) for r, c in block - {(2, 2), (2, 6), (6, 2), (6, 6)}}


def test_gap_median_fills_by_lines(spark):
    n = None
    rows = [(0, t, v) for t, v in enumerate([1.0, 2.0, 3.0, n, n, n, 3.0, 2.0, 1.0])] + [(1, t, v) for t, v in enumerate([n, n, n, 4.0])]
    got = {(x.roi, x.t): x.m for x in checks.gap_median(spark.createDataFrame(rows, "roi int, t int, f double"), 3).collect()}
    assert [got[0, t] for t in range(9)] == [1, 2, 2.5, 3, 3, 3, 2.5, 2, 1] and [got[1, t] for t in range(4)] == [4] * 4


def test_demix_gives_back_the_sources(spark):
    masks = np.zeros((3, 6, 6))
    masks[0, :3, :3], masks[1, 2:5, 2:5], masks[2, 5, :2] = 1, 1, 1
    rng = np.random.default_rng(3)
    frames = rng.uniform(1, 2, (4, 6, 6))
    frames[3][masks[2] > 0] = 0
    want = {}
    for t, frame in enumerate(frames):
        size = masks.sum(axis=(1, 2))
        mean = (masks * frame).sum(axis=(1, 2)) / size
        if (mean == 0).any():
            want |= {(k, t): (0.0, True) for k in range(3)}
            continue
        weighted = (masks * frame).reshape(3, -1) / mean[:, None]
        x = np.linalg.solve(masks.reshape(3, -1) @ weighted.T, mean * size)
        want |= {(k, t): (x[k], False) for k in range(3)}
    movie = spark.createDataFrame([(r, c, t, float(frames[t, r, c])) for t in range(4) for r in range(6) for c in range(6)], "r int, c int, t int, v double")
    pixels = spark.createDataFrame([(int(k), int(r), int(c)) for k, r, c in np.argwhere(masks)], "roi int, r int, c int")
    got = {(x.roi, x.t): (x.f, x.dropped) for x in checks.demix(movie, pixels).collect()}
    assert got.keys() == want.keys() and all(got[k][1] == v[1] and math.isclose(got[k][0], v[0], abs_tol=1e-9) for k, v in want.items())


def test_boxcar_holds_the_edges(spark):
    movie = spark.createDataFrame([(0, 0, t, float(t * t)) for t in range(5)], "r int, c int, t int, v double")
    got = {x.t: x.v for x in signals.boxcar(movie, 3, ["r", "c"]).collect()}
    assert got == {0: 1 / 3, 1: 5 / 3, 2: 14 / 3, 3: 29 / 3, 4: 41 / 3}


def test_refill_needs_five_good_ratios(spark):
    few = spark.createDataFrame([(0, 0.1), (1, 2.0), (2, 0.3)], "roi int, r double")
    assert {x.roi: (x.r, x.filled) for x in signals.refill_ratios(few).collect()} == {0: (0.1, False), 1: (0.7, True), 2: (0.3, False)}


def test_running_ids_follow_experiment_and_position(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 5), ("a", 2)], "experiment string, position int")
    assert {(x.experiment, x.position): x.roi for x in signals.running_ids(rows, 10).collect()} == {("a", 2): 10, ("a", 5): 11, ("b", 1): 12}


def test_regions_are_cut_at_the_frame_of_the_movie(spark):
    # 20 rows: more than the 16 of the driver's smallest movie
    movie = spark.createDataFrame([(r, c, 0, 1.0) for r in range(20) for c in range(32)], "r int, c int, t int, v double")
    pixels = spark.createDataFrame([(0, r, c) for r in range(13, 16) for c in range(5, 9)] + [(1, r, c) for r in range(17, 20) for c in range(5, 9)], "roi int, r int, c int")
    labels = rois.exclusion_labels(pixels, {"left": 1.5, "right": 1.5, "up": 2.2, "down": 0.3}, movies.extent(movie), 11)
    assert {x.roi: (list(x.exclusion_labels), x.valid) for x in labels.collect()} == {0: ([], True), 1: (["motion_border"], False)}
    ring = {(x.r, x.c) for x in traces.neuropil_mask(pixels, 3, movies.extent(movie)).where("roi = 0").collect()}
    assert ring == {(r, c) for r in range(10, 19) for c in range(2, 12)} - {(x.r, x.c) for x in pixels.collect()}


def test_queries_take_the_frame_of_a_larger_movie(spark):
    data = "/root/testdata/sf0.1"
    last = adapters.movie(spark, data).agg({"r": "max"}).first()[0]
    assert last > 15 and imaging.neuropil_mask(spark, data).agg({"r": "max"}).first()[0] == 16
    low = adapters.roi_pixels(spark, data).groupBy("roi").agg({"r": "min", "c": "min"}).where("`min(r)` >= 11 and `min(c)` between 2 and 26").select("roi")
    assert low.count() and imaging.roi_exclusion(spark, data).join(low, "roi").where("not valid").isEmpty()


def test_negative_transients_near_the_start(spark):
    rng = np.random.default_rng(5)
    dip = lambda n, at, width: np.where((np.arange(n) >= at) & (np.arange(n) < at + width), 0.0, 100.0) + rng.normal(0, 1, n)
    # 0: 15 low frames from frame 40; 1: none; 2: too few low frames; 3: in the full windows; 4: shorter than the window
    held = [dip(600, 40, 15), dip(600, 0, 0), dip(600, 40, 9), dip(600, 540, 12), dip(120, 60, 10)]

    def has_run(f, window=500, run=10, sigmas=3):
        padded = np.pad(f, (window - 1, 0), constant_values=f[:window].mean())
        around = np.lib.stride_tricks.sliding_window_view(padded, window)
        below = f < around.mean(axis=-1) - sigmas * around.std(axis=-1)
        return len(f) >= run and bool(np.lib.stride_tricks.sliding_window_view(below, run).all(axis=-1).any())

    rows = [(k, t, float(v)) for k, f in enumerate(held) for t, v in enumerate(f)]
    got = {x.roi for x in traces.negative_transients(spark.createDataFrame(rows, "roi int, t int, f double"), 500).collect()}
    assert got == {k for k, f in enumerate(held) if has_run(f)} and 0 in got


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["roi", "t", "f"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_no_name_is_taken_twice():
    assert len(QUERIES) == len(imaging.QUERIES) + len(recordings.QUERIES) + len(records.QUERIES)


def test_a_missing_shift_is_an_error(spark):
    with pytest.raises(Exception, match="a shift is NaN"):
        rois.motion_border(spark.createDataFrame([(0, 1.0, float("nan"))], "t int, x double, y double")).collect()
