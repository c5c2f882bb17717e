"""Golden values and direct loops for the operators on traces, graphs, selections and files."""

import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenflow.functions import kernels, scalars
from lumenflow.operators import analysis, checks, graphs, images, movies, rois, seeding, selection, traces
from lumenflow.sources import files
from lumenflow.streaming import frames

NAN = math.nan


def _trace(spark, values):
    rows = [(k, t, float(v)) for k, x in enumerate(values) for t, v in enumerate(x)]
    return spark.createDataFrame(rows, "roi long, t int, f double")


def test_half_sample_mode():
    want = (3.87178, 98.0, 91.40142, 16.46159)
    for draw, value in zip((lambda r: r.normal(8.2, 4.5, size=100), lambda r: r.poisson(lam=100, size=100), lambda r: r.gamma(20, scale=5, size=100), lambda r: r.chisquare(19, size=100)), want):
        assert abs(kernels.half_sample_mode(draw(np.random.RandomState(77134)).astype(float)) - value) < 1e-5
    assert kernels.half_sample_mode(np.array([2.0, NAN])) == (2 - 999) / 2


def test_filters_against_loops():
    x = np.random.default_rng(0).normal(size=60).round(1)
    for size in (1, 3, 11, 41):
        half, padded = size // 2, np.pad(x, size // 2, mode="symmetric")
        around = [np.sort(padded[k : k + size]) for k in range(len(x))]
        assert kernels.median_filter(x, size).tolist() == [w[half] for w in around]
        assert kernels.percentile_filter(x, size, 10).tolist() == [w[int(size / 10)] for w in around]
    assert kernels.known_median_filter(np.array([1, 2, 3, NAN, NAN, NAN, 3, 2, 1.0]), 3).tolist() == [1, 2, 2.5, 3, 3, 3, 2.5, 2, 1]
    assert kernels.known_median_filter(np.array([NAN, NAN, NAN, 4, 5.0]), 3).tolist() == [4, 4, 4, 4.5, 5]
    assert [round(kernels.robust_std(np.array(v, float)), 4) for v in ([-1, 2, 3], [4, 4])] == [1.4826, 0] and math.isnan(kernels.robust_std(np.array([]))) and math.isnan(kernels.robust_std(np.array([1, NAN])))
    assert len(kernels.median_filter(x[:4], 41)) == 4  # a window longer than the trace


def test_dff_arithmetic():
    x = np.array([1.1, 2, 3, 3, 3, 11])
    base = x - 1
    out = (x - base) / np.maximum(base, 1)
    assert np.allclose(out, [1, 1, 0.5, 0.5, 0.5, 0.1]) and (base <= 1).sum() == 2
    nothing = kernels.dff(np.full(5, NAN), 3, 3)
    assert np.isnan(nothing[0]).all() and math.isnan(nothing[1]) and nothing[2] == 0


def test_dff_leaves_active_frames_out_of_the_baseline(spark):
    rng = np.random.default_rng(1)
    x = 100 + rng.normal(size=400)
    x[100:180] += 50  # active for longer than half the window
    rows = analysis.dff(_trace(spark, [x, np.full(400, NAN)]), 11, 101).orderBy("roi", "t").collect()
    got = np.array([r.dff for r in rows[:400]])
    assert abs(got[140] - 0.5) < 0.03 and rows[0].n_small_baseline == 0 and abs(rows[0].sigma_dff - 0.01) < 0.003
    assert kernels.dff(x, 11, 101, 0)[0][140] < 0.1 and rows[400].dff is None and rows[400].n_small_baseline == 0


def test_rolling_statistics_against_a_loop(spark):
    rng = np.random.default_rng(2)
    x, used = rng.normal(size=40), rng.random(40) > 0.3
    used[12:27] = False
    table = _trace(spark, [x, x[:6]]).withColumn("used", F.element_at(F.array(*map(F.lit, used.tolist())), F.col("t") + 1))
    rows = analysis.masked_rolling(table, 10, F.col("used")).orderBy("roi", "t").collect()
    for r in rows:
        n = 40 if r.roi == 0 else 6
        lo = 0 if n < 10 else min(max(r.t, 5), n - 5) - 5
        v = x[lo : min(lo + 10, n)][used[lo : min(lo + 10, n)]]
        assert (r.mean is None) == (len(v) == 0) and (r.sd is None) == (len(v) < 2)
        assert not len(v) or abs(r.mean - v.mean()) < 1e-9
        assert len(v) < 2 or abs(r.sd - v.std(ddof=1)) < 1e-9


def test_clip_negative(spark):
    x = np.ones(60) + np.tile([0.1, -0.1], 30)
    x[30] = -50
    t = _trace(spark, [x, x, [NAN] * 60])
    active = t.select("roi", "t", ((F.col("roi") == 1) | (F.col("t") == 30)).alias("active"))
    got = {(r.roi, r.t): r.f for r in analysis.clip_negative(t, active, 20).collect()}
    assert 0.7 < got[0, 30] < 0.9 and got[0, 0] == x[0] and got[1, 30] < -10 and math.isnan(got[2, 3])


def test_active_frames(spark):
    x = np.random.default_rng(3).normal(10, 0.1, 300)
    x[100:110] += 3
    rows = {r.t: r.active for r in analysis.active_frames(_trace(spark, [x])).collect()}
    assert all(rows[t] for t in range(102, 112)) and sum(rows.values()) < 20
    assert np.allclose(kernels.tail_log(np.array([0.0, 1.0])), np.log([0.5, 0.15865525393145707]))


def test_dilation_and_independent_events(spark):
    flags = spark.createDataFrame([(0, t, t in (4, 20)) for t in range(30)], "roi long, t int, active boolean")
    assert [r.t for r in traces.dilate(flags, 2).where("active").orderBy("t").collect()] == [2, 3, 4, 5, 6, 18, 19, 20, 21, 22]
    at = lambda x: spark.createDataFrame([(0, t) for t in x], "roi long, t int")
    assert [r.t for r in traces.independent_events(at([1, 5, 9]), at([3, 30]), 2).orderBy("t").collect()] == [9]
    assert checks.ghosts(at([1, 2]), at([3])).first().ghost


def test_neuropil_share(spark):
    rng = np.random.default_rng(0)
    neuropil = 50 + np.cumsum(rng.normal(size=800)) * 0.3 + rng.normal(size=800)
    smooth = 100 + np.cumsum(rng.normal(size=800)) * 0.02
    r, error = kernels.contamination_ratio(smooth + 0.63 * neuropil, neuropil)
    assert abs(r - 0.63) < 0.005
    # the same error by a dense solve
    step = np.diff(np.eye(200), axis=0)
    solve = np.linalg.inv(np.eye(200) + 0.05 * step.T @ step)
    parts = []
    for k in range(4):
        m, n = (smooth + 0.63 * neuropil)[k * 200 : k * 200 + 200], neuropil[k * 200 : k * 200 + 200]
        rest = m - r * n
        parts.append(np.sqrt(np.mean((solve @ rest - rest) ** 2)) / m.mean())
    assert abs(np.mean(parts) - error) < 1e-9
    assert abs(kernels.contamination_ratio(smooth + 2.9 * neuropil, neuropil)[0] - 2.9) < 0.01  # beyond the first range
    rows = [(k, t, float(v), float(n)) for k, x in enumerate([smooth + 0.63 * neuropil, -smooth]) for t, (v, n) in enumerate(zip(x, neuropil))] + [(2, 0, NAN, 1.0)]
    pairs = spark.createDataFrame(rows, "roi long, t int, f double, np double")
    out = analysis.neuropil_corrected(pairs).groupBy("roi").agg(F.count("*").alias("n"), F.max("r").alias("r"), F.avg("fc").alias("m")).collect()
    assert [(x.roi, x.n) for x in out] == [(0, 800)] and abs(out[0].r - 0.63) < 0.005 and abs(out[0].m - smooth.mean()) < 1


def test_refilled_shares(spark):
    fit = lambda x: spark.createDataFrame([(k, v) for k, v in enumerate(x)], "roi long, r double")
    assert [r.r for r in analysis.refilled(fit([0.1, 0.2, 1.5])).orderBy("roi").collect()] == [0.1, 0.2, 0.7]
    assert abs(analysis.refilled(fit([0.1, 0.2, 0.3, 0.4, 0.5, 0.0, 1.5])).where("roi = 6").first().r - 0.3) < 1e-12


def test_deconvolution_is_the_least_cost():
    rng, gamma, n = np.random.default_rng(3), 0.8, 8
    for _ in range(15):
        y, c = np.zeros(n), 0.0
        for t in range(n):
            c = c * gamma + (rng.random() < 0.3) * rng.uniform(1, 3)
            y[t] = c + 0.3 * rng.normal()
        penalty, best = rng.uniform(0.05, 1), (math.inf, ())
        for k in range(n):
            for at in itertools.combinations(range(1, n), k):
                cost, ends, ok, last = penalty * k, [0, *at, n], True, 0.0
                for a, b in itertools.pairwise(ends):
                    w = gamma ** np.arange(b - a)
                    level = max(0, y[a:b] @ w / (w @ w))
                    ok &= level >= last - 1e-12
                    last, cost = level * gamma ** (b - a), cost + 0.5 * ((y[a:b] - level * w) ** 2).sum()
                if ok and cost < best[0]:
                    best = (cost, at)
        assert tuple(np.flatnonzero(kernels.decaying_steps(y, gamma, penalty))) == best[1]


def test_events_are_found_where_they_were_put(spark):
    gamma, at = scalars.decay_gamma(0.415 * math.log(2), 31), [50, 150, 300, 420, 600]
    x = np.random.default_rng(42).normal(size=700)
    for a in at:
        x[a:] += 12 * gamma ** np.arange(700 - a)
    out = analysis.detect_events(_trace(spark, [x]), gamma, 2.5)
    assert [r.t for r in out.where("event > 0").orderBy("t").collect()] == at
    assert analysis.events_file(out).first().n_events == 5


def test_graph_metrics_of_a_small_movie(spark):
    wave = 0.5 * (1 + np.sin(2 * np.pi * np.arange(40) / 10))
    sign = {(0, 0): 1, (0, 1): -1, (1, 0): -1, (1, 1): 1}
    movie = spark.createDataFrame([(r, c, t, float(s * v)) for (r, c), s in sign.items() for t, v in enumerate(wave)], "r int, c int, t int, v double")
    for share in (0.2, 1.0):
        for e in graphs.filtered_correlation(movie, share).collect():
            assert abs(e.filtered - sign[e.r0, e.c0] * sign[e.r1, e.c1]) < 1e-9
    for share in (None, 0.2):
        for e in graphs.hnc_gaussian(movie, 7, share).collect():
            assert abs(e.hnc - (1 if sign[e.r0, e.c0] == sign[e.r1, e.c1] else math.exp(-16))) < 1e-6
    image = np.random.default_rng(1).uniform(1, 2, (6, 7))
    edges = [(r, c, r, c + 1, float(image[r, c])) for r in range(6) for c in range(6)]
    mean = np.zeros((6, 7))
    for r, c in itertools.product(range(6), range(7)):
        mean[r, c] = np.mean([image[r, k] for k in (c - 1, c) if 0 <= k < 6])
    weights = np.exp(-0.5 * (np.arange(-4, 5) / 1.0) ** 2)
    for axis in (0, 1):
        held = np.pad(mean, [(4, 4) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        mean = np.apply_along_axis(lambda x: np.convolve(x, weights / weights.sum(), "valid"), axis, held)
    for e in graphs.normalized(spark.createDataFrame(edges, "r0 int, c0 int, r1 int, c1 int, w double"), "w", 1.0).collect():
        assert abs(e.normalized - image[e.r0, e.c0] / ((mean[e.r0, e.c0] + mean[e.r1, e.c1]) / 2)) < 1e-9
    a = spark.createDataFrame([(0, 0, 0, 1, 1.0), (0, 1, 0, 2, 2.0)], "r0 int, c0 int, r1 int, c1 int, w double")
    b = spark.createDataFrame([(0, 0, 0, 1, 5.0)], a.schema)
    assert sorted(r.w for r in graphs.merged(a, b, ["w"]).collect()) == [2.0, 5.0]
    grid = spark.createDataFrame([(r, c, 0, 0.0) for r in range(9) for c in range(9)], "r int, c int, t int, v double")
    near = {(p.r, p.c) for p in graphs.neighbourhood(grid, 0.5, 4.0, 2).collect()}
    assert near == {(r, c) for r in range(9) for c in range(9) if math.hypot(r - 0.5, c - 4) <= 2}


def test_seed_batches(spark):
    ramp = spark.createDataFrame([(r, c, float(r * 4 + c)) for r in range(4) for c in range(4)], "r int, c int, v double")
    none = spark.createDataFrame([(0, 0)], "r int, c int")
    rows = seeding.seed_batches(ramp, none, 3, 2.0).orderBy("batch", "k").collect()
    assert len(rows) == 15 and [(x.r, x.c) for x in rows[:3]] == [(3, 3), (3, 1), (1, 3)]
    for b in {x.batch for x in rows}:
        own = [(x.r, x.c) for x in rows if x.batch == b]
        assert len(own) <= 3 and all(math.dist(p, q) >= 2 for p, q in itertools.combinations(own, 2))
    assert graphs.dilated_pixels(none, 1).count() == 9


def test_frames(spark):
    level = [9.0] * 3 + [100.0 + (t % 3) for t in range(40)] + [9.0] * 2
    movie = spark.createDataFrame([(0, c, t, v) for c in range(2) for t, v in enumerate(level)], "r int, c int, t int, v double")
    assert tuple(selection.empty_ends(movie).first()) == (3, 2)
    hole = movie.withColumn("v", F.when(F.col("t") == 1, 100.0).otherwise(F.col("v")))
    assert tuple(selection.empty_ends(hole).first()) == (0, 2)
    assert {r.t for r in selection.usual_frames(movie, 2.0).collect()} == set(range(3, 43))
    assert selection.joined_in_time([movie.where("t < 3"), movie.where("t < 2")]).agg(F.max("t")).first()[0] == 4
    shift = spark.createDataFrame([(0, True, False), (1, False, False), (2, True, True)], "t int, clipped_x boolean, clipped_y boolean")
    assert {r.t for r in selection.clipped_frames(shift).collect()} == {0, 2}
    split = selection.train_and_validation(movie.select("t").distinct(), 0.7, 2).collect()
    train, rest = ([r for r in split if r.part == p] for p in ("train", "validation"))
    assert {r.t for r in train} == set(range(2, 30)) and {r.t for r in rest} == set(range(34, 43)) and [r.t for r in sorted(train, key=lambda r: r.place)] != sorted(r.t for r in train)


def test_regions(spark, tmp_path):
    mask = [[True, False], [True, True]]
    dense = spark.createDataFrame([(7, 3, 2, mask)], "roi int, x int, y int, mask array<array<boolean>>")
    pixels = rois.from_dense(dense)
    assert {(p.r, p.c) for p in pixels.collect()} == {(2, 3), (3, 3), (3, 4)}
    back = rois.to_dense(pixels).first()
    assert (back.x, back.y, back.width, back.height, back.mask) == (3, 2, 2, 2, mask)
    sparse = spark.createDataFrame([(1, [0, 0, 5], [1, 2, 9], [0.5, 1.0, 0.1])], "roi int, ypix array<int>, xpix array<int>, lam array<double>")
    assert {tuple(p) for p in rois.pixel_list(sparse).collect()} == {(1, 0, 1, 0.5), (1, 0, 2, 1.0), (1, 5, 9, 0.1)}
    assert rois.binarize(rois.pixel_list(sparse), threshold=0.4).count() == 2
    extent = spark.createDataFrame([(20, 20)], "rows int, columns int")
    flags = {r.roi: r.at_border for r in rois.at_border(rois.pixel_list(sparse).unionByName(pixels.withColumn("w", F.lit(1.0))), (1, 1, 1, 1), extent).collect()}
    assert flags == {1: True, 7: False}
    regions = spark.createDataFrame([(1,), (7,), (9,)], "roi int")
    labels = rois.mask_problems(pixels.unionByName(rois.pixel_list(sparse).drop("w")), regions, spark.createDataFrame([(1, True)], "roi int, at_border boolean"))
    assert {tuple(r) for r in labels.collect()} == {(9, "empty_roi_mask"), (1, "motion_border")}
    line = spark.createDataFrame([(k, 0, k) for k in range(4)] + [(9, 9, 9)], "roi int, r int, c int")
    colours = {r.roi: r.colour for r in rois.colours(line).collect()}
    assert len(colours) == 5 and all(colours[k] != colours[k + 1] for k in range(3)) and max(colours.values()) <= 1 + 1
    assert [r.roi for r in rois.in_label_order(spark.createDataFrame([(2,), (10,)], "roi int")).collect()] == [10, 2]
    square = spark.createDataFrame([(k, r, c, 1.0) for k, (r0, c0, h, w) in enumerate([(5, 5, 4, 4), (0, 5, 4, 4), (5, 5, 12, 1), (9, 9, 2, 2)]) for r in range(r0, r0 + h) for c in range(c0, c0 + w)], "roi int, r int, c int, w double")
    shift = spark.createDataFrame([(0, 0.3, 0.3), (1, -0.3, -0.3)], "t int, x double, y double")
    done = {r.roi: r.exclusion_labels for r in rois.postprocessed(square, shift, extent, least_pixels=4).collect()}
    assert done == {0: [], 1: ["motion_border"], 3: ["small_size"]}
    labelled = spark.createDataFrame([(1, []), (2, ["ghost"])], "roi int, exclusion_labels array<string>")
    inside, out = selection.split_by_labels(labelled)
    assert (inside.first().roi, out.first().roi) == (1, 2) and not selection.without_labels(labelled, ["ghost"]).where("roi = 2").first().valid


def test_order_and_parameters(spark):
    table = spark.createDataFrame([(5, 0), (3, 1)], "roi long, place int")
    trace = spark.createDataFrame([(3, 0, 1.0), (5, 0, 2.0)], "roi long, t int, f double")
    assert [r.f for r in selection.in_region_order(trace, table).orderBy("place").collect()] == [2.0, 1.0]
    with pytest.raises(ValueError):
        selection.in_region_order(trace.where("roi = 3"), table)
    assert selection.misaligned(table, table).isEmpty() and selection.misaligned(table, table.where("roi = 5")).first().roi == 3
    grid = selection.parameter_grid({"a": [1.0, 2.0], "b": [0.5, 1.0, 2.0]}, table)
    best = selection.best_parameters(grid.withColumn("score", -F.abs(F.col("a") - 2) - F.abs(F.col("b") - 0.75)), ["a", "b"]).first()
    assert grid.count() == 6 and (best.a, best.b) == (2.0, 0.5)
    ids = {r.z: r.id for r in selection.depth_ids(spark.createDataFrame([(1.0,), (1.0000001,), (2.0,)], "z double")).collect()}
    assert ids[1.0] == ids[1.0000001] != ids[2.0]
    near = selection.nearest_centre(spark.createDataFrame([(0, 0.0, 0.0)], "point int, x double, y double"), spark.createDataFrame([(1, 1.0, 0.0), (2, 0.0, 1.0), (3, 9.0, 9.0)], "centre int, x double, y double"))
    assert near.first().centre == 1
    lo, hi, before, after = selection.cut_out(F.lit(2.0), F.lit(10), 8)
    assert tuple(spark.range(1).select(lo, hi, before, after).first()) == (0, 6, 2, 0)
    box = spark.range(1).select(selection.thumbnail(F.lit(2), F.lit(90), F.lit(10), F.lit(6), 100, 100, 4).alias("b")).first().b
    assert (box.x, box.y, box.side) == (0, 68, 32)
    names = spark.createDataFrame([("/a/ophys_experiment_42/x.h5", "17"), ("/b", "x1")], "path string, name string")
    assert [tuple(r) for r in names.select(selection.experiment_id(F.col("path")), selection.region_number(F.col("name"))).collect()] == [(42, 17), (None, None)]
    many = spark.createDataFrame([(e, p) for e in range(3) for p in range(4)], "experiment int, position int")
    some = [tuple(r) for r in selection.sample_regions(many, 5).collect()]
    assert some == sorted(some) and len(set(some)) == 5 and some == [tuple(r) for r in selection.sample_regions(many.repartition(5), 5).collect()]
    with pytest.raises(ValueError):
        selection.sample_regions(many, 13)
    pages = spark.createDataFrame([(p, 0, 0, float(p)) for p in range(12)], "page int, r int, c int, v double")
    assert selection.page_average(pages, 3, 4).first().v == 5.5 and [r.page for r in selection.pages_of(pages, 2, 3, 1, 2).collect()] == [5, 11]
    with pytest.raises(ValueError):
        selection.page_average(pages, 5, 4)
    image = spark.createDataFrame([(r, c, float(10 * r + c)) for r in range(4) for c in range(4)], "r int, c int, v double")
    cut = {(p.r, p.c): p.v for p in selection.centred_image(image, spark.createDataFrame([(0, 0, 0, 2, 2)], "roi int, x int, y int, width int, height int"), 4).collect()}
    assert len(cut) == 16 and cut[0, 0] == 0 and cut[1, 1] == 0.0 and cut[2, 3] == 12.0


def test_files(spark, tmp_path):
    (tmp_path / "rois.json").write_text(json.dumps([{"id": 1, "x": 2, "y": 3, "width": 1, "height": 1, "valid": True, "mask": [[True]], "mask_page": 0, "exclusion_labels": []}]))
    assert files.rois(spark, str(tmp_path / "rois.json")).first().mask == [[True]]
    (tmp_path / "motion.csv").write_text("index,x,y,a\n0,-40,2\n1,3,-5\n2,1,1\n")
    border = rois.motion_border(files.motion(spark, str(tmp_path / "motion.csv"))).first()
    assert (border.left, border.down) == (3.0, 5.0)
    odd = spark.createDataFrame([(1, NAN, [math.inf, 1.0], (-math.inf, "x"))], "roi int, a double, b array<double>, c struct<d: double, e: string>")
    files.write_json(odd, str(tmp_path / "out"))
    assert json.loads("".join(f.read_text() for f in (tmp_path / "out").glob("*.json"))) == {"roi": 1, "a": "_NaN_", "b": ["_Inf_", "1.0"], "c": {"d": "_-Inf_", "e": "x"}}
    trace = spark.createDataFrame([(k, t, 1.0) for k in range(5) for t in range(3)], "roi long, t int, f double")
    files.write_traces(trace, str(tmp_path / "traces"), 4)
    assert sorted(files.traces(spark, str(tmp_path / "traces")).select(*trace.columns).collect()) == sorted(trace.collect())
    nothing = trace.select("roi").where("false")
    assert files.write_events(trace, nothing, str(tmp_path / "events")).startswith("No valid") and files.write_events(trace, trace.select("roi"), str(tmp_path / "more")) is None
    for k in (42, 7):
        (tmp_path / f"ophys_experiment_{k}" / "deep").mkdir(parents=True)
        (tmp_path / f"ophys_experiment_{k}" / "deep" / "b.csv").write_text("x")
    (tmp_path / "ophys_experiment_42" / "a.csv").write_text("x")
    found = {r.experiment: r.path for r in files.first_files(spark, str(tmp_path), "[ab].csv").collect()}
    assert set(found) == {42, 7} and found[42].endswith("ophys_experiment_42/a.csv")
    log = spark.createDataFrame([], files.REGISTRY)
    log = files.activated(files.activated(log, "m", "dev", "s3-like/a", "r1", 1), "m", "dev", "s3-like/b", "r2", 2)
    assert log.count() == 4 and files.active_model(log, "dev").first().artifact_location.endswith("b") and files.active_model(log, "prod").isEmpty()
    with pytest.raises(ValueError):
        files.activated(log, "prod", "dev", "x", "y")


def test_exact_quantiles_of_uneven_values(spark, monkeypatch):
    x = np.concatenate([np.random.default_rng(0).exponential(size=3000) ** 6, np.full(500, 0.25), [-1e9, 1e12]])
    table = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(3)
    for few in (1, 10_000):
        monkeypatch.setattr(movies, "FEW", few)
        assert np.allclose(movies.quantiles(table, "v", [0.0, 0.1, 0.5, 0.999, 1.0]), np.quantile(x, [0.0, 0.1, 0.5, 0.999, 1.0]), rtol=1e-12)
    assert movies.quantiles(table.where("false"), "v", [0.5]) == [None]


def test_negative_transients_pad_the_start(spark):
    rng = np.random.default_rng(5)
    values = [rng.normal(size=60) for _ in range(40)]
    want = set()
    for k, x in enumerate(values):
        padded = np.concatenate([np.full(19, x[:20].mean()), x])
        low = np.array([x[t] < padded[t : t + 20].mean() - 1.2 * padded[t : t + 20].std() for t in range(60)])
        if (low[1:] & low[:-1]).any():
            want.add(k)
    assert 0 < len(want) < 40 and {r.roi for r in traces.negative_transients(_trace(spark, values), 20, 2, 1.2).collect()} == want


def test_border_of_the_neuropil_and_regions_without_pixels(spark):
    movie = spark.createDataFrame([(r, c, t, 1.0) for r in range(8) for c in range(8) for t in range(2)], "r int, c int, t int, v double")
    pixels = spark.createDataFrame([(0, 2, 2), (1, 50, 50), (2, 5, 5)], "roi int, r int, c int")
    ring = traces.neuropil_mask(pixels.where("roi = 0"), 2, movies.extent(movie), (1, 4, 4, 1))
    assert {(p.r, p.c) for p in ring.collect()} == {(r, c) for r in range(1, 4) for c in range(1, 4)} - {(2, 2)}
    got = {(r.roi, r.t): r.f for r in traces.all_regions_mean(movie, pixels, spark.createDataFrame([(2,)], "roi int")).collect()}
    assert len(got) == 6 and got[0, 0] == 1 and math.isnan(got[1, 1]) and math.isnan(got[2, 0])


def test_stream_of_frames(spark, tmp_path):
    rows = [(r, c, t, float(t + r)) for r in range(2) for c in range(2) for t in range(3)]
    spark.createDataFrame(rows, "r int, c int, t int, v double").withColumn("ts", F.timestamp_seconds("t")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("r int, c int, t int, v double, ts timestamp").parquet(str(tmp_path / "in"))
    pixels = spark.createDataFrame([(0, 0, 0), (0, 1, 1)], "roi int, r int, c int")
    query = frames.masked_mean_stream(stream, pixels).writeStream.format("memory").queryName("means").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.f for r in spark.table("means").collect()) == [0.5, 1.5, 2.5]


def test_display_limits_of_a_border(spark):
    movie = spark.createDataFrame([(r, c, 0, float(99 if min(r, c, 5 - r, 5 - c) < 1 else r)) for r in range(6) for c in range(6)], "r int, c int, t int, v double")
    assert tuple(images.display_limits(movie, 0.0, 1.0, 1).first()) == (1.0, 4.0)
