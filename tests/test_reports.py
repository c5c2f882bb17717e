"""Reports, filters and small files against plain loops."""

import json

import numpy as np
import pytest

from lumenflow.operators import reports, rois
from lumenflow.sources import files

FRAMES = np.random.default_rng(6).normal(10, 3, (14, 6, 5))


def _movie(spark, frames=FRAMES):
    t, r, c = np.meshgrid(*map(np.arange, frames.shape), indexing="ij")
    return spark.createDataFrame(list(zip(*(x.ravel().tolist() for x in (r, c, t, frames)))), "r int, c int, t int, v double").repartition(3)


def _dense(df, shape):
    out = np.full(shape, np.nan)
    for x in df.collect():
        out[x.t, x.r, x.c] = x.v
    return out


def test_strategies(spark):
    movie = _movie(spark)
    want = {"average": lambda x: x.mean(axis=0), "maximum": lambda x: x.max(axis=0), "first": lambda x: x[0], "last": lambda x: x[-1]}
    for name, rule in want.items():
        assert np.allclose(_dense(reports.binned(movie, 31, 8, name), (4, 6, 5)), [rule(FRAMES[i : i + 4]) for i in range(0, 14, 4)])
    drawn = _dense(reports.binned(movie, 31, 8, "random", 3), (4, 6, 5))
    assert all(any((drawn[k] == f).all() for f in FRAMES[4 * k : 4 * k + 4]) for k in range(4))
    assert (drawn == _dense(reports.binned(movie.repartition(7), 31, 8, "random", 3), (4, 6, 5))).all()
    with pytest.raises(ValueError):
        reports.binned(movie, 31, 8, "median")


@pytest.mark.parametrize("kind,size", [("boxcar", 3), ("boxcar", 4), ("gaussian", 0.8), ("gaussian", 3.0)])
def test_filters_in_time(spark, kind, size):
    got = _dense(reports.filtered_in_time(_movie(spark), size, kind), FRAMES.shape)
    if kind == "boxcar":
        weights, before = np.full(size, 1 / size), size // 2
    else:
        before = int(4 * size + 0.5)
        weights = np.exp(-(np.arange(-before, before + 1) ** 2) / (2 * size**2))
        weights /= weights.sum()
    at = lambda t: FRAMES[min(max(t, 0), 13)]
    want = [sum(w * at(t + k - before) for k, w in enumerate(weights)) for t in range(14)]
    assert np.allclose(got, want)
    whole = _dense(reports.filtered_in_time(_movie(spark), size, kind, True), FRAMES.shape)
    assert (whole == np.trunc(np.round(got, 9))).all()
    with pytest.raises(ValueError):
        reports.filtered_in_time(_movie(spark), 3, "box")


def test_rules_on_frames_and_traces(spark):
    flipped = reports.filtered_frames(_movie(spark), lambda x: x[:, ::-1])
    assert np.allclose(_dense(flipped, FRAMES.shape), FRAMES[:, ::-1])
    with pytest.raises(Exception, match="the rule made"):
        reports.filtered_frames(_movie(spark), lambda x: x[:, 1:]).count()
    trace = spark.createDataFrame([("a", 1, 2.0), ("a", 0, 5.0), ("b", 0, 1.0)], "roi string, t int, f double")
    got = {r.roi: (r.first, r.n) for r in reports.each_trace(trace, lambda x: {"first": x[0], "n": len(x)}, "first double, n int").collect()}
    assert got == {"a": (5.0, 2), "b": (1.0, 1)}


def test_region_and_registration_reports(spark):
    pixels = spark.createDataFrame([(1, 0, 0, 4.0), (1, 0, 1, 1.0), (1, 1, 0, 3.0), (2, 4, 4, 2.0)], "roi int, r int, c int, w double")
    series, whole = reports.region_report(_movie(spark), pixels, 0.3)
    got = {(x.roi, x.t): (x.weighted, x.binary) for x in series.collect()}
    for t in range(14):
        f = FRAMES[t]
        assert np.allclose(got[1, t], ((4 * f[0, 0] + f[0, 1] + 3 * f[1, 0]) / 3, (f[0, 0] + f[1, 0]) / 2))
    assert {x.roi: (x.n_weighted, x.n_binary) for x in whole.collect()} == {1: (3, 2), 2: (1, 1)}
    corrected = _movie(spark, FRAMES * 2)
    both = _dense(reports.preview(_movie(spark), corrected, 1.0, 2.0, (0.2, 0.8)), (7, 6, 10))
    for part, frames in ((both[:, :, :5], FRAMES), (both[:, :, 5:], FRAMES * 2)):
        slow = frames.reshape(7, 2, 6, 5).mean(axis=1)
        lo, hi = np.quantile(slow.mean(axis=0), [0.2, 0.8])
        assert np.abs(part - np.round((np.clip(slow, lo, hi) - lo) / (hi - lo) * 255)).max() == 0
    shift = spark.createDataFrame([(0, 1.0, -7.0), (1, -3.0, 2.0)], "t int, x double, y double")
    assert reports.shift_summary(shift).first()[:] == (2, 3.0, 7.0)


def test_colours_and_metadata(spark):
    image = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0), (1, 0, 2.0)], "r int, c int, v double")
    assert {(x.r, x.c): (x.red, x.green, x.blue) for x in reports.rgb(image).collect()} == {(0, 0): (0, 0, 0), (0, 1): (255, 255, 255), (1, 0): (128, 128, 128)}
    assert {x.red for x in reports.rgb(image.where("c = 1")).collect()} == {0}
    experiments = spark.createDataFrame([(1, "a"), (2, "b")], "experiment long, name string")
    about = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "experiment long, z double")
    assert {(x.name, x.z) for x in reports.with_metadata(experiments, about).collect()} == {("a", 5.0), ("b", 6.0)}
    for bad in (about.where("experiment < 2"), about.union(about)):
        with pytest.raises(ValueError):
            reports.with_metadata(experiments, bad)


def test_masks_and_json(spark, tmp_path):
    pixels = spark.createDataFrame([(3, 2, 5), (3, 3, 6), (4, 0, 0)], "roi int, r int, c int")
    files.write_masks(pixels, str(tmp_path / "m"))
    lines = [json.loads(x) for p in (tmp_path / "m").glob("*.json") for x in p.read_text().splitlines()]
    assert {x["id"]: (x["x"], x["y"], x["mask"]) for x in lines} == {3: (5, 2, [[True, False], [False, True]]), 4: (0, 0, [[True]])}
    nested = spark.createDataFrame([(1, [1.5, float("nan")], {"a": float("inf")}, (2.0, "x")), (2, None, None, None)], "k int, xs array<double>, m map<string,double>, s struct<y: double, z: string>")
    back = files.decoded(files.encoded(nested), "k int, xs array<double>, m map<string,double>, s struct<y: double, z: string>").orderBy("k").collect()
    assert back[0].xs[0] == 1.5 and np.isnan(back[0].xs[1]) and back[0].m == {"a": float("inf")} and back[0].s == (2.0, "x")
    assert (back[1].xs, back[1].m, back[1].s) == (None, None, None)


def test_segmentation_file_and_image(spark, tmp_path):
    stat = [{"ypix": np.array([1, 2]), "xpix": np.array([3, 3]), "lam": np.array([0.5, 1.5], "float32")}, {"ypix": np.array([0]), "xpix": np.array([9]), "lam": np.array([2.0])}]
    np.save(tmp_path / "stat.npy", np.array(stat, dtype=object), allow_pickle=True)
    got = {(x.roi, x.r, x.c): x.w for x in files.segmentation_masks(spark, str(tmp_path / "stat.npy")).collect()}
    assert got == {(0, 1, 3): 0.5, (0, 2, 3): 1.5, (1, 0, 9): 2.0}
    # a grey picture in the simplest format that the reader knows
    rows = [[10, 200, 30], [40, 50, 60]]
    body = b"".join(bytes(b for v in row for b in (v, v, v)).ljust(12, b"\0") for row in reversed(rows))
    import struct

    head = b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 3, 2, 1, 24, 0, len(body), 0, 0, 0, 0)
    (tmp_path / "i.bmp").write_bytes(head + body)
    image = {(x.r, x.c): x.v for x in files.image(spark, str(tmp_path / "i.bmp")).collect()}
    assert image == {(r, c): float(v) for r, row in enumerate(rows) for c, v in enumerate(row)}


def test_the_first_folder_with_a_file(tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
    (tmp_path / "b" / "x.tif").write_bytes(b"1")
    folders = [str(tmp_path / "a"), str(tmp_path / "b")]
    assert files.first_existing(folders, "x.tif") == f"{folders[1]}/x.tif"
    with pytest.warns(UserWarning):
        assert files.first_existing(folders, "y.tif") is None


def test_records_keep_their_names(spark):
    dense = rois.to_dense(spark.createDataFrame([(1, 0, 0)], "roi int, r int, c int")).withColumnRenamed("mask", "mask_matrix")
    assert {"mask", "exclusion_labels"} <= set(rois.renamed(dense).columns)
