"""Bundles and their manifest, quantiles with odd values, colours without a growing lineage."""

import hashlib
import json
import os

import numpy as np
import pytest

from lumenflow.operators import artifacts, movies, rois
from lumenflow.sources import digests as dg
from lumenflow.sources import files
from lumenflow.sources import movies as stored

FRAMES = np.random.default_rng(4).integers(0, 200, (12, 20, 24)).astype(float)
MASKS = {1: (3, 4, [[1, 1], [0, 1]]), 2: (5, 4, [[1], [1], [1]]), 7: (0, 0, [[1, 1, 1]]), 9: (21, 18, [[1, 1], [1, 1]])}


@pytest.fixture
def inputs(spark, tmp_path):
    t, r, c = np.meshgrid(*map(np.arange, FRAMES.shape), indexing="ij")
    movie = spark.createDataFrame(list(zip(*(x.ravel().tolist() for x in (r, c, t, FRAMES)))), "r int, c int, t int, v double")
    stored.write_movie(movie, str(tmp_path / "movie"), 6, 8)
    (tmp_path / "rois.json").write_text(json.dumps([{"id": k, "x": x, "y": y, "width": len(m[0]), "height": len(m), "valid": True, "mask": [[bool(b) for b in row] for row in m], "mask_page": 0, "exclusion_labels": []} for k, (x, y, m) in MASKS.items()]))
    movies.neighbour_correlation(movie).write.parquet(str(tmp_path / "edges"))
    (tmp_path / "motion.csv").write_text("framenumber,x,y\n0,1,-2\n1,-3,4\n")
    return {k: str(tmp_path / v) for k, v in (("movie_path", "movie"), ("roi_path", "rois.json"), ("edges_path", "edges"))}, str(tmp_path / "motion.csv")


def _image(df):
    out = np.full((20, 24), np.nan)
    for x in df.collect():
        out[x.r, x.c] = x.v
    return out


def _scale(x, lo, hi):
    return np.round((np.clip(x, lo, hi) - lo) / (hi - lo) * 255)


def test_labeler_bundle(spark, tmp_path, inputs):
    paths, motion = inputs
    out = artifacts.labeler_bundle(spark, str(tmp_path / "out"), **paths, motion_path=motion)
    top = FRAMES.max(axis=0)
    assert (_image(out["max"]) == _scale(top, *np.quantile(top, [0.2, 0.99]))).all()
    assert np.nanmax(_image(out["correlation"])) == 255 and np.nanmin(_image(out["correlation"])) == 0
    lo, hi = np.quantile(FRAMES, [0.1, 0.99])
    assert {(x.t, x.r, x.c): x.v for x in out["movie"].where("t = 3 and r < 2").collect()} == {(3, r, c): _scale(FRAMES, lo, hi)[3, r, c] for r in range(2) for c in range(24)}
    got = {(x.roi, x.t): x.f for x in out["traces"].collect()}
    for k, (x, y, m) in MASKS.items():
        on = np.argwhere(np.array(m))
        want = FRAMES[:, on[:, 0] + y, on[:, 1] + x].mean(axis=1)
        assert np.allclose([got[k, t] for t in range(12)], want)
    colour = {x.roi: x.colour for x in out["colours"].collect()}
    assert colour.keys() == MASKS.keys() and colour[1] != colour[2]
    assert out["border"].first().asDict() == {"left_side": 3.0, "right_side": 1.0, "top": 2.0, "bottom": 4.0}
    assert {x.input for x in out["manifest"].collect()} == {"movie", "rois", "correlation", "motion", "settings"}


def test_a_changed_input_changes_the_manifest(spark, tmp_path, inputs, monkeypatch):
    paths, _ = inputs
    at = str(tmp_path / "out")
    told = lambda bundle: {(x.input, x.digest) for x in bundle["manifest"].collect()}
    first = artifacts.labeler_bundle(spark, at, **paths)
    monkeypatch.setattr(artifacts, "scaled_image", lambda *_: (_ for _ in ()).throw(RuntimeError("made again")))
    assert told(artifacts.labeler_bundle(spark, at, **paths)) == told(first)
    with pytest.raises(RuntimeError):
        artifacts.labeler_bundle(spark, at, **paths, movie_shares=(0.0, 1.0))
    part = next(p for p in sorted((tmp_path / "movie").rglob("part-*.parquet")))
    with open(part, "ab") as f:
        f.write(b"x")
    changed = told({"manifest": artifacts.manifest(spark, {"movie": paths["movie_path"], "rois": paths["roi_path"]}, {})})
    assert {k for k, v in changed if (k, v) in told(first)} == {"rois"}


def test_digests(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(os.urandom(1000))
    (tmp_path / "empty").write_bytes(b"")
    os.makedirs(tmp_path / "d" / "e")
    (tmp_path / "d" / "x").write_bytes(b"1")
    (tmp_path / "d" / "e" / "y").write_bytes(b"2")
    (tmp_path / "d" / "_SUCCESS").write_bytes(b"")
    got = {x.input: (x.size, x.digest) for x in dg.digests(spark, {k: str(tmp_path / k) for k in ("a.bin", "empty", "d")}, 300).collect()}
    data = (tmp_path / "a.bin").read_bytes()
    md5 = lambda b: hashlib.md5(b).hexdigest()
    assert got["a.bin"] == (1000, md5("".join(md5(data[i : i + 300]) for i in range(0, 1000, 300)).encode()) + "-4")
    assert got["empty"] == (0, md5(b"")) and got["d"] == (2, md5(f"{md5(b'2')} e/y\n{md5(b'1')} x".encode()))
    assert dg.digests(spark, {"a": str(tmp_path / "a.bin")}).first().digest == md5(data)
    with pytest.raises(FileNotFoundError):
        dg.digests(spark, {"a": str(tmp_path / "none")})


def test_cut_outs_of_all_regions(spark, tmp_path, inputs):
    paths, _ = inputs
    out = artifacts.classifier_bundle(spark, str(tmp_path / "c"), **paths, size=6, selected=[1, 7, 9], weight="pearson")
    top = _image(spark.createDataFrame([(r, c, float(FRAMES[:, r, c].max())) for r in range(20) for c in range(24)], "r int, c int, v double"))
    scaled = _scale(top, *np.quantile(top, [0.2, 0.99]))
    windows = {}
    for x in out["cut_outs"].collect():
        windows.setdefault((x.roi, x.image), np.full((6, 6), -1))[x.r, x.c] = x.v
    assert {k for k, _ in windows} == {1, 7, 9} and {i for _, i in windows} == set(artifacts.IMAGES)
    for k in (1, 7, 9):
        x, y, m = MASKS[k]
        m = np.array(m)
        r0, c0 = round(y + m.shape[0] / 2) - 3, round(x + m.shape[1] / 2) - 3
        wide, mask = np.zeros((60, 60)), np.zeros((60, 60))
        wide[20:40, 20:44] = scaled
        mask[20 + y : 20 + y + m.shape[0], 20 + x : 20 + x + m.shape[1]] = m * 255
        at = np.s_[int(20 + r0) : int(26 + r0), int(20 + c0) : int(26 + c0)]
        assert (windows[k, "max"] == wide[at]).all() and (windows[k, "mask"] == mask[at]).all()
    assert out["empty"].count() == 0
    rows = {x.roi: np.array(x.window) for x in artifacts.selected_windows(out, "mask").collect()}
    assert (rows[9] == windows[9, "mask"]).all()


@pytest.mark.parametrize("few", [10_000, 2])
def test_quantiles_with_odd_values(spark, monkeypatch, few):
    monkeypatch.setattr(movies, "FEW", few)
    monkeypatch.setattr(movies, "STEPS", 4)
    inf, nan = float("inf"), float("nan")
    table = lambda x: spark.createDataFrame([(v,) for v in x], "v double").repartition(3)
    values = [float(v) for v in range(101)]
    assert movies.quantiles(table([*values, nan, None, nan]), "v", [0.5, 0.0, 1.0, 0.015]) == [50.0, 0.0, 100.0, 1.5]
    assert movies.quantiles(table([nan, None]), "v", [0.5]) == [None]
    assert movies.quantiles(table([-inf, 1.0, 2.0, inf, inf]), "v", [0.0, 0.25, 0.5, 0.75, 1.0]) == [-inf, 1.0, 2.0, inf, inf]
    assert movies.quantiles(table([inf, inf]), "v", [0.3]) == [inf]
    assert movies.quantiles(table([-1.7e308, 1.7e308, 0.0, 5e-324]), "v", [0.0, 1 / 3, 2 / 3, 1.0])[0::3] == [-1.7e308, 1.7e308]
    x = np.random.default_rng(1).normal(size=500) ** 5
    assert np.allclose(movies.quantiles(table(x.tolist()), "v", [0.01, 0.3, 0.77]), np.quantile(x, [0.01, 0.3, 0.77]), rtol=1e-12)


def test_colours_of_a_chain(spark):
    chain = spark.createDataFrame([(k, 0, k) for k in range(12)] + [(50, 5, 5)], "roi int, r int, c int")
    colour = {x.roi: x.colour for x in rois.colours(chain).collect()}
    assert len(colour) == 13 and all(colour[k] != colour[k + 1] for k in range(11)) and colour[50] == 0
    plan = rois.colours(chain)._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan
