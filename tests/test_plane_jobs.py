"""The decrosstalk and demixing jobs against plain loops over their rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenflow.functions import kernels
from lumenflow.operators import plane_jobs as jobs
from lumenflow.sources import scratch

N = 900
RULES = jobs.Rules(spread=4, clip_size=200, fits=6)


def _source(seed, share=0.03, n=N):
    rng = np.random.default_rng(seed)
    events = (rng.random(n) < share) * rng.exponential(40, n)
    return np.convolve(events, 0.8 ** np.arange(30))[:n] + rng.normal(100, 1, n)


def _regions():
    """Regions that end at each stage: roi -> four channels."""
    out = {}
    for roi in (1, 2, 3):
        a, b = _source(roi), _source(roi + 50)
        out[roi] = [0.9 * a + 0.1 * b, 0.2 * a + 0.8 * b, 0.5 * a + 20, 0.3 * b + 10]
    a, b = _source(4), _source(54)
    out[4] = [np.where(np.arange(N) == 7, np.nan, a), b, a, b]  # a gap in the raw signal
    out[5] = [a, b, a, b[: N - 5]]  # a channel that ends early
    quiet = 100 - np.abs(np.random.default_rng(5).normal(0, 1, N))
    quiet[::2] = 100.0
    out[6] = [quiet, b, a, b]  # no active frames
    out[7] = [a * 0.5 + b * 0.5, a * 0.5 + b * 0.5 + 1e-3 * np.random.default_rng(7).normal(size=N), a, b]  # can't be unmixed by itself
    return out


def _frame(spark, regions):
    rows = []
    for roi, channels in regions.items():
        for t in range(N):
            rows.append((roi, t, *(float(c[t]) if t < len(c) else None for c in channels)))
    return spark.createDataFrame(rows, "roi int, t int, signal double, crosstalk double, np_signal double, np_crosstalk double").repartition(3)


def _active(x, rules=RULES):
    flags = -kernels.activity(np.asarray(x, float), 5) >= rules.threshold
    at = np.flatnonzero(flags)
    return sorted({int(t + d) for t in at for d in range(-rules.spread, rules.spread + 1) if 0 <= t + d < len(x)})


def _rolled(x, mask, size):
    mean, std = np.full(len(x), np.nan), np.full(len(x), np.nan)
    for i in range(len(x)):
        lo = min(max(i - size // 2, 0), max(len(x) - size, 0))
        own = x[lo : lo + size][mask[lo : lo + size]]
        mean[i], std[i] = own.mean() if len(own) else np.nan, own.std(ddof=1) if len(own) > 1 else np.nan
    return mean, std


def _plain(regions, rules=RULES):
    """The job's rules one region after another: the failed lists and the final signals."""
    failed = {k: set() for k in ("raw", "raw_active", "unmixed", "unmixed_active", "ghost")}
    good = {}
    for roi, c in regions.items():
        if len({len(x) for x in c}) > 1 or any(np.isnan(x).any() for x in c):
            failed["raw"].add(roi)
        elif not _active(c[0], rules):
            failed["raw_active"].add(roi)
        else:
            good[roi] = c
    own = {}
    for roi, c in good.items():
        quiet = np.setdiff1d(np.arange(len(c[0])), _active(c[0], rules))
        _, m, done = kernels.unmixed(np.array(c[:2]), rules.fits, int(np.round(np.abs(c[0][quiet]).sum())) % 2**32)
        own[roi] = (m, done)
    fine = [m for m, done in own.values() if done]
    if not fine:
        failed["unmixed"] |= set(good)
        return failed, {}
    a, b = np.mean([min(m[0]) for m in fine]), np.mean([min(m[1]) for m in fine])
    out = {}
    for roi, c in good.items():
        m = own[roi][0] if own[roi][1] else np.array([[1 - a, a], [b, 1 - b]])
        roi_pair, np_pair = np.linalg.solve(m, np.array(c[:2])), np.linalg.solve(m, np.array(c[2:]))
        mask = np.ones(len(c[0]), bool)
        mask[_active(roi_pair[0], rules)] = False
        clipped = []
        for x in (roi_pair[0], np_pair[0]):
            mean, std = _rolled(x, mask if mask.any() else ~mask, rules.clip_size)
            least = np.nan_to_num(mean - rules.clip_sigmas * std, nan=-999.0)
            clipped.append(np.where(x > least, x, least))
        events, other = _active(clipped[0], rules), _active(roi_pair[1], rules)
        if not events:
            failed["unmixed_active"].add(roi)
        elif all(any(abs(e - o) <= rules.window for o in other) for e in events):
            failed["ghost"].add(roi)
        out[roi] = (clipped[0], roi_pair[1], clipped[1], np_pair[1])
    return failed, out


def _lists(job):
    out = {k: set() for k in ("raw", "raw_active", "unmixed", "unmixed_active", "ghost")}
    for r in job.failed.collect():
        out[r.stage].add(r.roi)
    return out


def test_decrosstalk_against_a_loop(spark, tmp_path):
    regions = _regions()
    ghost = _source(8)
    regions[8] = [np.concatenate([[100.0], ghost[:-1]]), ghost * 3, ghost + 1, ghost * 2]  # its events are the other plane's
    job = jobs.take_out_crosstalk(_frame(spark, regions), str(tmp_path / "j"), RULES)
    failed, out = _plain(regions)
    assert _lists(job) == failed and failed["raw"] == {4, 5} and failed["raw_active"] == {6}
    got = {}
    for r in job.unmixed.orderBy("t").collect():
        got.setdefault(r.roi, []).append((r.signal, r.crosstalk, r.np_signal, r.np_crosstalk))
    assert got.keys() == out.keys()
    for roi, channels in out.items():
        assert np.allclose(np.array(got[roi]).T, channels, rtol=1e-6)
    assert not job.mixing.where("roi = 7").first().converged and job.mixing.where("roi = 7").first().m00 is not None
    table, flags = jobs.without_crosstalk(job, spark.createDataFrame([(k,) for k in regions], "roi int"))
    lost = set().union(*failed.values())
    blank = {r.roi for r in table.where("isnan(f)").select("roi").distinct().collect()}
    assert blank == lost and table.count() == N * len(regions)
    assert {r.roi for r in flags.where("raw and raw_active and unmixed and unmixed_active").collect()} >= set(regions) - lost


@pytest.mark.parametrize("ends", ["nothing", "raw", "raw_active", "unmixed", "unmixed_active"])
def test_early_ends(spark, tmp_path, ends):
    """A recording whose last regions fail at a stage: later tables are empty and have their columns."""
    every, rules = _regions(), RULES
    regions = {"nothing": {}, "raw": {k: every[k] for k in (4, 5)}, "raw_active": {6: every[6]}, "unmixed": {7: every[7]}, "unmixed_active": {1: every[1]}}[ends]
    if ends == "unmixed_active":
        # unmixing leaves no active frames: what the signal shows is the other plane's
        b = _source(61)
        flat = 100 + np.random.default_rng(3).uniform(-1e-6, 1e-6, N)
        regions = {1: [0.9 * flat + 0.1 * b, b, flat, b]}
    job = jobs.take_out_crosstalk(_frame(spark, regions), str(tmp_path / "j"), rules)
    failed, out = _plain(regions, rules)
    assert _lists(job) == failed
    if ends not in ("nothing", "unmixed_active"):
        assert failed[ends] == set(regions)
    if ends in ("nothing", "raw", "raw_active"):
        assert job.unmixed.count() == 0 and "signal" in job.unmixed.columns and job.unmixed_events.columns == ["roi", "channel", "t", "f"]
    if ends == "unmixed":
        assert job.unmixed.where("not isnan(signal)").count() == 0 and job.unmixed_events.count() == 0


def test_a_lost_job_goes_on(spark, tmp_path, monkeypatch):
    regions = {k: v for k, v in _regions().items() if k < 4}
    path = str(tmp_path / "j")
    monkeypatch.setattr(jobs, "_unmixed", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        jobs.take_out_crosstalk(_frame(spark, regions), path, RULES)
    assert scratch.is_whole(spark, f"{path}/mixing") and not scratch.is_whole(spark, f"{path}/unmixed")
    monkeypatch.undo()
    monkeypatch.setattr(jobs.decrosstalk, "mixings", lambda *_: (_ for _ in ()).throw(RuntimeError("made again")))
    job = jobs.take_out_crosstalk(_frame(spark, regions), path, RULES)
    assert _lists(job) == _plain(regions)[0] and job.unmixed.count() == 3 * N


def _scene():
    """Six regions on a movie: 1 and 2 overlap, 2 and 3 overlap, 4 alone, 5 barred."""
    masks = {1: [(r, c) for r in range(2, 6) for c in range(2, 6)], 2: [(r, c) for r in range(4, 8) for c in range(4, 8)], 3: [(r, c) for r in range(7, 10) for c in range(7, 10)], 4: [(r, c) for r in range(12, 15) for c in range(2, 5)], 5: [(r, c) for r in range(12, 15) for c in range(10, 13)], 6: [(r, c) for r in range(1, 3) for c in range(11, 14)]}
    rng = np.random.default_rng(11)
    movie = rng.uniform(5, 6, (30, 16, 16))
    movie[:, 2:4, 2:6] -= rng.uniform(30, 31, (30, 1, 1))  # region 1 is negative
    movie[:, 12:15, 2:5] *= rng.choice([-1.0, 4.0, 0.5], (30, 1, 1))  # region 4 near zero
    movie[13, 12:15, 10:13] = 0
    return masks, movie


def test_demixing_job(spark, tmp_path):
    masks, movie = _scene()
    t, r, c = np.meshgrid(*map(np.arange, movie.shape), indexing="ij")
    frames = spark.createDataFrame(list(zip(*(x.ravel().tolist() for x in (r, c, t, movie)))), "r int, c int, t int, v double")
    pixels = spark.createDataFrame([(roi, *p) for roi, px in masks.items() for p in px], "roi int, r int, c int")
    labels = spark.createDataFrame([(roi, ["union"] if roi == 5 else (["small_size"] if roi == 3 else [])) for roi in masks], "roi int, exclusion_labels array<string>")
    out = jobs.demix_job(frames, pixels, labels.where("true"), str(tmp_path / "d"), ["union", "duplicate"], window=10, run=3, sigmas=1.0)
    ids = [1, 2, 3, 4, 6]
    want = np.zeros((5, 30))
    for f in range(30):
        x = {i: np.array([movie[f][p] for p in masks[i]]) for i in ids}
        s = np.array([x[i].mean() for i in ids])
        shared = np.array([[sum(movie[f][p] for p in set(masks[i]) & set(masks[j])) / s[k] for k, j in enumerate(ids)] for i in ids])
        want[:, f] = np.linalg.lstsq(shared, s * [len(masks[i]) for i in ids], rcond=None)[0]
    mean, std = want.mean(axis=1), want.std(axis=1)
    negative = {i for i, m, d in zip(ids, mean, std) if m + d < 0}
    zero = {i for i, m, d in zip(ids, mean, std) if m < d}
    near = {i: {j for j in ids if set(masks[i]) & set(masks[j])} for i in ids}
    bad = zero | {k for i in negative for j in near[i] for k in near[j]}
    assert negative and bad != set(ids) | {5}
    listed = {(r.roi, r.reason) for r in out.listed.collect()}
    assert {x for x, why in listed if why == "negative_baseline"} == bad and {x for x, why in listed if why == "excluded"} == {5}
    transient = set()
    for i, x in zip(ids, want):
        pad = np.concatenate([np.full(9, x[:10].mean()), x])
        low = [x[k] < pad[k : k + 10].mean() - pad[k : k + 10].std() for k in range(30)]
        if any(all(low[k : k + 3]) for k in range(28)):
            transient.add(i)
    assert {x for x, why in listed if why == "negative_transient"} == transient
    got = {(r.roi, r.t): r.f for r in out.traces.collect()}
    assert len(got) == 6 * 30
    for (roi, f), v in got.items():
        assert math.isnan(v) if roi in bad | {5} else np.isclose(v, want[ids.index(roi), f])
    assert out.frames.count() == 0
    again = jobs.demix_job(frames.where("false"), pixels, labels, str(tmp_path / "d"), ["union", "duplicate"])
    assert again.listed.count() == len(listed)
