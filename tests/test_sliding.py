"""Filters over many traces at once against one trace at a time."""

import numpy as np
import pytest

from lumenflow.functions import kernels
from lumenflow.operators import checks, images, movies, signals, sliding, traces


def _traces(seed=0, n=25, gap=True):
    rng = np.random.default_rng(seed)
    out = {k: rng.normal(100, 5, rng.integers(1, 60)) for k in range(n)}
    if gap:
        out[3] = out[3].copy()
        out[3][0] = np.nan
    out[n] = rng.normal(100, 5, 700)
    return out


def _frame(spark, given):
    rows = [(k, t, None if np.isnan(v) and k % 2 else float(v)) for k, x in given.items() for t, v in enumerate(x)]
    return spark.createDataFrame(rows, "roi int, t int, f double").repartition(5)


@pytest.mark.parametrize("size", [1, 5, 41, 151])
@pytest.mark.parametrize("records", [7, 10_000])
def test_rolling_median_of_many_traces(spark, size, records):
    given = _traces(size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        got = {}
        for r in traces.rolling_median(_frame(spark, given), size).orderBy("roi", "t").collect():
            got.setdefault(r.roi, []).append(r.q)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k, x in given.items():
        if np.isnan(x).any():
            assert set(got[k]) == {None}
            continue
        wide = kernels.mirrored(x, size // 2)
        assert np.allclose(got[k], [np.median(wide[i : i + size]) for i in range(len(x))])


def test_noise_and_dff_of_many_traces(spark):
    given = _traces(9)
    df = _frame(spark, given)
    noise = {r.roi: r.noise for r in traces.noise_std(df, 5).collect()}
    rows = {}
    for r in traces.dff(df, 5, 31).orderBy("roi", "t").collect():
        rows.setdefault(r.roi, []).append(r)
    assert noise.keys() == given.keys() == rows.keys()
    for k, x in given.items():
        want = kernels.noise_std(x, 5)
        assert (noise[k] is None and np.isnan(want)) or np.isclose(noise[k], want)
        if np.isnan(x).any():
            assert {r.dff for r in rows[k]} == {None}
            continue
        base = kernels.median_filter(x, 31)
        assert np.allclose([r.dff for r in rows[k]], (x - base) / np.fmax(base, want))
        assert [r.small_baseline for r in rows[k]] == ([None] * len(x) if np.isnan(want) else (base <= want).tolist())


def test_held_and_gap_medians_of_many_traces(spark):
    given = _traces(4)
    df = _frame(spark, given)
    for size in (5, 151):
        got = {}
        for r in signals.held_median(df, size).orderBy("roi", "t").collect():
            got.setdefault(r.roi, []).append(np.nan if r.q is None else r.q)
        for k, x in given.items():
            wide = np.pad(x, size // 2, mode="edge")
            with np.errstate(all="ignore"):
                assert np.allclose(got[k], [np.nanmedian(wide[i : i + size]) if not np.isnan(wide[i : i + size]).all() else np.nan for i in range(len(x))], equal_nan=True)
    gaps = {}
    for r in checks.gap_median(df, 5).orderBy("roi", "t").collect():
        gaps.setdefault(r.roi, []).append(r.m)
    assert all(np.allclose(np.array(gaps[k], float), kernels.known_median_filter(x, 5), equal_nan=True) for k, x in given.items())


def test_no_traces_and_names_as_regions(spark):
    none = spark.createDataFrame([], "roi int, t int, f double")
    assert traces.dff(none, 3, 5).count() == traces.noise_std(none, 3).count() == 0
    named = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 4.0), (None, 0, 2.0), ("a", 1, 3.0)], "roi string, t int, f double")
    got = {(r.roi, r.t): r.q for r in traces.rolling_median(named, 3).collect()}
    assert got == {("a", 0): 1.0, ("a", 1): 3.0, ("b", 0): 4.0, (None, 0): 2.0}


def test_one_exchange_for_all_of_dff(spark, tmp_path):
    _frame(spark, _traces()).write.parquet(str(tmp_path / "t"))
    plan = traces.dff(spark.read.parquet(str(tmp_path / "t")), 5, 31)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "FlatMapGroupsInPandas" not in plan and "MapInArrow" in plan


def test_median_of_frames_with_missing_pixels(spark):
    rng = np.random.default_rng(3)
    frames = rng.normal(size=(3, 7, 6))
    rows = [(r, c, t, float(frames[t, r, c])) for t in range(3) for r in range(7) for c in range(6) if not (t == 1 and r == 6 and c > 2)]
    got = {(x.t, x.r, x.c): x.v for x in images.median_filter(spark.createDataFrame(rows, "r int, c int, t int, v double").repartition(4), 3).collect()}
    assert len(got) == len(rows)
    frames[1, 6, 3:] = np.nan
    for (t, r, c), v in got.items():
        wide = np.pad(frames[t], 1, mode="symmetric")[r : r + 3, c : c + 3]
        assert np.isclose(v, np.nanmedian(wide))


def test_neighbour_correlation_over_tiles(spark):
    frames = np.random.default_rng(5).normal(size=(30, 19, 18))
    frames[:, 4, 4] = 2.0  # without spread
    rows = [(r, c, t, float(frames[t, r, c])) for t in range(30) for r in range(19) for c in range(18)]
    got = {((x.r0, x.c0), (x.r1, x.c1)): x.pearson for x in movies.neighbour_correlation(spark.createDataFrame(rows, "r int, c int, t int, v double").repartition(4)).collect()}
    want = {((r, c), (r + dr, c + dc)) for r in range(19) for c in range(18) for dr, dc in movies.NEIGHBOURS if 0 <= r + dr < 19 and 0 <= c + dc < 18}
    assert got.keys() == want
    for (p, q), v in got.items():
        if (4, 4) in (p, q):
            assert v is None
        else:
            assert np.isclose(v, np.corrcoef(frames[:, p[0], p[1]], frames[:, q[0], q[1]])[0, 1])
    copies = movies.tiled(movies.packed(spark.createDataFrame(rows, "r int, c int, t int, v double")), movies.NEIGHBOURS).count()
    assert copies < 1.6 * 19 * 18


def test_runs_of_regions():
    import pyarrow as pa

    table = pa.table({"roi": pa.chunked_array([[1, 1], [1, 2], [None, None]], pa.int64()), "t": list(range(6)), "f": [0.0] * 6})
    assert sliding._starts(table.combine_chunks()).tolist() == [0, 3, 4]
