"""Distances of touching pixels' correlations with what lies around them: tiles, odd series, bytes sent."""

import itertools
import math

import duckdb
import numpy as np
import pytest

from lumenflow.operators import graphs
from lumenflow.plans import imaging


def _pixels(spark, x, first=0):
    """A movie of an array of rows, columns and frames; rows whose first value is NaN are left out."""
    rows = [(r, c, first + t, float(v)) for (r, c), own in ((p, x[p]) for p in np.ndindex(x.shape[:2])) if own[0] == own[0] for t, v in enumerate(own)]
    return spark.createDataFrame(rows, "r int, c int, t int, v double")


def _expected(x, radius, share):
    rows, columns = x.shape[:2]
    there, out = [p for p in np.ndindex(rows, columns) if x[p][0] == x[p][0]], {}
    least = {p: -math.inf if share is None else np.quantile(x[p], 1 - share) for p in there}
    for a, b in itertools.combinations(there, 2):
        if max(abs(a[0] - b[0]), abs(a[1] - b[1])) == 1:
            on = (x[a] >= least[a]) | (x[b] >= least[b])
            near = [p for p in there if math.dist(p, ((a[0] + b[0]) / 2, (a[1] + b[1]) / 2)) <= radius]
            rho = np.corrcoef([x[p][on] for p in (a, b, *near)])
            out[a + b] = math.exp(-((rho[0, 2:] - rho[1, 2:]) ** 2).sum())
    return out


@pytest.mark.parametrize("radius, share, first", [(1.6, None, 0), (7, None, 0), (3.2, 0.2, 0), (1.6, None, 100), (1.6, 0.3, 100)])
def test_distances_over_the_edges_of_tiles(spark, radius, share, first):
    x = np.random.default_rng(2).normal(size=(18, 11, 20)).cumsum(axis=2)
    x[3, 4] = x[8, 0] = np.nan
    want = _expected(x, radius, share)
    got = {tuple(e[:4]): e.hnc for e in graphs.hnc_gaussian(_pixels(spark, x, first), radius, share).collect()}
    assert got.keys() == want.keys() and max(abs(got[e] - want[e]) for e in want) < 1e-9


def _vectors(kind):
    rng = np.random.default_rng(5)
    x = {k: rng.normal(size=64).tolist() for k in range(130)}
    if kind == "constant":
        x[70], x[71] = [0.1] * 64, [0.0] * 64
    if kind == "missing":
        x[40][9] = x[41][9] = x[41][60] = x[70][3] = None
        x[101] = [None] * 64
    if kind == "short":
        x[70], x[71], x[72], x[73], x[99] = x[70][:10], x[71][:1], [], None, x[99][:63]
    return [*x.items(), (70, x[3])] if kind == "repeated" else list(x.items())


@pytest.mark.parametrize("kind", ["constant", "missing", "short", "repeated"])
def test_odd_series_count_as_in_sql(spark, tmp_path, kind):
    """Without spread: NaN. A missing value: the pair is left out. Other frames: those that all three pixels have."""
    spark.createDataFrame(_vectors(kind), "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    db = duckdb.connect()
    for t in "supplier orders events customer nation".split():
        db.sql(f"CREATE VIEW {t} AS FROM '/root/testdata/sf0.001/{t}.parquet'")
    db.sql(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = sorted(map(str, db.execute(imaging.SQL["hnc_gaussian"]).fetchall()))
    assert sorted(str(tuple(e)) for e in imaging.QUERIES["hnc_gaussian"](spark, str(tmp_path)).collect()) == want


def test_a_series_is_sent_a_few_times(spark):
    """To every pixel around every edge, once the movie is too large for a broadcast, it would be some dozens of times."""

    def sent():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()

    movie = spark.range(24_000 * 16).selectExpr("cast(floor(id / 512) as int) as r", "cast(floor(id / 16) % 32 as int) as c", "cast(id % 16 as int) as t", "rand(1) as v")
    before, limit = sent(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        graphs.hnc_gaussian(movie, 1.6).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sent() - before < 8 * 24_000 * 16 * 8
