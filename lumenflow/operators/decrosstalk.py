"""Two planes recorded together: traces of a region in both, their unmixing, and the flags of the stages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.functions import kernels
from lumenflow.operators import sliding

#: Rows of the traces that are fitted together.
FITTED_TOGETHER = 2**18

#: The stages in which a region can fail.
STAGES = ("raw", "raw_active", "unmixed", "unmixed_active")


def paired_traces(movies: DataFrame, pixels: DataFrame) -> DataFrame:
    """plane, roi, t, signal and crosstalk: the mean over a region's pixels (plane, roi, r, c) in its own plane's movie
    and in the other one (plane, r, c, t, v). One join serves both planes and both movies."""
    held = movies.select(F.col("plane").alias("filmed"), "r", "c", "t", "v")
    own = F.col("filmed") == F.col("plane")
    mean = lambda which, name: F.avg(F.when(which, F.col("v"))).alias(name)
    return pixels.select("plane", "roi", "r", "c").join(held, ["r", "c"]).groupBy("plane", "roi", "t").agg(mean(own, "signal"), mean(~own, "crosstalk"))


def unmixed(pairs: DataFrame, tries: int = 10, seed: int = 0) -> DataFrame:
    """roi, t, signal, crosstalk, the mixing matrix m00 to m11 and whether its off-diagonal parts came to lie within 0 and
    0.3, by independent components of each region's two traces (roi, t, signal, crosstalk: no gaps). A task holds the whole
    traces of many regions. Two frames or fewer, or traces in proportion, stay as they are, unmixed
    by the identity and not marked as done."""

    def rule(table: pa.Table, starts: np.ndarray) -> pa.Table:
        fits = kernels.unmixed_all(_pairs(table, starts), tries, np.full(len(starts), seed))
        size = np.diff(np.append(starts, table.num_rows))
        out = {"roi": table.column("roi"), "t": table.column("t"), "signal": np.concatenate([x[0] for x, _, _ in fits]), "crosstalk": np.concatenate([x[1] for x, _, _ in fits])}
        return pa.table(out | {k: np.repeat(v, size) for k, v in _columns(fits, "done").items()})

    return _through_pairs(pairs, rule, "roi long, t long, signal double, crosstalk double, m00 double, m01 double, m10 double, m11 double, done boolean")


def mixings(pairs: DataFrame, tries: int = 10) -> DataFrame:
    """roi, m00 to m11 and converged: each region's mixing matrix as ``unmixed`` finds it, with the random stream of the region's
    ``seed`` (roi, t, signal, crosstalk, seed: no gaps)."""

    def rule(table: pa.Table, starts: np.ndarray) -> pa.Table:
        fits = kernels.unmixed_all(_pairs(table, starts), tries, table.column("seed").to_numpy()[starts])
        return pa.table({"roi": table.column("roi").take(pa.array(starts)), **_columns(fits, "converged")})

    return _through_pairs(pairs, rule, "roi long, m00 double, m01 double, m10 double, m11 double, converged boolean", "seed")


def _through_pairs(pairs: DataFrame, rule, schema: str, *more: str) -> DataFrame:
    """``rule`` on both traces of many regions at a time, as fits of one region alone are mostly calls."""
    rows = pairs.select(F.col("roi").cast("long").alias("roi"), F.col("t").cast("long").alias("t"), F.col("signal"), F.col("crosstalk").cast("double").alias("crosstalk"), *more)
    return sliding.through_regions(rows, rule, schema, "signal", ("crosstalk", *more), FITTED_TOGETHER)


def _pairs(table: pa.Table, starts: np.ndarray) -> list[np.ndarray]:
    return np.split(np.vstack([table.column(c).to_numpy().astype(float) for c in ("f", "crosstalk")]), starts[1:], axis=1)


def _columns(fits: list, name: str) -> dict[str, np.ndarray]:
    return {f"m{i}{j}": np.array([m[i, j] for _, m, _ in fits]) for i in (0, 1) for j in (0, 1)} | {name: np.array([done for _, _, done in fits])}


def whitened(pairs: DataFrame) -> DataFrame:
    """roi, t, x0, x1: both traces of a region without mean, correlation and scale, by the inverse root of their
    covariance in closed form (2 by 2)."""
    n = F.count("*")
    moments = pairs.groupBy("roi").agg(F.avg("signal").alias("a"), F.avg("crosstalk").alias("b"), F.var_pop("signal").alias("p"), F.covar_pop("signal", "crosstalk").alias("q"), F.var_pop("crosstalk").alias("s"), n.alias("n"))
    # the root of a 2 by 2 matrix C is (C + d I) / t with d = sqrt(det C) and t = sqrt(trace C + 2 d)
    d = F.sqrt(F.greatest(F.col("p") * F.col("s") - F.col("q") * F.col("q"), F.lit(0.0)))
    root = moments.withColumn("d", d).withColumn("k", F.col("d") * F.sqrt(F.col("p") + F.col("s") + 2 * F.col("d")))
    x, y = F.col("signal") - F.col("a"), F.col("crosstalk") - F.col("b")
    part = lambda u, v: F.try_divide(u * x - F.col("q") * v, F.col("k"))
    first, second = part(F.col("s") + F.col("d"), y), F.try_divide((F.col("p") + F.col("d")) * y - F.col("q") * x, F.col("k"))
    return pairs.join(root, "roi").select("roi", "t", first.alias("x0"), second.alias("x1"))


def stage_flags(regions: DataFrame, failed: DataFrame) -> DataFrame:
    """roi, a validity for each stage, and ghost. ``failed`` (roi, stage) holds the regions on each stage's list; on the lists
    of a trace and of its active frames, a region failed only the second. What fails a stage fails all later ones."""
    on = lambda stage: F.coalesce(F.max((F.col("stage") == stage).cast("int")), F.lit(0)) == 1
    lists = regions.select("roi").join(failed.select("roi", "stage"), "roi", "left").groupBy("roi").agg(*(on(s).alias(f"on_{s}") for s in (*STAGES, "ghost")))
    at = lambda s: F.col(f"on_{s}")

    def passed(trace: str) -> Column:
        return ~at(trace) | at(f"{trace}_active")

    raw = passed("raw")
    raw_active = raw & ~at("raw_active")
    plain = raw_active & passed("unmixed")
    return lists.select("roi", raw.alias("raw"), raw_active.alias("raw_active"), plain.alias("unmixed"), (plain & ~at("unmixed_active")).alias("unmixed_active"), at("ghost").alias("ghost"))


def with_invalid(trace: DataFrame, regions: DataFrame, frames_if_none: int = 10_000) -> DataFrame:
    """roi, t, f for all regions: those without a trace get NaN in every frame; where no region has a trace, in
    ``frames_if_none`` frames."""
    frames = trace.agg(F.coalesce(F.max("t") + 1, F.lit(frames_if_none)).cast("int").alias("n"))  # one row
    missing = regions.select("roi").distinct().join(trace.select("roi").distinct(), "roi", "left_anti").join(F.broadcast(frames))
    blank = missing.select("roi", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("t"), F.lit(float("nan")).alias("f"))
    return trace.select("roi", "t", "f").unionByName(blank)


def first_open_mixing(mixing: DataFrame) -> DataFrame:
    """The mean mixing matrix as the regions that didn't converge hold it: that of the least such region."""
    return mixing.where(~F.col("converged")).orderBy("roi").limit(1).drop("converged")


def labelled_frames(frames: DataFrame, trace: DataFrame) -> DataFrame:
    """part, mean, deviation, frames: figures of the training frames beside both lists of frames (t, part)."""
    figures = trace.join(frames.where(F.col("part") == "train"), "t", "left_semi").agg(F.avg("f").alias("mean"), F.stddev_pop("f").alias("deviation"))
    return frames.groupBy("part").agg(F.sort_array(F.collect_list("t")).alias("frames")).join(F.broadcast(figures))
