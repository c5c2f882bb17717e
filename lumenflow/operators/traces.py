"""From movie and masks to traces, and the rules on traces."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.functions import kernels
from lumenflow.operators import sliding

#: A side of a join with up to this many rows is broadcast.
BROADCAST_ROWS = 500_000


def if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a side for broadcast only if a count shows that it is small."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def all_regions_mean(movie: DataFrame, pixels: DataFrame, invalid: DataFrame) -> DataFrame:
    """roi, t, f of all regions: invalid ones (roi), and those without pixels in the movie, are NaN in all frames."""
    regions = pixels.select("roi").union(invalid.select("roi")).distinct()
    grid = regions.join(F.broadcast(movie.agg((F.max("t") + 1).alias("n")))).select("roi", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("t"))
    known = masked_mean(movie, pixels.join(invalid.select("roi"), "roi", "left_anti"))
    return grid.join(known, ["roi", "t"], "left").select("roi", "t", F.coalesce("f", F.lit(float("nan"))).alias("f"))


def masked_mean(movie: DataFrame, pixels: DataFrame) -> DataFrame:
    """Mean of a region's pixels in each frame: roi, t, f. Sums are combined before the shuffle."""
    return movie.join(if_small(pixels), ["r", "c"]).groupBy("roi", "t").agg(F.avg("v").alias("f"))


def regions_and_surroundings(movie: DataFrame, pixels: DataFrame, reach: int, extent: DataFrame, border: tuple[float, float, float, float] = (0, 0, 0, 0)) -> DataFrame:
    """roi, t, f, np: the mean of each region's pixels and of those around it, null without any. Masks of both kinds meet the movie in
    one join, so it is read once."""
    own = pixels.select("roi", "r", "c").withColumn("around", F.lit(False))
    both = own.unionByName(neuropil_mask(pixels, reach, extent, border).withColumn("around", F.lit(True)))
    mean = lambda around, name: F.avg(F.when(F.col("around") == around, F.col("v"))).alias(name)
    return movie.join(if_small(both), ["r", "c"]).groupBy("roi", "t").agg(mean(False, "f"), mean(True, "np"))


def weighted_trace(movie: DataFrame, pixels: DataFrame, by_size: bool = True) -> DataFrame:
    """Weighted sum of a region's pixels, divided by their number if asked for."""
    total = F.sum(F.col("v") * F.col("w"))
    return movie.join(if_small(pixels), ["r", "c"]).groupBy("roi", "t").agg((total / F.count("*") if by_size else total).alias("f"))


def neuropil_mask(pixels: DataFrame, reach: int, extent: DataFrame, border: tuple[float, float, float, float] = (0, 0, 0, 0)) -> DataFrame:
    """Pixels within ``reach`` of a region (in rows and columns), in the frame less its border (left, right, bottom, top), of
    no region: roi, r, c."""
    left, right, bottom, top = border
    offsets = F.sequence(F.lit(-reach), F.lit(reach))
    near = pixels.select("roi", "r", "c", F.explode(offsets).alias("dr")).select("roi", (F.col("r") + F.col("dr")).alias("r"), "c").distinct()
    near = near.select("roi", "r", F.col("c"), F.explode(offsets).alias("dc")).select("roi", "r", (F.col("c") + F.col("dc")).alias("c")).distinct()
    near = near.join(extent).where(F.col("r").between(F.ceil(F.lit(float(top))), F.floor(F.col("rows") - bottom) - 1) & F.col("c").between(F.ceil(F.lit(float(left))), F.floor(F.col("columns") - right) - 1))
    return near.join(pixels.select("r", "c").distinct(), ["r", "c"], "left_anti").select("roi", "r", "c")


def robust_std(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """1.4826 times the median distance from the median, per key."""
    middle = df.groupBy(*keys).agg(F.percentile(value, F.lit(0.5)).alias("m"))
    return df.join(middle, keys).groupBy(*keys).agg((F.percentile(F.abs(F.col(value) - F.col("m")), F.lit(0.5)) * 1.4826).alias("robust_std"))


def _frame(half: int):
    return Window.partitionBy("roi").orderBy("t").rowsBetween(-half, half)


def _whole(table: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values (0 in traces with gaps), the number of each row's trace, and which traces have no gaps."""
    f = sliding.values(table)
    trace = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(f))))
    whole = np.bincount(trace[np.isnan(f)], minlength=len(starts)) == 0
    return np.where(whole[trace], f, 0.0), trace, whole


def rolling_quantile(trace: DataFrame, size: int, rank: int) -> DataFrame:
    """roi, t, f, and q: the value of the given rank (from 0) in each window of odd ``size``, edges mirrored; null in a trace with gaps.
    A window slides through the traces of a task one after the other."""

    def rule(table: pa.Table, starts: np.ndarray) -> pa.Table:
        f, own, whole = _whole(table, starts)
        q = np.where(whole[own], kernels.rank_filter_all(f, starts, size, rank), np.nan)
        return sliding.with_columns(table, q=q).add_column(2, "f", table.column("f"))

    kinds = dict(trace.dtypes)
    return sliding.through_regions(trace, rule, f"roi {kinds['roi']}, t {kinds['t']}, f double, q double")


def rolling_median(trace: DataFrame, size: int) -> DataFrame:
    return rolling_quantile(trace, size, size // 2)


def _noise(f: np.ndarray, starts: np.ndarray, whole: np.ndarray, size: int) -> np.ndarray:
    """Each trace's noise; NaN for those with gaps."""
    left = np.split(f - kernels.rank_filter_all(f, starts, size, size // 2), starts[1:])
    return np.array([kernels.deviation_left(x) if ok else np.nan for x, ok in zip(left, whole)])


def noise_std(trace: DataFrame, size: int) -> DataFrame:
    """Robust deviation of what a rolling median leaves, without large and negative outliers: roi, noise; null for
    traces with gaps and where no value is left."""

    def rule(table: pa.Table, starts: np.ndarray) -> pa.Table:
        f, _, whole = _whole(table, starts)
        return pa.table({"roi": table.column("roi").take(pa.array(starts)), "noise": pa.array(_noise(f, starts, whole, size), from_pandas=True)})

    return sliding.through_regions(trace, rule, f"roi {dict(trace.dtypes)['roi']}, noise double")


def dff(trace: DataFrame, short: int, long: int) -> DataFrame:
    """(F - baseline) / max(baseline, noise), the baseline a rolling median: roi, t, dff, small_baseline. Nulls in traces with gaps."""

    def rule(table: pa.Table, starts: np.ndarray) -> pa.Table:
        f, own, whole = _whole(table, starts)
        base, noise = kernels.rank_filter_all(f, starts, long, long // 2), _noise(f, starts, whole, short)[own]
        # without a noise the baseline counts alone, as the greater of the two
        scale = np.fmax(base, noise)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.where(whole[own] & (scale != 0), (f - base) / scale, np.nan)
        small = pa.array(base <= noise, mask=~whole[own] | np.isnan(noise))
        return sliding.with_columns(table, dff=out).append_column("small_baseline", small)

    kinds = dict(trace.dtypes)
    return sliding.through_regions(trace, rule, f"roi {kinds['roi']}, t {kinds['t']}, dff double, small_baseline boolean")


def dilate(flags: DataFrame, reach: int) -> DataFrame:
    """A flag spreads to ``reach`` frames on both sides."""
    return flags.withColumn("active", F.max("active").over(_frame(reach)))


def independent_events(signal: DataFrame, crosstalk: DataFrame, window: int = 2) -> DataFrame:
    """Signal events without a crosstalk event of the same region within the window."""
    spread = crosstalk.select("roi", F.explode(F.sequence(F.col("t") - window, F.col("t") + window)).alias("t")).distinct()
    return signal.join(spread, ["roi", "t"], "left_anti")


def baseline_flags(trace: DataFrame) -> DataFrame:
    """Regions whose mean and deviation put their baseline below or near zero."""
    stats = trace.groupBy("roi").agg(F.avg("f").alias("m"), F.stddev_pop("f").alias("s"))
    return stats.select("roi", (F.col("m") + F.col("s") < 0).alias("negative_baseline"), (F.col("m") < F.col("s")).alias("zero_baseline"))


def event_summary(events: DataFrame) -> DataFrame:
    """Number of events and their least positive size (0 if none)."""
    return events.groupBy("roi").agg(F.count_if(F.col("f") > 0).alias("n_events"), F.coalesce(F.min(F.when(F.col("f") > 0, F.col("f"))), F.lit(0.0)).alias("least"))


def negative_transients(trace: DataFrame, window: int, run: int = 10, sigmas: float = 3.0) -> DataFrame:
    """Regions with ``run`` frames in a row below the trailing mean less ``sigmas`` deviations.

    Before its start a trace counts as ``window`` - 1 frames of the mean of its first ``window`` frames.
    """
    order = Window.partitionBy("roi").orderBy("t")
    back = order.rowsBetween(-(window - 1), 0)
    first = F.avg(F.when(F.col("k") <= window, F.col("f"))).over(Window.partitionBy("roi"))
    own = trace.withColumn("k", F.row_number().over(order)).select("roi", "t", "f", first.alias("pad"), F.avg("f").over(back).alias("m"), F.stddev_pop("f").over(back).alias("s"), F.count("f").over(back).alias("n"), F.greatest(F.lit(0), window - F.col("k")).alias("n_pad"))
    # mean and variance of a window's own frames and its padding together
    share, gap = F.col("n") / (F.col("n") + F.col("n_pad")), F.col("m") - F.col("pad")
    mean, deviation = F.col("pad") + share * gap, F.sqrt(share * (F.col("s") * F.col("s") + (1 - share) * gap * gap))
    low = F.when(F.col("n_pad") > 0, mean - sigmas * deviation).otherwise(F.col("m") - sigmas * F.col("s"))
    below = own.withColumn("below", (F.col("f") < low).cast("int"))
    hit = below.withColumn("in_row", F.sum("below").over(order.rowsBetween(-(run - 1), 0))).where(F.col("in_row") == run)
    return hit.select("roi").distinct()
