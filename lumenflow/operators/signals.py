"""Rules over frames: filters with held edges, clipping, frame choice, and figures of whole recordings."""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.functions import kernels
from lumenflow.operators import sliding


def _held(df: DataFrame, keys: list[str], before: int, after: int) -> DataFrame:
    """Rows at p from -before to n - 1 + after, the edge values held; p equals k for the rows themselves."""
    numbered = df.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("t")) - 1).withColumn("n", F.count("*").over(Window.partitionBy(*keys)))
    places = F.sequence(F.when(F.col("k") == 0, F.lit(-before)).otherwise(F.col("k")), F.when(F.col("k") == F.col("n") - 1, F.col("n") - 1 + after).otherwise(F.col("k")))
    return numbered.withColumn("p", F.explode(places))


def _around(keys: list[str], before: int, after: int):
    return Window.partitionBy(*keys).orderBy("p").rowsBetween(-before, after)


def boxcar(movie: DataFrame, size: int, keys: list[str], value: str = "v") -> DataFrame:
    """Mean over ``size`` frames (even sizes reach further back), edges held."""
    before = size // 2
    mean = F.avg(value).over(_around(keys, before, size - 1 - before))
    return _held(movie, keys, before, size - 1 - before).withColumn("smooth", mean).where("p = k").select(*keys, "t", F.col("smooth").alias(value))


def held_median(trace: DataFrame, size: int, value: str = "f") -> DataFrame:
    """roi, t, the value and ``q``: the median over an odd window, edges held, of the values that are there."""
    def rule(table: pa.Table, starts: np.ndarray) -> pa.Table:
        f = sliding.values(table)
        if size <= kernels._SHORT or np.isnan(f).any():
            padded, at = kernels.padded_all(f, starts, size // 2, held=True)
            gaps = np.isnan(f).any()
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")  # a window without values has none
                q = kernels.windows_at(padded, at, size, lambda w: np.nanmedian(w, axis=1) if gaps else np.median(w, axis=1))
        else:
            q = kernels.rank_filter_all(f, starts, size, size // 2, held=True)
        return sliding.with_columns(table, q=q).add_column(2, value, table.column("f"))

    kinds = dict(trace.dtypes)
    return sliding.through_regions(trace, rule, f"roi {kinds['roi']}, t {kinds['t']}, {value} double, q double", value)


def clip_outliers(trace: DataFrame, size: int, most: float) -> DataFrame:
    """Values further than ``most`` from the rolling median are set to that distance."""
    f, q = F.col("f"), F.col("q")
    return held_median(trace, size).select("roi", "t", F.least(F.greatest(f, q - most), q + most).alias("f"))


def event_detrend(trace: DataFrame, noise: DataFrame, size: int) -> DataFrame:
    """Subtracts the rolling median, but no more than 2.5 times the region's ``noise``."""
    return held_median(trace, size).join(noise, "roi").select("roi", "t", (F.col("f") - F.least("q", 2.5 * F.col("noise"))).alias("f"))


def reset_trimmed(shift: DataFrame, start: int, end: int) -> DataFrame:
    """No motion in the first ``start`` and last ``end`` frames (t from 0)."""
    n = F.broadcast(shift.agg((F.max("t") + 1).alias("n")))  # one row
    out = (F.col("t") < start) | (F.col("t") >= F.col("n") - end)
    return shift.join(n).select("t", *(F.when(out, F.lit(0.0)).otherwise(F.col(c)).alias(c) for c in ("x", "y")))


def spaced_frames(movie: DataFrame, frames: int, start: int = 0, end: int = 0) -> DataFrame:
    """Up to ``frames`` frames evenly spaced over the recording without its trimmed ends."""
    span = movie.agg((F.max("t") + 1 - start - end).alias("n"))
    count = F.least(F.col("n"), F.lit(frames))
    chosen = span.select("n", F.explode(F.sequence(F.lit(0), count - 1)).alias("i")).select((F.floor(F.col("i") * F.col("n") / F.least(F.col("n"), F.lit(frames))) + start).cast("int").alias("t"))
    return movie.join(F.broadcast(chosen), "t", "left_semi")  # at most ``frames`` rows


def refill_ratios(ratios: DataFrame, most: float = 1.0, fill: float = 0.7, least: int = 5) -> DataFrame:
    """Ratios beyond ``most`` become the mean of the good ones, or ``fill`` where those are too few: roi, r, filled."""
    good = F.when((F.col("r") > 0) & (F.col("r") <= most), F.col("r"))
    mean = ratios.agg(F.when(F.count(good) >= least, F.avg(good)).otherwise(F.lit(fill)).alias("mean"))
    bad = F.col("r") > most
    return ratios.join(F.broadcast(mean)).select("roi", F.when(bad, F.col("mean")).otherwise(F.col("r")).alias("r"), bad.alias("filled"))


def mean_mixing(mixing: DataFrame) -> DataFrame:
    """Mean mixing matrix of the regions that converged; no row if none did."""
    m = mixing.where("converged").agg(F.avg(F.least("m00", "m01")).alias("a"), F.avg(F.least("m10", "m11")).alias("b")).where("a IS NOT NULL")
    return m.select((1 - F.col("a")).alias("m00"), F.col("a").alias("m01"), F.col("b").alias("m10"), (1 - F.col("b")).alias("m11"))


def crosstalk_outliers(pairs: DataFrame, most: float = 50.0) -> DataFrame:
    """Slope of crosstalk on signal per region, in per cent, and whether it is beyond ``most``."""
    slope = pairs.groupBy("roi").agg((100 * F.regr_slope("crosstalk", "signal")).alias("slope"))
    return slope.select("roi", "slope", (F.abs("slope") > most).alias("outlier"))


def histogram_2d(pairs: DataFrame, x: tuple[float, float], y: tuple[float, float], bins: int = 25) -> DataFrame:
    """Counts by the nearest of ``bins`` steps on both axes (halves to even), the last step closed; no rows with gaps."""
    step = lambda c, b: F.least(F.rint((F.col(c) - b[0]) / ((b[1] - b[0]) / bins)), F.lit(bins - 1.0)).cast("int")
    both = pairs.where(~(F.isnan("x") | F.isnan("y")))
    return both.groupBy(step("x", x).alias("bx"), step("y", y).alias("by")).agg(F.count("*").alias("n"))


def recording_figures(trace: DataFrame) -> DataFrame:
    """Mean, deviation and a seed drawn from the sum of sizes."""
    seed = F.pmod(F.rint(F.sum(F.abs("f"))).cast("long"), F.lit(2**32)).alias("seed")
    return trace.agg(F.avg("f").alias("mean"), F.stddev_pop("f").alias("deviation"), seed)


def running_ids(rois: DataFrame, offset: int) -> DataFrame:
    """Ids from ``offset`` on in order of experiment and position: counted per experiment, so no task gets all rows."""
    sizes = rois.groupBy("experiment").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("experiment")) - F.col("n")).drop("n")  # a row for each experiment
    place = F.row_number().over(Window.partitionBy("experiment").orderBy("position"))
    return rois.withColumn("place", place).join(before, "experiment").select("experiment", "position", (F.col("before") + F.col("place") - 1 + offset).alias("roi"))
