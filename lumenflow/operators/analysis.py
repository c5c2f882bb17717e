"""From raw traces to dF/F, neuropil-corrected traces, active frames and events.

What needs a whole trace at once (sliding medians, mode, fits, deconvolution) runs in tasks grouped by region: a
trace is one recording's frames of one region, so a group is bounded by the length of a recording. The rest are windows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.functions import kernels
from lumenflow.operators import sliding
from lumenflow.operators.traces import event_summary


def _by_region(df: DataFrame, rule, schema: str) -> DataFrame:
    """``rule`` takes a region's rows in order of frame and gives columns."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"roi": key[0], **rule(rows.sort_values("t"))})

    return df.groupBy("roi").applyInPandas(run, f"roi long, {schema}")


def _long(trace: DataFrame) -> DataFrame:
    return trace.select(F.col("roi").cast("long").alias("roi"), F.col("t").cast("long").alias("t"), "f")


def dff(trace: DataFrame, short: int, long: int, percentile: float = 10) -> DataFrame:
    """roi, t, dff, and for the whole region sigma_dff and n_small_baseline. A trace without values passes through."""

    def rule(table: pa.Table, starts: np.ndarray) -> pa.Table:
        parts = [kernels.dff(x, short, long, percentile) for x in np.split(sliding.values(table), starts[1:])]
        sizes = np.diff(np.append(starts, table.num_rows))
        out = pa.table({"roi": table.column("roi").cast(pa.int64()), "t": table.column("t").cast(pa.int64()), "dff": pa.array(np.concatenate([p[0] for p in parts]), from_pandas=True)})
        return out.append_column("sigma_dff", pa.array(np.repeat([p[1] for p in parts], sizes), from_pandas=True)).append_column("n_small_baseline", pa.array(np.repeat([p[2] for p in parts], sizes)))

    return sliding.through_regions(trace, rule, "roi long, t long, dff double, sigma_dff double, n_small_baseline long")


def neuropil_fit(pairs: DataFrame, folds: int = 4, weight: float = 0.05) -> DataFrame:
    """roi, r, error of each region's signal and neuropil (roi, t, f, np); a negative share counts as 0, and regions
    with gaps have none."""

    def rule(rows):
        f, n = rows["f"].to_numpy(float), rows["np"].to_numpy(float)
        r, error = kernels.contamination_ratio(f, n, folds, weight) if np.isfinite(f).all() and np.isfinite(n).all() else (np.nan, np.nan)
        return {"r": [max(r, 0.0)] if r == r else [None], "error": [error if r == r else None]}

    return _by_region(pairs, rule, "r double, error double")


def refilled(fit: DataFrame, highest: float = 1.0, default: float = 0.7, least: int = 5) -> DataFrame:
    """Shares above ``highest`` become the mean of the positive others, or ``default`` if these are few."""
    good = (F.col("r") <= highest) & (F.col("r") > 0)
    mean = fit.agg(F.when(F.count_if(good) >= least, F.avg(F.when(good, F.col("r")))).otherwise(default).alias("fill"))
    return fit.join(F.broadcast(mean)).withColumn("r", F.when(F.col("r") > highest, F.col("fill")).otherwise(F.col("r"))).drop("fill")


def neuropil_corrected(pairs: DataFrame, folds: int = 4, weight: float = 0.05) -> DataFrame:
    """roi, t, r, fc: the signal less its share of neuropil, for regions whose corrected mean is positive."""
    fit = refilled(neuropil_fit(pairs, folds, weight)).where("r is not null")
    out = pairs.join(fit, "roi").select("roi", "t", "r", (F.col("f") - F.col("r") * F.col("np")).alias("fc"))
    return out.withColumn("mean", F.avg("fc").over(Window.partitionBy("roi"))).where("mean > 0").drop("mean")


def detect_events(trace: DataFrame, gamma: float, multiplier: float, noise_size: int = 31, trace_size: int = 101) -> DataFrame:
    """roi, t, event, penalty: sizes of the events, at least ``multiplier`` noise deviations each where possible.
    The trace is first freed of its slow median, which is clipped at 2.5 deviations."""

    def rule(rows):
        x = rows["f"].to_numpy(float)
        sigma = kernels.noise_std(x, noise_size)
        x = x - np.minimum(kernels.median_filter(x, trace_size), 2.5 * sigma)
        sizes, penalty = kernels.events(x, gamma, multiplier * sigma)
        return {"t": rows["t"].to_numpy(), "event": sizes, "penalty": penalty}

    return _by_region(trace, rule, "t long, event double, penalty double")


def events_file(events: DataFrame) -> DataFrame:
    """roi, n_events and least event of each region."""
    return event_summary(events.withColumnRenamed("event", "f"))


def modes(trace: DataFrame) -> DataFrame:
    """roi and the half-sample mode of its values."""
    return _by_region(trace, lambda rows: {"mode": [kernels.half_sample_mode(rows["f"].to_numpy(float))]}, "mode double")


def active_frames(trace: DataFrame, threshold: float = 14.0, frames: int = 5) -> DataFrame:
    """roi, t, active: the last ``frames`` frames together are too high for chance."""

    def rule(table: pa.Table, starts: np.ndarray) -> pa.Table:
        sums = np.concatenate([kernels.activity(x, frames) for x in np.split(sliding.values(table), starts[1:])])
        return pa.table({"roi": table.column("roi"), "t": table.column("t"), "active": -sums >= threshold})

    return sliding.through_regions(_long(trace), rule, "roi long, t long, active boolean")


def masked_rolling(trace: DataFrame, size: int, used: Column | None = None) -> DataFrame:
    """trace with mean and deviation (n - 1) of the used frames around each. Frames near an end take the nearest whole
    window, and a trace shorter than one is a single window."""
    used = F.lit(True) if used is None else used
    half = size // 2
    order = Window.partitionBy("roi").orderBy("t")
    whole = Window.partitionBy("roi")
    value = F.when(used, F.col("f"))
    around = order.rowsBetween(-half, size - half - 1)
    own = trace.withColumn("k", F.row_number().over(order) - 1).withColumn("n", F.count("*").over(whole))
    short = F.col("n") <= size
    stats = F.struct(F.when(short, F.avg(value).over(whole)).otherwise(F.avg(value).over(around)).alias("mean"), F.when(short, F.stddev_samp(value).over(whole)).otherwise(F.stddev_samp(value).over(around)).alias("sd"))
    inside = (F.col("k") >= half) & (F.col("k") + (size - half) <= F.col("n"))
    rolled = own.withColumn("s", stats).withColumn("inner", F.when(inside | short, F.col("s")))
    # the first and last whole windows serve the frames before and after them
    first = F.first("inner", True).over(order.rowsBetween(0, Window.unboundedFollowing))
    last = F.last("inner", True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    picked = rolled.withColumn("p", F.coalesce("inner", first, last))
    return picked.select(*trace.columns, F.col("p.mean").alias("mean"), F.col("p.sd").alias("sd"))


def clip_negative(trace: DataFrame, active: DataFrame, size: int = 1980, sigmas: float = 2.0) -> DataFrame:
    """roi, t, f, none lower than the rolling mean of inactive frames less ``sigmas`` deviations. A region that is always
    active has no inactive frames to go by, so all count; traces with gaps pass through."""
    flagged = trace.join(active.where("active").select("roi", "t", F.lit(True).alias("hot")), ["roi", "t"], "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    whole = Window.partitionBy("roi")
    flagged = flagged.withColumn("all_hot", F.min(F.col("hot").cast("int")).over(whole) == 1).withColumn("gap", F.max((F.col("f").isNull() | F.isnan("f")).cast("int")).over(whole) == 1)
    rolled = masked_rolling(flagged, size, ~F.col("hot") | F.col("all_hot"))
    least = F.coalesce(F.nanvl(F.col("mean") - sigmas * F.col("sd"), F.lit(None).cast("double")), F.lit(-999.0))
    return rolled.select("roi", "t", F.when(F.col("gap"), F.col("f")).otherwise(F.greatest("f", least)).alias("f"))


def most_active_section(pairs: DataFrame, length: int, ignore: int = 0) -> DataFrame:
    """roi, start, end: ``length`` frames around the highest rise above the median of the stronger of two traces
    (roi, t, a, b), kept inside the recording."""
    late = pairs.where(F.col("t") >= ignore)
    middle = late.groupBy("roi").agg(F.percentile("a", F.lit(0.5)).alias("ma"), F.percentile("b", F.lit(0.5)).alias("mb"), F.max("t").alias("last"))
    rise = late.join(middle, "roi").withColumn("ra", F.col("a") - F.col("ma")).withColumn("rb", F.col("b") - F.col("mb"))
    peak = rise.groupBy("roi").agg(F.max(F.struct("ra", -F.col("t"))).alias("pa"), F.max(F.struct("rb", -F.col("t"))).alias("pb"), F.first("last").alias("last"))
    at = F.when(F.col("pa.ra") >= F.col("pb.rb"), -F.col("pa.col2")).otherwise(-F.col("pb.col2"))
    start = F.greatest(F.lit(ignore), F.least(at - length // 2, F.col("last") + 1 - length))
    return peak.select("roi", start.cast("long").alias("start"), F.least(start + length, F.col("last") + 1).cast("long").alias("end"))
