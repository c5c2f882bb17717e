"""Rules that compare recordings, planes and regions, gap-tolerant medians, and demixing of shared pixels."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.functions import kernels
from lumenflow.operators import rois, sliding, traces

#: Frames whose systems one call solves.
SOLVED_TOGETHER = 64


def in_field(pixels: DataFrame, row: int, column: int, rows: int, columns: int) -> DataFrame:
    """Regions whose box meets a field of view; a box that touches its low side is kept."""
    box = rois.bounds(pixels)
    out = (F.col("y") + F.col("height") < row) | (F.col("y") >= row + rows) | (F.col("x") + F.col("width") < column) | (F.col("x") >= column + columns)
    return box.where(~out).select("roi")


def valid_traces(channels: DataFrame) -> DataFrame:
    """roi, valid: all channels (roi, channel, t, f) are of one length and without gaps."""
    gap = F.col("f").isNull() | F.isnan("f")
    each = channels.groupBy("roi", "channel").agg(F.count("*").alias("n"), F.count_if(gap).alias("gaps"))
    return each.groupBy("roi").agg(((F.min("n") == F.max("n")) & (F.max("gaps") == 0)).alias("valid"))


def moved_frames(corrected: DataFrame, raw: DataFrame) -> DataFrame:
    """Frames whose values differ from the raw ones as multisets; a frame of one side only differs."""
    count = lambda df, sign: df.select("t", "v", F.lit(sign).alias("s"))
    both = count(corrected, 1).unionAll(count(raw, -1)).groupBy("t", "v").agg(F.sum("s").alias("s"))
    return both.where("s <> 0").select("t").distinct()


def ghosts(signal: DataFrame, crosstalk: DataFrame, window: int = 2) -> DataFrame:
    """Regions with events, the number of independent ones, and whether there are none."""
    own = traces.independent_events(signal, crosstalk, window).groupBy("roi").agg(F.count("*").alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return signal.select("roi").distinct().join(own, "roi", "left").select("roi", n.alias("n_independent"), (n == 0).alias("ghost"))


def channel_correlation(pairs: DataFrame) -> DataFrame:
    """Correlation of both inputs with both outputs, per region."""
    return pairs.groupBy("roi").agg(*(F.corr(f"in{i}", f"out{j}").alias(f"c{i}{j}") for i in (0, 1) for j in (0, 1)))


def gap_median(trace: DataFrame, size: int) -> DataFrame:
    """Median of the known values in each odd window, edges mirrored; where a window has none, a line
    between the medians around, and at the ends the nearest one. A trace without values stays null."""

    def rule(table: pa.Table, starts: np.ndarray) -> pa.Table:
        parts = [kernels.known_median_filter(x, size) for x in np.split(sliding.values(table), starts[1:])]
        return sliding.with_columns(table, m=np.concatenate(parts))

    kinds = dict(trace.dtypes)
    return sliding.through_regions(trace, rule, f"roi {kinds['roi']}, t {kinds['t']}, m double")


def _solve(t: int, rows: pd.DataFrame) -> pd.DataFrame:
    own = rows[rows["a"] == rows["b"]].sort_values("a")
    ids, signal, pixels, copies = own["a"].to_numpy(), own["f"].to_numpy(), own["n"].to_numpy(), own["copies"].to_numpy()
    empty = bool((signal == 0).any())
    out = np.zeros(len(ids))
    if not empty:
        shared = np.zeros((len(ids), len(ids)))
        i, j = np.searchsorted(ids, rows["a"]), np.searchsorted(ids, rows["b"])
        shared[i, j] = rows["s"] / signal[j]
        # copies get equal traces in the least solution; scaled by the root of their number, the system has the singular values of
        # that of all regions, whose number sets the bound below which they count as zero
        root = np.sqrt(copies)
        out = np.linalg.lstsq(root[:, None] * shared * root, root * signal * pixels, rcond=np.finfo(float).eps * copies.sum())[0] / root
    return pd.DataFrame({"mask": ids, "t": t, "f": out, "dropped": empty})


def _solve_frames(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.concat([_solve(t, frame) for t, frame in rows.groupby("t")])


def demix(movie: DataFrame, pixels: DataFrame) -> DataFrame:
    """Shares the signal of overlapping regions: roi, t, f, dropped.

    For each frame the light that two regions have in common, over the later one's mean, times the
    unknown traces gives the summed signal; a singular system is solved by least squares. A frame in
    which a region has no signal is dropped: zeros for all. Regions of the same pixels are one unknown, with
    the weight of their number. Light is summed in Spark per pair of masks that shares pixels; a task gets
    ``SOLVED_TOGETHER`` frames and solves one at a time, its system as large as the number of masks.
    """
    members, shapes = rois.same_masks(pixels.select("roi", "r", "c").distinct())
    pairs = shapes.select(F.col("mask").alias("a"), "r", "c").join(shapes.select(F.col("mask").alias("b"), "r", "c"), ["r", "c"])
    light = movie.join(traces.if_small(pairs), ["r", "c"]).groupBy("t", "a", "b").agg(F.sum("v").alias("s"), F.avg("v").alias("f"), F.count("*").alias("n"))
    light = light.join(members.groupBy(F.col("mask").alias("a")).agg(F.count("*").alias("copies")), "a")
    kinds = dict(members.dtypes)
    solved = light.groupBy(F.floor(F.col("t") / SOLVED_TOGETHER)).applyInPandas(_solve_frames, f"mask {kinds['mask']}, t int, f double, dropped boolean")
    return solved.join(traces.if_small(members), "mask").select(F.col("roi").cast("int").alias("roi"), "t", "f", "dropped")
