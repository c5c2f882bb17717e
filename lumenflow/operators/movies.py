"""Movies: projections, down-sampling, scaling, de-interleaving and the pixel graph."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.functions.scalars import to_range


#: Steps to the neighbours of a pixel, each pair once, and the side of a tile of pixels that meet in a task.
NEIGHBOURS, TILE = ((0, 1), (1, -1), (1, 0), (1, 1)), 8
#: Steps of a range, and values that are simply sorted, in looking for a quantile.
STEPS, FEW = 1024, 10_000


def extent(movie: DataFrame) -> DataFrame:
    """Height and width of the movie's frame: rows, columns. One row, so the broadcast is of fixed size."""
    return F.broadcast(movie.agg((F.max("r") + 1).alias("rows"), (F.max("c") + 1).alias("columns")))


def projection(movie: DataFrame) -> DataFrame:
    """Greatest and mean value of each pixel over time."""
    return movie.groupBy("r", "c").agg(F.max("v").alias("max_v"), F.avg("v").alias("avg_v"))


def downsample(movie: DataFrame, frames: int, keys: list[str]) -> DataFrame:
    """Runs of ``frames`` frames as one, the short tail kept: mean, greatest, first and last value."""
    at = F.struct("t", "v")
    binned = movie.groupBy(*keys, F.floor(F.col("t") / frames).cast("int").alias("t_out"))
    return binned.agg(F.avg("v").alias("average"), F.max("v").alias("maximum"), F.min(at)["v"].alias("first"), F.max(at)["v"].alias("last"))


def block_mean(movie: DataFrame, size: int) -> DataFrame:
    """Mean over blocks of pixels; a block beyond the frame's edge counts zeros there."""
    block = lambda c: F.floor(F.col(c) / size).cast("int")
    return movie.groupBy(block("r").alias("br"), block("c").alias("bc"), "t").agg((F.sum("v") / (size * size)).alias("v"))


def _values_at(df: DataFrame, column: str, ranks: list[int], lo: float, hi: float) -> dict[int, float]:
    """The finite values of these ranks (from 0). In each round the counts in steps of a range close in on every rank, all ranks in
    one pass, until few enough values are left to be sorted; no task or driver holds more than STEPS counts or FEW values of a rank."""
    value, found, few = F.col(column), {}, {}
    open_ = {k: (0, lo, hi) for k in ranks}
    while open_:
        ranges = sorted({(lo, hi) for _, lo, hi in open_.values()})

        def step(lo: float, hi: float) -> Column:
            # halves, so that the width of a range is a number
            share = (value * 0.5 - lo * 0.5) / (hi * 0.5 - lo * 0.5)
            return F.least(F.floor(share * STEPS), F.lit(STEPS - 1)) if lo < hi else F.lit(0)

        marks = [F.when(value.between(lo, hi), F.struct(F.lit(i).alias("i"), step(lo, hi).cast("int").alias("s"))) for i, (lo, hi) in enumerate(ranges)]
        held = df.select(value.alias("v"), F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())).alias("m"))
        counts = held.groupBy("m.i", "m.s").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        by_range: dict[int, list] = {}
        for i, s, n, low, high in sorted(counts, key=lambda x: x[:2]):
            by_range.setdefault(i, []).append((n, low, high))
        for rank, (below, lo, hi) in list(open_.items()):
            for n, low, high in by_range[ranges.index((lo, hi))]:
                if below + n > rank:
                    break
                below += n
            del open_[rank]
            if low == high:
                found[rank] = low
            elif n <= FEW:
                few[rank] = (below, low, high)
            else:
                open_[rank] = (below, low, high)
    if few:
        ranges = sorted({(lo, hi) for _, lo, hi in few.values()})
        marks = [F.when(value.between(lo, hi), F.lit(i)) for i, (lo, hi) in enumerate(ranges)]
        held = df.select(value.alias("v"), F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())).alias("i"))
        rows = {r["i"]: r["v"] for r in held.groupBy("i").agg(F.sort_array(F.collect_list("v")).alias("v")).collect()}
        found |= {rank: rows[ranges.index((lo, hi))][rank - below] for rank, (below, lo, hi) in few.items()}
    return found


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Exact quantiles of a column of any length, interpolated; None for a column without values. Null and NaN are no values;
    infinite ones are the first and last."""
    value = F.col(column)
    known = df.where(value.isNotNull() & ~F.isnan(value.cast("double")))
    finite = known.where(F.abs(value) < float("inf"))
    least, most = float("-inf"), float("inf")
    n, lower, upper = known.agg(F.count("*"), F.count_if(value == least), F.count_if(value == most)).first()
    if not n:
        return [None] * len(shares)
    places = [(n - 1) * share for share in shares]
    ranks = sorted({k for at in places for k in (int(at), min(int(at) + 1, n - 1))})
    inner = [k - lower for k in ranks if lower <= k < n - upper]
    values = {k: least if k < lower else most for k in ranks}
    if inner:
        lo, hi = finite.agg(F.min(value), F.max(value)).first()
        values |= {k + lower: float(v) for k, v in _values_at(finite.select(value.cast("double").alias(column)), column, inner, float(lo), float(hi)).items()}

    def between(at: float) -> float:
        a, b, part = values[int(at)], values[min(int(at) + 1, n - 1)], at - int(at)
        return a if not part or a == b else a + part * (b - a)

    return [between(at) for at in places]


def scaled(movie: DataFrame, lo: float, hi: float) -> DataFrame:
    """Values between two quantiles of the movie, as 0 to 255."""
    limits = [F.lit(q).cast("double") for q in quantiles(movie, "v", [lo, hi])]
    return movie.select("r", "c", "t", to_range(F.col("v"), *limits).cast("int").alias("v"))


def deinterleave(pages: DataFrame, planes: int) -> DataFrame:
    """Pages taken in turn from the planes: plane and frame of each page."""
    return pages.withColumn("plane", (F.col("page") % planes).cast("int")).withColumn("frame", F.floor(F.col("page") / planes).cast("long"))


def packed(movie: DataFrame) -> DataFrame:
    """r, c, x: each pixel's values in order of frame."""
    series = F.transform(F.sort_array(F.collect_list(F.struct("t", "v"))), lambda s: s["v"])
    return movie.groupBy("r", "c").agg(series.alias("x"))


def tiled(pixels: DataFrame, steps: tuple[tuple[int, int], ...], size: int = TILE) -> DataFrame:
    """Packed pixels with the tiles (tr, tc) of ``size`` pixels that need them: their own, and those of pixels that a step leads from."""
    tile = lambda dr, dc: F.struct(F.floor((F.col("r") - dr) / size).cast("int").alias("tr"), F.floor((F.col("c") - dc) / size).cast("int").alias("tc"))
    return pixels.select("*", F.inline(F.array_distinct(F.array(*(tile(*s) for s in ((0, 0), *steps))))))


def neighbour_correlation(movie: DataFrame) -> DataFrame:
    """Pearson correlation over time of pixels that touch, each pair once: r0, c0, r1, c1, pearson. Null without spread, with a
    missing value, or where two pixels differ in their number of frames. Pixels are packed and meet in tiles, so that only those at
    a tile's edge are sent twice."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        at = {p: i for i, p in enumerate(zip(rows["r"].tolist(), rows["c"].tolist()))}
        first = [p for p in at if (p[0] // TILE, p[1] // TILE) == key]
        pairs = [(p, q) for p in first for q in ((p[0] + dr, p[1] + dc) for dr, dc in NEIGHBOURS) if q in at]
        series = [np.asarray(x, float) for x in rows["x"]]
        unit = []
        for x in series:
            x = x - x.mean() if len(x) else x
            size = np.sqrt(x @ x)
            unit.append(x / size if size > 0 else np.full(len(x), np.nan))
        out = [float(unit[at[p]] @ unit[at[q]]) if len(unit[at[p]]) == len(unit[at[q]]) else np.nan for p, q in pairs]
        return pd.DataFrame([(*p, *q, None if np.isnan(v) else v) for (p, q), v in zip(pairs, out)], columns=["r0", "c0", "r1", "c1", "pearson"])

    return tiled(packed(movie), NEIGHBOURS).groupBy("tr", "tc").applyInPandas(run, "r0 int, c0 int, r1 int, c1 int, pearson double")


def graph_image(edges: DataFrame, value: str) -> DataFrame:
    """Mean of a pixel's edges."""
    ends = edges.select(F.col("r0").alias("r"), F.col("c0").alias("c"), value).unionAll(edges.select(F.col("r1").alias("r"), F.col("c1").alias("c"), value))
    return ends.groupBy("r", "c").agg(F.avg(value).alias("v"))


def seeds(image: DataFrame, block: int, keep: float) -> DataFrame:
    """The brightest pixel of each block (first in reading order), brightest first; the rest of the share is excluded."""
    place = lambda c: F.floor(F.col(c) / block).cast("int")
    top = image.groupBy(place("r").alias("br"), place("c").alias("bc")).agg(F.max(F.struct("v", (-F.col("r")).alias("nr"), (-F.col("c")).alias("nc"))).alias("m"))
    tops = top.select((-F.col("m.nr")).alias("r"), (-F.col("m.nc")).alias("c"), F.col("m.v").alias("v"))
    n = tops.agg(F.count("*").alias("n"))
    # one candidate for each block of the frame, so this order is small
    ranked = tops.withColumn("k", F.row_number().over(Window.orderBy(F.desc("v"), "r", "c"))).join(F.broadcast(n))
    return ranked.select("r", "c", "v", F.when(F.col("k") <= F.floor(keep * F.col("n")), F.lit("kept")).otherwise(F.lit("excluded by fraction")).alias("status"))


def bright_frames(movie: DataFrame, share: float) -> DataFrame:
    """The brightest share of each pixel's frames."""
    n = F.count("*").over(Window.partitionBy("r", "c"))
    k = F.row_number().over(Window.partitionBy("r", "c").orderBy(F.desc("v"), "t"))
    return movie.withColumn("n", n).withColumn("k", k).where(F.col("k") <= F.floor(share * F.col("n"))).select("r", "c", "t")


def bright_frames_of_pairs(movie: DataFrame, pairs: DataFrame, share: float) -> DataFrame:
    """r0, c0, r1, c1, t: frames that are among the brightest of either pixel of a pair."""
    bright, key = bright_frames(movie, share), ["r0", "c0", "r1", "c1"]
    sides = [pairs.join(bright, (F.col(f"r{e}") == F.col("r")) & (F.col(f"c{e}") == F.col("c"))).select(*key, "t") for e in "01"]
    return sides[0].union(sides[1]).distinct()
