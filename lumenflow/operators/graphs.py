"""The pixel graph over packed pixels: one row per pixel with its whole series, so that edges join rows and not frames."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.operators.movies import NEIGHBOURS, TILE, extent, graph_image, packed, tiled

def _with(value: Column, f) -> Column:
    """f(value), with the value worked out once however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def correlation(x: Column, y: Column, used: Column | None = None) -> Column:
    """Pearson correlation of two arrays, at the places where ``used`` (an array of flags) holds; null without spread."""
    pairs = F.zip_with(x, y, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    if used is not None:
        pairs = F.filter(pairs, lambda _, i: F.get(used, i))
    mean = lambda ps, k: F.aggregate(ps, F.lit(0.0), lambda s, p: s + p[k]) / F.size(ps)
    zero = F.struct(*(F.lit(0.0).alias(k) for k in ("aa", "bb", "ab")))

    def spread(ps: Column, m: Column) -> Column:
        add = lambda s, p: F.struct(*((s[i + j] + (p[i] - m[i]) * (p[j] - m[j])).alias(i + j) for i, j in ("aa", "bb", "ab")))
        return F.aggregate(ps, zero, add, lambda s: s["ab"] / F.nullif(F.sqrt(s["aa"]) * F.sqrt(s["bb"]), F.lit(0.0)))

    return _with(pairs, lambda ps: _with(F.struct(mean(ps, "a").alias("a"), mean(ps, "b").alias("b")), lambda m: spread(ps, m)))


def edges(pixels: DataFrame) -> DataFrame:
    """r0, c0, x0, r1, c1, x1 of packed pixels that touch, each pair once."""
    steps = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in NEIGHBOURS])
    ends = pixels.select(F.col("r").alias("r0"), F.col("c").alias("c0"), F.col("x").alias("x0"), F.explode(steps).alias("s"))
    ends = ends.withColumn("r1", F.col("r0") + F.col("s.dr")).withColumn("c1", F.col("c0") + F.col("s.dc")).drop("s")
    return ends.join(pixels.select(F.col("r").alias("r1"), F.col("c").alias("c1"), F.col("x").alias("x1")), ["r1", "c1"])


def brightest(x: Column, share: float) -> Column:
    """Flags of the brightest share of an array's values; of equal ones the later count as brighter."""
    order = F.array_sort(F.transform(x, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    least = F.get(order, F.rint((1 - share) * F.size(x)).cast("int"))  # null if none is to be flagged
    return _with(least, lambda m: F.transform(x, lambda v, i: F.coalesce(F.struct(v.alias("v"), i.alias("i")) >= m, F.lit(False))))


def either(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: p | q)


def filtered_correlation(movie: DataFrame, share: float) -> DataFrame:
    """Pearson correlation of touching pixels over the frames that are among the brightest of either."""
    pixels = packed(movie).withColumn("x", F.struct("x", brightest(F.col("x"), share).alias("on")))
    value = correlation(F.col("x0.x"), F.col("x1.x"), either(F.col("x0.on"), F.col("x1.on")))
    return edges(pixels).select("r0", "c0", "r1", "c1", value.alias("filtered"))


def _quantile(x: Column, q: float) -> Column:
    """Interpolated quantile of an array."""
    at = (F.size(x) - 1) * F.lit(q)
    lo = F.floor(at).cast("int")
    return _with(F.array_sort(x), lambda order: F.get(order, lo) + (at - lo) * (F.get(order, F.ceil(at).cast("int")) - F.get(order, lo)))


_EDGE = pa.schema([*((k, pa.int32()) for k in ("r0", "c0", "r1", "c1")), ("far", pa.float64())])


def _units(x: np.ndarray) -> np.ndarray:
    """Rows centred and of length one, so that products are correlations; NaN without spread."""
    with np.errstate(all="ignore"):
        y = x - x.mean(axis=1, keepdims=True)
        y /= np.sqrt((y * y).sum(axis=1, keepdims=True))
    y[x.min(axis=1) == x.max(axis=1)] = np.nan
    return y


def _joint_gap(a: dict, b: dict, x: dict) -> float | None:
    """Correlation of a and x less that of b and x over the frames that all three have; each is t -> [(value, counts)]. A pair with a
    missing value is left out; None without pairs."""
    met = [(u, v, w) for t in sorted(a.keys() & b.keys() & x.keys()) for (u, p), (v, q), (w, _) in itertools.product(a[t], b[t], x[t]) if p or q]
    both = []
    for k in (0, 1):
        pairs = [(m[k], m[2]) for m in met if m[k] is not None and m[2] is not None]
        if not pairs:
            return None
        u = _units(np.array(pairs).T)
        both.append(u[0] @ u[1])
    return both[0] - both[1]


def hnc_gaussian(movie: DataFrame, radius: float, share: float | None = None) -> DataFrame:
    """exp(-d ** 2) of touching pixels, d the distance of their correlations with all pixels within ``radius`` of the
    edge's middle; with a share only frames in which either pixel is at or above its quantile. NaN if one of these pixels has no
    spread. Pixels are packed and meet in tiles, which grow with the radius, so that a series is sent to a few tiles at most."""
    reach = int(radius + 0.5)
    box = list(itertools.product(range(-reach, reach + 1), repeat=2))
    around = {s: [(dr, dc) for dr, dc in box if math.hypot(dr - s[0] / 2, dc - s[1] / 2) <= radius] for s in NEIGHBOURS}
    size, pad = max(TILE, 2 * reach), reach + 1

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        top, left = (size * k.as_py() for k in key)
        grid = np.full((size + 2 * pad, size + 2 * pad), -1)
        grid[rows["r"].to_numpy() - top + pad, rows["c"].to_numpy() - left + pad] = np.arange(len(rows))
        at = lambda dr, dc: grid[pad + dr : pad + dr + size, pad + dc : pad + dc + size].ravel()
        lists = rows["x"].chunk(0)
        values, n = lists.flatten(), lists.value_lengths().to_numpy()
        whole = values.null_count == 0 and n.min() == n.max()  # and all pixels have the same frames, each once
        if whole and rows["t"].null_count < len(rows):
            frames = rows["t"].chunk(0).flatten().to_numpy()
            whole = rows["t"].null_count == 0 and bool((frames.reshape(len(rows), -1) == frames[: n[0]]).all() and (np.diff(frames[: n[0]]) > 0).all())
        if whole:
            x = values.to_numpy().reshape(len(rows), -1)
            on = None if share is None else rows["on"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(x.shape)
            near = None if share is not None else (u := _units(x)) @ u.T
        else:  # t -> [(value, counts)] of each pixel
            pixels = []
            for k, own in enumerate(lists.to_pylist()):
                flags = [True] * len(own) if share is None else rows["on"][k].as_py()
                pixels.append({})
                for t, *v in zip(rows["t"][k].as_py() or range(len(own)), own, flags):
                    pixels[k].setdefault(t, []).append(v)
        out = [_EDGE.empty_table()]
        for step in (s for s in NEIGHBOURS if around[s]):
            a, b = at(0, 0), at(*step)
            edge = (a >= 0) & (b >= 0)
            a, b, others = a[edge], b[edge], np.stack([at(*s)[edge] for s in around[step]])
            if whole and share is None:
                gaps = np.where(others >= 0, near[a, others] - near[b, others], 0.0)
                far = (gaps * gaps).sum(axis=0).tolist()
            else:
                far = []
                for i, j, ks in zip(a, b, others.T):
                    if whole:
                        u = _units(x[np.ix_([i, j, *ks[ks >= 0]], on[i] | on[j])])
                        gaps = (u[0] - u[1]) @ u[2:].T
                    else:
                        gaps = np.array([g for k in ks[ks >= 0] if (g := _joint_gap(pixels[i], pixels[j], pixels[k])) is not None])
                    far.append(float(gaps @ gaps) if len(gaps) else None)
            if not whole:  # pixels that have no frame in common don't make an edge
                shared = [bool(pixels[i].keys() & pixels[j].keys()) for i, j in zip(a, b)]
                a, b, far = a[shared], b[shared], list(itertools.compress(far, shared))
            ends = [rows[c].to_numpy()[k] for k in (a, b) for c in "rc"]
            out.append(pa.table([*ends, pa.array(far, pa.float64())], schema=_EDGE))
        return pa.concat_tables(out)

    series = movie.where("r IS NOT NULL AND c IS NOT NULL").groupBy("r", "c").agg(F.sort_array(F.collect_list(F.struct("t", "v"))).alias("s"))
    frames = F.col("s.t").cast("array<bigint>")  # sent only where they aren't 0, 1, 2 ...
    gapless = frames == F.sequence(F.lit(0).cast("bigint"), F.size("s").cast("bigint") - 1)
    pixels = series.select(F.col("r").cast("int"), F.col("c").cast("int"), F.col("s.v").cast("array<double>").alias("x"), F.when(~gapless, frames).alias("t"))
    if share is not None:
        bright = lambda least: F.transform("x", lambda v: F.coalesce(v >= least, F.lit(False)))
        pixels = pixels.withColumn("on", _with(_quantile(F.col("x"), 1 - share), bright))
    steps = tuple({s for step in NEIGHBOURS for s in (step, *around[step])})
    met = tiled(pixels, steps, size).groupBy("tr", "tc").applyInArrow(run, "r0 int, c0 int, r1 int, c1 int, far double")
    kinds = dict(movie.dtypes)
    return met.select(*(F.col(k).cast(kinds[k[0]]) for k in ("r0", "c0", "r1", "c1")), F.exp(-F.col("far")).alias("hnc"))


def _blurred(image: DataFrame, along: str, across: str, sigma: float) -> DataFrame:
    """One direction of a Gaussian blur, cut at four deviations, the edge held."""
    reach = int(4 * sigma + 0.5)
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w / sum(weights)).alias("w")) for k, w in zip(range(-reach, reach + 1), weights)])
    size = F.max(along).over(Window.partitionBy(across))
    spread = image.withColumn("top", size).withColumn("s", F.explode(table))
    at = F.greatest(F.lit(0), F.least(F.col("top"), F.col(along) + F.col("s.k")))
    wanted = spread.select(F.col(along).alias("to"), at.alias(along), across, F.col("s.w").alias("w"))
    return wanted.join(image, [along, across]).groupBy(F.col("to").alias(along), across).agg(F.sum(F.col("w") * F.col("v")).alias("v"))


def normalized(graph: DataFrame, value: str, sigma: float) -> DataFrame:
    """Edges over the mean of both ends in a blurred image of the graph (a whole frame): r0, c0, r1, c1, normalized."""
    local = _blurred(_blurred(graph_image(graph, value), "r", "c", sigma), "c", "r", sigma)
    for end in "01":
        graph = graph.join(local.select(F.col("r").alias(f"r{end}"), F.col("c").alias(f"c{end}"), F.col("v").alias(f"v{end}")), [f"r{end}", f"c{end}"])
    return graph.select("r0", "c0", "r1", "c1", (F.col(value) / ((F.col("v0") + F.col("v1")) / 2)).alias("normalized"))


def merged(first: DataFrame, then: DataFrame, attributes: list[str]) -> DataFrame:
    """Union of two graphs; where both know an attribute the later one counts."""
    key = ["r0", "c0", "r1", "c1"]
    last = lambda a: F.coalesce(F.max(F.when(F.col("turn") == 1, F.col(a))), F.max(F.when(F.col("turn") == 0, F.col(a)))).alias(a)
    both = first.withColumn("turn", F.lit(0)).unionByName(then.withColumn("turn", F.lit(1)), allowMissingColumns=True)
    return both.groupBy(*key).agg(*(last(a) for a in attributes))


def neighbourhood(movie: DataFrame, row: float, column: float, radius: float) -> DataFrame:
    """Pixels within ``radius`` of a point of the frame."""
    reach = lambda x: F.sequence(F.lit(math.floor(x - radius)), F.lit(math.ceil(x + radius)))
    grid = extent(movie).select("rows", "columns", F.explode(reach(row)).alias("r")).select("*", F.explode(reach(column)).alias("c"))
    inside = F.col("r").between(0, F.col("rows") - 1) & F.col("c").between(0, F.col("columns") - 1)
    return grid.where(inside & (F.hypot(F.col("r") - row, F.col("c") - column) <= radius)).select("r", "c")


def dilated_pixels(pixels: DataFrame, buffer: int) -> DataFrame:
    """Pixels within ``buffer`` rows and columns of the given ones: what a finished region bars from seeding."""
    steps = F.sequence(F.lit(-buffer), F.lit(buffer))
    near = pixels.select("r", "c", F.explode(steps).alias("dr")).select("r", "c", "dr", F.explode(steps).alias("dc"))
    return near.select((F.col("r") + F.col("dr")).alias("r"), (F.col("c") + F.col("dc")).alias("c")).distinct()
