"""Rigid registration: a reference image made step by step, each frame's shift against it, and the pixels moved.

A frame is one row of packed pixels, so transforms run over Arrow batches of frames. The reference comes from a bounded number
of frames; each step finds their shifts in tasks and adds up the best ones there, in pieces of ``PIECE`` pixels that are then
summed over tasks. Only one image and a shift for each of those frames reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.functions import phase
from lumenflow.operators import images, selection, signals
from lumenflow.operators.movies import extent
from lumenflow.operators.traces import if_small
from lumenflow.sources.scratch import written

#: Pixels of an image that are summed together, frames of one Arrow batch, and frames whose correlations are smoothed together.
PIECE, FRAMES_AT_ONCE, RUN = 4096, 16, 64
_FRAME = "t long, rows int, columns int, pixels binary"
_SHIFT = "t long, dy int, dx int, score double"
#: Ranks of a frame's correlations with others that count for the first reference, and frames averaged into it.
_LIKE = 20


@dataclass(frozen=True)
class Settings:
    """``most``: the greatest shift as a share of the shorter side; deviations of the smoothing of correlations in space and, in
    frames, in time; steps of the reference, and the number of frames that it is made from."""

    most: float = 0.2
    sigma: float = 1.15
    sigma_time: float = 0.0
    steps: int = 8
    frames: int = 500


def packed_frames(movie: DataFrame) -> DataFrame:
    """t, rows, columns, pixels: one row for each frame, its pixels in reading order as doubles. Missing, null and NaN pixels are 0."""
    cells = movie.join(extent(movie)).groupBy("t", "rows", "columns").agg(F.collect_list(F.struct((F.col("r") * F.col("columns") + F.col("c")).cast("int").alias("at"), F.col("v").cast("double").alias("v"))).alias("cells"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                cell = batch.column("cells").slice(i, 1).flatten()
                rows, columns = batch.column("rows")[i].as_py(), batch.column("columns")[i].as_py()
                image = np.zeros(rows * columns)
                image[cell.field("at").to_numpy()] = np.nan_to_num(cell.field("v").to_numpy(zero_copy_only=False).astype(float), nan=0.0)
                yield pa.RecordBatch.from_pydict({"t": [batch.column("t")[i].as_py()], "rows": pa.array([rows], pa.int32()), "columns": pa.array([columns], pa.int32()), "pixels": [image.tobytes()]})

    return cells.select(F.col("t").cast("long").alias("t"), F.col("rows").cast("int").alias("rows"), F.col("columns").cast("int").alias("columns"), "cells").mapInArrow(run, _FRAME)


def _stacks(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Frame numbers and frames of Arrow batches, some frames at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, FRAMES_AT_ONCE):
            part = batch.slice(lo, FRAMES_AT_ONCE)
            if part.num_rows:
                shape = (-1, part.column("rows")[0].as_py(), part.column("columns")[0].as_py())
                yield part.column("t").to_numpy(), np.concatenate([np.frombuffer(p.as_py()) for p in part.column("pixels")]).reshape(shape)


def find_shifts(frames: DataFrame, image: np.ndarray, settings: Settings) -> DataFrame:
    """t, dy, dx, score of packed frames against an image. With smoothing in time a frame's correlations are averaged with those of
    the frames around it, mirrored at the ends of the movie; runs of frames overlap for that, so the result doesn't depend on them."""
    reference = phase.Reference(np.asarray(image, float), settings.sigma, settings.most)

    def columns(t, dy, dx, score):
        return pa.RecordBatch.from_pydict({"t": pa.array(t, pa.int64()), "dy": pa.array(dy, pa.int32()), "dx": pa.array(dx, pa.int32()), "score": pa.array(score, pa.float64())})

    def alone(batches):
        for t, stack in _stacks(batches):
            yield columns(t, *reference.shifts(reference.maps(stack)))

    if settings.sigma_time <= 0:
        return frames.mapInArrow(alone, _SHIFT)

    weights = phase.gaussian_weights(settings.sigma_time)
    half, side = len(weights) // 2, 2 * reference.reach + 1

    def maps(batches):
        for t, stack in _stacks(batches):
            yield pa.RecordBatch.from_pydict({"t": pa.array(t, pa.int64()), "map": [m.tobytes() for m in reference.maps(stack)]})

    def smooth(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        n, first, k = int(rows["n"].iloc[0]), int(rows["k"].iloc[0]), rows["k"].to_numpy()
        held = np.frombuffer(b"".join(rows["map"])).reshape(-1, side, side)
        own = np.flatnonzero(k // RUN == key[0])
        mirror = lambda i: i % (2 * n) if i % (2 * n) < n else 2 * n - 1 - i % (2 * n)
        mean = np.array([sum(w * held[mirror(int(k[i]) + j - half) - first] for j, w in enumerate(weights)) for i in own]).reshape(-1, side, side)
        dy, dx, score = reference.shifts(mean)
        return pd.DataFrame({"t": rows["t"].to_numpy()[own], "dy": dy, "dx": dx, "score": score})

    # only frame numbers pass this order, whose runs a task each has
    at = frames.select("t").withColumn("k", F.row_number().over(Window.orderBy("t")) - 1).withColumn("n", F.count("*").over(Window.partitionBy()))
    # a mirrored place is within the reach of the end, so the runs at both ends hold what they need
    runs = F.sequence(F.floor(F.greatest(F.col("k") - half, F.lit(0)) / RUN), F.floor(F.least(F.col("k") + half, F.col("n") - 1) / RUN))
    spread = frames.mapInArrow(maps, "t long, map binary").join(if_small(at), "t").withColumn("run", F.explode(runs))
    return spread.groupBy("run").applyInPandas(smooth, _SHIFT)


def _sum_pieces(parts: DataFrame) -> DataFrame:
    """piece, total, count: sums of arrays over tasks, piece by piece."""

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total, count = (np.sum([np.frombuffer(x) for x in rows[c]], axis=0) for c in ("total", "count"))
        return pd.DataFrame({"piece": [key[0]], "total": [total.tobytes()], "count": [count.tobytes()]})

    return parts.groupBy("piece").applyInPandas(add, "piece int, total binary, count binary")


def mean_image(frames: DataFrame, shape: tuple[int, int], shifts: dict[int, tuple[int, int]] | None = None, pad: tuple[int, int] = (0, 0)) -> np.ndarray:
    """The mean of packed frames, of those in ``shifts`` moved by them, on a canvas that is larger by ``pad`` on each side. Where no
    frame lies it is NaN."""
    rows, columns = shape
    tall, wide = rows + 2 * pad[0], columns + 2 * pad[1]

    def run(batches):
        total, count = np.zeros((tall, wide)), np.zeros((tall, wide))
        for t, stack in _stacks(batches):
            for k, frame in zip(t.tolist(), stack):
                dy, dx = (0, 0) if shifts is None else shifts.get(k, (None, None))
                if dy is None:
                    continue
                r, c = pad[0] - dy, pad[1] - dx
                # a shift beyond the pad loses its edge
                r0, c0, r1, c1 = max(r, 0), max(c, 0), min(r + rows, tall), min(c + columns, wide)
                total[r0:r1, c0:c1] += frame[r0 - r : r1 - r, c0 - c : c1 - c]
                count[r0:r1, c0:c1] += 1
        if count.any():
            cut = range(PIECE, tall * wide, PIECE)
            pieces = [[x.tobytes() for x in np.split(a.ravel(), cut)] for a in (total, count)]
            yield pa.RecordBatch.from_pydict({"piece": pa.array(range(len(pieces[0])), pa.int32()), "total": pieces[0], "count": pieces[1]})

    found = _sum_pieces(frames.mapInArrow(run, "piece int, total binary, count binary")).orderBy("piece").collect()  # one image
    if not found:
        return np.full((tall, wide), np.nan)
    total, count = (np.concatenate([np.frombuffer(p[c]) for p in found]).reshape(tall, wide) for c in ("total", "count"))
    return np.divide(total, count, out=np.full((tall, wide), np.nan), where=count > 0)


def likest_frames(frames: DataFrame, n: int) -> list[int]:
    """The frame whose ``_LIKE`` best correlations with others are highest, and the frames behind them. The matrix of products of
    ``n`` frames is added up over pieces of pixels; n is bounded by the settings."""

    def cut(batches):
        for t, stack in _stacks(batches):
            flat = stack.reshape(len(stack), -1)
            flat = flat - flat.mean(axis=1, keepdims=True)
            for k, x in zip(t.tolist(), flat):
                pieces = [p.tobytes() for p in np.split(x, range(PIECE, len(x), PIECE))]
                yield pa.RecordBatch.from_pydict({"piece": pa.array(range(len(pieces)), pa.int32()), "t": pa.array([k] * len(pieces), pa.int64()), "x": pieces})

    def products(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("t")
        x = np.array([np.frombuffer(b) for b in rows["x"]])
        return pd.DataFrame({"t": rows["t"].to_numpy(), "products": [p.tobytes() for p in x @ x.T]})

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"t": [key[0]], "products": [np.sum([np.frombuffer(b) for b in rows["products"]], axis=0).tobytes()]})

    whole = frames.mapInArrow(cut, "piece int, t long, x binary").groupBy("piece").applyInPandas(products, "t long, products binary").groupBy("t").applyInPandas(add, "t long, products binary")
    rows = whole.orderBy("t").collect()  # n by n numbers, n being bounded
    gram = np.array([np.frombuffer(r["products"]) for r in rows])
    size = np.sqrt(np.diag(gram))
    with np.errstate(invalid="ignore", divide="ignore"):
        like = np.nan_to_num(gram / np.outer(size, size))
    score = np.sort(like, axis=1)[:, ::-1][:, 1:_LIKE].mean(axis=1) if len(like) > 1 else np.zeros(len(like))
    best = int(score.argmax())
    return [rows[i]["t"] for i in np.argsort(-like[best], kind="stable")[:_LIKE]]


def usual_packed(frames: DataFrame) -> DataFrame:
    """Packed frames whose mean isn't extreme."""

    def means(batches):
        for t, stack in _stacks(batches):
            yield pa.RecordBatch.from_pydict({"t": pa.array(t, pa.int64()), "m": stack.mean(axis=(1, 2))})

    return frames.join(selection.clipped_means(frames.mapInArrow(means, "t long, m double")).select("t"), "t", "left_semi")


def reference_image(movie: DataFrame, settings: Settings) -> np.ndarray:
    """The image that a movie's frames are held against. The first is the mean of frames that are much alike; in each step the best
    correlated ones of the frames it is made from, more in every step and half of them in the last, are moved and averaged, and
    their mean shift is taken out. What no frame covers has the image's mean."""
    chosen = signals.spaced_frames(movie, settings.frames)
    frames = written(packed_frames(chosen))
    frames = written(usual_packed(frames))
    one = frames.select("rows", "columns").first()
    if one is None:
        raise ValueError("a movie without frames has no reference")
    shape = (one["rows"], one["columns"])
    n = frames.count()
    image = mean_image(frames, shape, dict.fromkeys(likest_frames(frames, n), (0, 0)))
    pad = tuple(math.ceil(settings.most * s) for s in shape)
    for step in range(settings.steps):
        most = max(1, int(n * (1 + step) / (2 * settings.steps)))
        best = find_shifts(frames, image, settings).orderBy(F.desc("score"), "t").limit(most).collect()  # bounded by settings.frames
        canvas = mean_image(frames, shape, {r["t"]: (r["dy"], r["dx"]) for r in best}, pad)
        bulk = [round(float(np.mean([r[c] for r in best]))) for c in ("dy", "dx")]
        canvas = np.roll(canvas, bulk, (0, 1))
        image = canvas[pad[0] : pad[0] + shape[0], pad[1] : pad[1] + shape[1]]
        image = np.where(np.isnan(image), np.nanmean(image), image)
    return image


def register(movie: DataFrame, settings: Settings = Settings(), image: np.ndarray | None = None) -> DataFrame:
    """t, dy, dx, score: by how much each frame of a movie lies below and to the right of the reference."""
    reference = reference_image(movie, settings) if image is None else image
    return find_shifts(packed_frames(movie), reference, settings)


def moved(movie: DataFrame, shifts: DataFrame) -> DataFrame:
    """The movie's rows with each frame moved back by its shift; what leaves on one side comes in on the other, so no value is lost.
    Frames without a shift stay."""
    placed = movie.join(if_small(shifts.select(F.col("t"), "dy", "dx")), "t", "left").join(extent(movie))
    back = lambda c, by, size: F.pmod(F.col(c) - F.coalesce(by, F.lit(0)), size).cast("int").alias(c)
    return placed.select(back("r", "dy", F.col("rows")), back("c", "dx", F.col("columns")), "t", "v")


def registered_average(movie: DataFrame, shifts: DataFrame) -> DataFrame:
    """r, c, v: the mean of the moved frames."""
    return moved(movie, shifts).groupBy("r", "c").agg(F.avg("v").alias("v"))


def sharpest(movie: DataFrame, grid: list[Settings]) -> tuple[Settings, float]:
    """The settings under which the average of the registered frames is sharpest inside the border that the shifts leave."""
    best: tuple[Settings, float] | None = None
    for settings in grid:
        shifts = written(register(movie, settings))
        edge = shifts.agg(*(F.abs(f(F.lit(0), g(c))).alias(n) for n, f, g, c in (("top", F.least, F.min, "dy"), ("bottom", F.greatest, F.max, "dy"), ("left", F.least, F.min, "dx"), ("right", F.greatest, F.max, "dx")))).first()
        inside = (F.col("r") >= edge["top"]) & (F.col("r") < F.col("rows") - edge["bottom"]) & (F.col("c") >= edge["left"]) & (F.col("c") < F.col("columns") - edge["right"])
        image = registered_average(movie, shifts).join(extent(movie)).where(inside).select("r", "c", "v")
        value = images.acutance(image).first()["acutance"] or 0.0
        if best is None or value > best[1]:
            best = (settings, value)
    if best is None:
        raise ValueError("no settings to choose from")
    return best
