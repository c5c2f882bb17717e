"""Denoising a movie by its strongest principal components.

Pixels are the features and frames the samples; what is kept of a pixel's series is its part in the space of the strongest time
courses. These are found by passes over the packed pixels: each adds up, in tasks and in pieces of frames, the products of all
pixels with a few time courses, and the driver makes the next few from the sums. It holds ``HELD`` times as many courses as are
asked for, each as long as the recording; no task or driver holds the movie or a matrix of frames by frames.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.operators.graphs import packed
from lumenflow.sources.scratch import written

#: Courses looked at beyond those asked for, the most held in terms of these, and frames of a piece of the sums.
SPARE, HELD, PIECE = 8, 6, 8192
#: Residual of a component, in terms of the strongest, at which it counts as found, and passes over the pixels at most.
CLOSE, PASSES = 1e-10, 200
#: Packed pixels of a block.
PIXELS_AT_ONCE = 256


def _blocks(batches):
    """Packed pixels as matrices without their means: batch slice, means, centred values."""
    for batch in batches:
        for lo in range(0, batch.num_rows, PIXELS_AT_ONCE):
            part = batch.slice(lo, PIXELS_AT_ONCE)
            if part.num_rows:
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                mean = x.mean(axis=1, keepdims=True)
                yield part, mean, x - mean


def _products(pixels: DataFrame, courses: np.ndarray) -> np.ndarray:
    """The sum over all pixels of series times (series by courses)."""
    sent = pixels.sparkSession.sparkContext.broadcast(courses)
    n, k = courses.shape

    def run(batches):
        total = np.zeros((n, k))
        for _, _, x in _blocks(batches):
            total += x.T @ (x @ sent.value)
        if total.any():
            pieces = [p.tobytes() for p in np.split(total, range(PIECE, n, PIECE))]
            yield pa.RecordBatch.from_pydict({"piece": pa.array(range(len(pieces)), pa.int32()), "total": pieces})

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"piece": [key[0]], "total": [np.sum([np.frombuffer(b) for b in rows["total"]], axis=0).tobytes()]})

    rows = pixels.select("x").mapInArrow(run, "piece int, total binary").groupBy("piece").applyInPandas(add, "piece int, total binary").orderBy("piece").collect()
    sent.unpersist()
    return np.concatenate([np.frombuffer(r["total"]) for r in rows]).reshape(n, k) if rows else np.zeros((n, k))


def _new_directions(basis: np.ndarray, more: np.ndarray) -> np.ndarray:
    """What ``more`` adds to an orthonormal basis, orthonormal; twice, as once leaves rounding."""
    size = np.linalg.norm(more, axis=0).max(initial=0.0)
    for _ in range(2):
        more = more - basis @ (basis.T @ more)
        more, r = np.linalg.qr(more)
        kept = np.abs(np.diag(r)) > 1e-12 * max(size, 1e-300)
        more, size = more[:, kept], 1.0
    return more


def time_courses(pixels: DataFrame, components: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The strongest time courses (frames by components, orthonormal) of packed pixels and their variances' sums, strongest first.

    A block of courses grows by the products of its newest part; the best courses within it are those of a small matrix. When it
    gets too wide it starts anew from the best. Equally strong components come in any rotation.
    """
    sizes = pixels.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if sizes[0] != sizes[1] or not sizes[0]:
        raise ValueError("every pixel needs the same frames")
    n = sizes[0]
    wide = min(n, components + SPARE)
    newest = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, wide)))[0]
    basis, images = newest, _products(pixels, newest)
    for _ in range(PASSES):
        small = basis.T @ images
        strength, turn = np.linalg.eigh((small + small.T) / 2)
        turn = turn[:, ::-1][:, :wide]
        strength = strength[::-1][:wide]
        best, moved = basis @ turn, images @ turn
        off = np.linalg.norm((moved - best * strength)[:, :components], axis=0)
        if off.max(initial=0.0) <= CLOSE * max(strength[0], 1e-300):
            break
        if basis.shape[1] + wide > HELD * wide:
            basis, images = best, moved
        newest = _new_directions(basis, images[:, -wide:] if basis.shape[1] > wide else moved - best * strength)
        if not newest.shape[1]:
            break
        basis, images = np.hstack([basis, newest]), np.hstack([images, _products(pixels, newest)])
    return best[:, :components], np.maximum(strength[:components], 0)


def denoised(movie: DataFrame, components: int, seed: int = 0) -> DataFrame:
    """r, c, t, v of a movie from its means and strongest components. Every pixel needs all frames; frames keep their numbers."""
    pixels = written(packed(movie))
    if pixels.isEmpty():
        return movie.select("r", "c", F.col("t").cast("long").alias("t"), F.col("v").cast("double").alias("v"))
    courses, _ = time_courses(pixels, components, seed)
    sent = pixels.sparkSession.sparkContext.broadcast(courses)

    def run(batches):
        for part, mean, x in _blocks(batches):
            y = mean + (x @ sent.value) @ sent.value.T
            yield pa.RecordBatch.from_pydict({"r": part.column("r"), "c": part.column("c"), "x": pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))})

    kinds = dict(pixels.dtypes)
    out = pixels.mapInArrow(run, f"r {kinds['r']}, c {kinds['c']}, x array<double>").select("r", "c", F.posexplode("x").alias("k", "v"))
    frames = written(movie.select("t").distinct())
    numbers = frames.sparkSession.createDataFrame([(k, r["t"]) for k, r in enumerate(frames.orderBy("t").collect())], "k int, t long")  # as many as a recording has frames
    return out.join(F.broadcast(numbers), "k").select("r", "c", "t", "v")


def pixel_weights(movie: DataFrame, components: int, seed: int = 0) -> DataFrame:
    """component, r, c, weight: the components as images of unit length."""
    pixels = written(packed(movie))
    courses, strength = time_courses(pixels, components, seed)
    scale = np.divide(1.0, np.sqrt(strength), out=np.zeros(len(strength)), where=strength > 0)
    sent = pixels.sparkSession.sparkContext.broadcast(courses * scale)

    def run(batches):
        for part, _, x in _blocks(batches):
            w = x @ sent.value
            yield pa.RecordBatch.from_pydict({"r": part.column("r"), "c": part.column("c"), "w": pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))})

    kinds = dict(pixels.dtypes)
    return pixels.mapInArrow(run, f"r {kinds['r']}, c {kinds['c']}, w array<double>").select("r", "c", F.posexplode("w").alias("component", "weight")).select("component", "r", "c", "weight")
