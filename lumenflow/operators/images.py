"""Spatial rules: median filter, morphology, contours, sharpness and display limits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.functions import kernels
from lumenflow.operators.movies import extent, quantiles

#: A pixel and its four neighbours: the disk of radius one.
_DISK = ((0, 0), (-1, 0), (1, 0), (0, -1), (0, 1))


def median_filter(movie: DataFrame, size: int) -> DataFrame:
    """Each frame's median over windows of odd ``size``, edges mirrored: r, c, t, v. Pixels that a frame lacks don't count. A frame is
    one row of packed pixels, so the movie is shuffled once."""
    cell = F.struct(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.col("v").cast("double").alias("v"))
    frames = movie.join(extent(movie)).groupBy("t", "rows", "columns").agg(F.collect_list(cell).alias("cells"))
    kind = dict(movie.dtypes)["t"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                cells = batch.column("cells").slice(i, 1).flatten()
                r, c = (cells.field(k).to_numpy() for k in "rc")
                image = np.full((batch.column("rows")[i].as_py(), batch.column("columns")[i].as_py()), np.nan)
                image[r, c] = cells.field("v").to_numpy(zero_copy_only=False)
                v = kernels.median_image(image, size)[r, c]
                yield pa.RecordBatch.from_pydict({"r": r, "c": c, "t": pa.array([batch.column("t")[i].as_py()] * len(r), batch.column("t").type), "v": pa.array(v, from_pandas=True)})

    return frames.mapInArrow(run, f"r int, c int, t {kind}, v double")


def _spread(pixels: DataFrame) -> DataFrame:
    steps = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in _DISK])
    return pixels.select("roi", "r", "c", F.explode(steps).alias("s")).select("roi", (F.col("r") + F.col("s.dr")).alias("r"), (F.col("c") + F.col("s.dc")).alias("c"))


def dilate(pixels: DataFrame, rows: int, columns: int) -> DataFrame:
    """Pixels of a region and their neighbours in the frame."""
    return _spread(pixels).where(F.col("r").between(0, rows - 1) & F.col("c").between(0, columns - 1)).distinct()


def erode(pixels: DataFrame, rows: int, columns: int) -> DataFrame:
    """Pixels all of whose neighbours are in the region; outside the frame counts as in it."""
    inside = lambda c, n: F.when((F.col(c) == 0) | (F.col(c) == n - 1), F.lit(1 if n > 1 else 2)).otherwise(0)
    counted = _spread(pixels).groupBy("roi", "r", "c").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") == 5 - inside("r", rows) - inside("c", columns)) & F.col("r").between(0, rows - 1) & F.col("c").between(0, columns - 1)).select("roi", "r", "c")


def close_and_open(pixels: DataFrame, rows: int, columns: int) -> DataFrame:
    """Binary closing, then opening; regions of which nothing is left have no rows."""
    closed = erode(dilate(pixels, rows, columns), rows, columns)
    return dilate(erode(closed, rows, columns), rows, columns)


def contour(pixels: DataFrame) -> DataFrame:
    """Pixels that lack a neighbour in their row or column."""
    own = pixels.select("roi", "r", "c")
    counted = _spread(own).groupBy("roi", "r", "c").agg(F.count("*").alias("n"))
    return own.join(counted.where("n < 5"), ["roi", "r", "c"], "left_semi")


def acutance(image: DataFrame) -> DataFrame:
    """Mean squared gradient: central differences, one-sided at the edges."""

    def slope(along: str, across: str) -> Column:
        w = Window.partitionBy(across).orderBy(along)
        before, after = F.lag("v").over(w), F.lead("v").over(w)
        span = F.when(before.isNull() | after.isNull(), F.lit(1.0)).otherwise(F.lit(2.0))
        return (F.coalesce(after, F.col("v")) - F.coalesce(before, F.col("v"))) / span

    return image.select(slope("r", "c").alias("gy"), slope("c", "r").alias("gx")).agg(F.avg(F.col("gy") * F.col("gy") + F.col("gx") * F.col("gx")).alias("acutance"))


def display_limits(movie: DataFrame, lo: float, hi: float, border: int) -> DataFrame:
    """Two quantiles of the movie inside a border; the border stays if nothing would be left inside."""
    size = extent(movie)
    all_in = (F.col("rows") <= 2 * border) | (F.col("columns") <= 2 * border)
    inner = (F.col("r") >= border) & (F.col("r") < F.col("rows") - border) & (F.col("c") >= border) & (F.col("c") < F.col("columns") - border)
    return movie.sparkSession.createDataFrame([tuple(quantiles(movie.join(size).where(all_in | inner), "v", [lo, hi]))], "lo double, hi double")
