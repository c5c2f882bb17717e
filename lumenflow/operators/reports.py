"""Quality figures of regions and registration, views of movies, and filters over time and frames."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.functions.phase import gaussian_weights
from lumenflow.functions.scalars import frames_per_bin, to_range
from lumenflow.operators import movies, registration, rois
from lumenflow.operators.traces import if_small
from lumenflow.sources import tiff

#: How the frames of a bin become one: a value for each name, from columns t and v.
STRATEGIES: dict[str, Callable[[int], Column]] = {
    "average": lambda seed: F.avg("v"),
    "maximum": lambda seed: F.max("v"),
    "first": lambda seed: F.min_by("v", "t"),
    "last": lambda seed: F.max_by("v", "t"),
    "random": lambda seed: F.max_by("v", F.struct(F.xxhash64(F.lit(seed), "t"), "t")),
}


def binned(movie: DataFrame, input_hz: float, output_hz: float, strategy: str = "average", seed: int = 0) -> DataFrame:
    """r, c, t, v of a movie at a lower rate, each bin's frames made one by a strategy; a random one takes the same frame of a bin for
    all pixels. The short last bin stays."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategies are {', '.join(STRATEGIES)}")
    n = frames_per_bin(input_hz, output_hz)
    return movie.groupBy("r", "c", F.floor(F.col("t") / n).cast("int").alias("t")).agg(STRATEGIES[strategy](seed).alias("v"))


def region_report(movie: DataFrame, pixels: DataFrame, quantile: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """roi, t, weighted, binary: traces by a region's weights and by its binary mask; and for each region roi, n_weighted, n_binary
    (pixels) and the correlation of both. Both traces come from one join with the movie."""
    binary = rois.binarize(pixels, quantile).select("roi", "r", "c", F.lit(1.0).alias("b"))
    both = pixels.join(binary, ["roi", "r", "c"], "left").withColumn("b", F.coalesce("b", F.lit(0.0)))
    joined = movie.join(if_small(both), ["r", "c"]).groupBy("roi", "t")
    series = joined.agg((F.sum(F.col("v") * F.col("w")) / F.count("*")).alias("weighted"), (F.sum(F.col("v") * F.col("b")) / F.nullif(F.sum("b"), F.lit(0.0))).alias("binary"))
    sizes = both.groupBy("roi").agg(F.count("*").alias("n_weighted"), F.sum("b").cast("long").alias("n_binary"))
    return series, sizes.join(series.groupBy("roi").agg(F.corr("weighted", "binary").alias("correlation")), "roi", "left")


def preview(raw: DataFrame, corrected: DataFrame, rate_hz: float, bin_seconds: float, shares: tuple[float, float] = (0.1, 0.999)) -> DataFrame:
    """r, c, t, v (0 to 255) of a raw and a corrected movie side by side, averaged over bins, each scaled between quantiles of its own
    mean image."""
    out = None
    for movie, right in ((raw, False), (corrected, True)):
        slow = binned(movie, rate_hz, 1 / bin_seconds)
        limits = movies.quantiles(slow.groupBy("r", "c").agg(F.avg("v").alias("v")), "v", list(shares))
        scaled = slow.join(movies.extent(raw)).select("r", (F.col("c") + (F.col("columns") if right else 0)).cast("int").alias("c"), "t", to_range(F.col("v"), *(F.lit(q).cast("double") for q in limits)).cast("int").alias("v"))
        out = scaled if out is None else out.unionAll(scaled)
    return out


def shift_summary(shift: DataFrame) -> DataFrame:
    """frames, x, y: the number of frames and the greatest offsets in both directions."""
    return shift.agg(F.count("*").alias("frames"), F.max(F.abs("x")).alias("x"), F.max(F.abs("y")).alias("y"))


def rgb(image: DataFrame, lower: float | None = None, upper: float | None = None) -> DataFrame:
    """The image's other columns with red, green and blue of 0 to 255, all the same; without cut-offs between the least and the
    greatest value. An image of one value is black."""
    known = [q if given is None else given for q, given in zip(movies.quantiles(image, "v", [0.0, 1.0]), (lower, upper))]
    grey = F.coalesce(to_range(F.col("v"), *(F.lit(q).cast("double") for q in known)), F.lit(0.0)).cast("int")
    return image.select(*(c for c in image.columns if c != "v"), *(grey.alias(c) for c in ("red", "green", "blue")))


def filtered_in_time(movie: DataFrame, size: float, kind: str, whole: bool = False) -> DataFrame:
    """r, c, t, v of a movie smoothed over time, the ends held: ``boxcar`` is the mean of ``size`` frames (an even number reaches further
    back), ``gaussian`` has the deviation ``size`` and ends after four. ``whole`` cuts to whole numbers, for movies of such.
    A pixel is one row of packed frames."""
    if kind == "boxcar":
        weights, before = np.full(int(size), 1 / int(size)), int(size) // 2
    elif kind == "gaussian":
        weights = gaussian_weights(size)
        before = len(weights) // 2
    else:
        raise ValueError("filters are boxcar and gaussian")
    series = movies.packed(movie.select("r", "c", F.col("t"), F.struct(F.col("t").cast("long").alias("t"), F.col("v").cast("double").alias("v")).alias("v")))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                frames = batch.column("x").slice(i, 1).flatten()
                t, v = frames.field("t"), frames.field("v").to_numpy(zero_copy_only=False)
                smooth = np.convolve(np.pad(v, (before, len(weights) - 1 - before), mode="edge"), weights[::-1], "valid")
                smooth = np.trunc(np.round(smooth, 9)) if whole else smooth
                same = {k: pa.array([batch.column(k)[i].as_py()] * len(v), pa.int32()) for k in "rc"}
                yield pa.RecordBatch.from_pydict({**same, "t": t, "v": smooth})

    return series.select(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), "x").mapInArrow(run, "r int, c int, t long, v double")


def filtered_frames(movie: DataFrame, rule: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """r, c, t, v of a movie whose frames went through ``rule``, which takes and gives some frames (frame, row, column)."""

    def run(batches):
        for t, stack in registration._stacks(batches):
            made = np.asarray(rule(stack), float)
            if made.shape != stack.shape:
                raise ValueError(f"the rule made {made.shape} of {stack.shape}")
            yield pa.RecordBatch.from_pydict({"t": pa.array(t, pa.int64()), "rows": pa.array([stack.shape[1]] * len(t), pa.int32()), "columns": pa.array([stack.shape[2]] * len(t), pa.int32()), "kind": ["<f8"] * len(t), "pixels": [x.astype("<f8").tobytes() for x in made]})

    out = registration.packed_frames(movie).mapInArrow(run, "t long, rows int, columns int, kind string, pixels binary")
    return tiff.pixels(out).select("r", "c", "t", "v")


def each_trace(trace: DataFrame, rule: Callable[[np.ndarray], dict], schema: str) -> DataFrame:
    """roi and the columns of ``schema`` that ``rule`` gives for the values of each region, one row each."""
    import pandas as pd

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"roi": key[0], **rule(rows.sort_values("t")["f"].to_numpy(float))}])

    return trace.select("roi", "t", "f").groupBy("roi").applyInPandas(run, f"roi {dict(trace.dtypes)['roi']}, {schema}")


def with_metadata(experiments: DataFrame, metadata: DataFrame) -> DataFrame:
    """Experiments with the metadata of their number; an experiment without any, or metadata that is there twice, is an error."""
    twice = metadata.groupBy("experiment").count().where("count > 1")
    lost = experiments.join(metadata.select("experiment"), "experiment", "left_anti")
    for bad, why in ((twice, "has metadata twice"), (lost, "has no metadata")):
        if row := bad.select("experiment").first():
            raise ValueError(f"experiment {row[0]} {why}")
    return experiments.join(if_small(metadata), "experiment")
