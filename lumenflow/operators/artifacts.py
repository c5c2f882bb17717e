"""Bundles for labelling and classifying regions: projections, cut-outs, traces and a manifest of what they were made from.

Each part of a bundle is a table of its own under the bundle's folder; a job that was lost goes on after the last whole one. Parts are
made anew if the manifest there is of other inputs or settings.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.functions.scalars import to_range
from lumenflow.operators import movies, rois, traces
from lumenflow.operators.traces import if_small
from lumenflow.sources import files
from lumenflow.sources import movies as stored
from lumenflow.sources.digests import digests
from lumenflow.sources.scratch import is_whole, kept, written

#: Kinds of cut-outs, by what they show.
IMAGES = ("max", "avg", "correlation", "mask")


def scaled_image(image: DataFrame, shares: tuple[float, float] | None = None) -> DataFrame:
    """r, c, v of an image as 0 to 255 between two of its quantiles, or its least and greatest value; 0 where all are one."""
    limits = movies.quantiles(image, "v", list(shares or (0.0, 1.0)))
    return image.select("r", "c", F.coalesce(to_range(F.col("v"), *(F.lit(q).cast("double") for q in limits)), F.lit(0.0)).cast("int").alias("v"))


def manifest(spark: SparkSession, inputs: dict[str, str], settings: dict) -> DataFrame:
    """input, path, size, digest of each input, and one row with the settings (as JSON, by name) and their digest."""
    text = json.dumps(settings, sort_keys=True)
    own = spark.createDataFrame([("settings", text, len(text.encode()))], "input string, path string, size long").withColumn("digest", F.md5("path"))
    return digests(spark, inputs).unionByName(own)


def _same(spark: SparkSession, path: str, fresh: DataFrame) -> bool:
    """Whether a whole manifest at the path tells of the same inputs and settings."""
    if not is_whole(spark, path):
        return False
    old = {(r["input"], r["digest"]) for r in spark.read.parquet(path).collect()}  # one row for each input
    return old == {(r["input"], r["digest"]) for r in fresh.collect()}


class _Bundle:
    """Tables under a folder named after the manifest, so that those of other inputs aren't taken for one's own."""

    def __init__(self, spark: SparkSession, out: str, inputs: dict[str, str], settings: dict):
        fresh = written(manifest(spark, inputs, settings).coalesce(1))
        self.spark, self.redo = spark, not _same(spark, f"{out}/manifest", fresh)
        self.name = fresh.agg(F.md5(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "input", "digest"))), "\n"))).first()[0]
        self.folder, self.manifest = f"{out}/{self.name}", fresh
        self.out = out

    def part(self, name: str, make) -> DataFrame:
        return kept(self.spark, f"{self.folder}/{name}", make)

    def finish(self) -> None:
        """The manifest is written last: one that is there says that all its parts are."""
        if self.redo:
            self.manifest.write.mode("overwrite").parquet(f"{self.out}/manifest")


def _projections(movie: DataFrame) -> dict[str, DataFrame]:
    both = movies.projection(movie)
    return {"max": both.select("r", "c", F.col("max_v").alias("v")), "avg": both.select("r", "c", F.col("avg_v").alias("v"))}


def labeler_bundle(spark: SparkSession, out: str, movie_path: str, roi_path: str, edges_path: str, motion_path: str | None = None, projection_shares: tuple[float, float] = (0.2, 0.99), movie_shares: tuple[float, float] = (0.1, 0.99), weight: str = "pearson") -> dict[str, DataFrame]:
    """What a labeller needs, as tables: manifest, rois (records as read), colours (touching regions differ), max, avg and correlation
    (0 to 255), movie (0 to 255), border, traces.

    ``movie_path`` is a movie in blocks and tiles, ``roi_path`` JSON of region records, ``edges_path`` a table of pixel pairs with
    ``weight``, ``motion_path`` a registration CSV; without one the border is 0.
    """
    inputs = {"movie": movie_path, "rois": roi_path, "correlation": edges_path} | ({"motion": motion_path} if motion_path else {})
    bundle = _Bundle(spark, out, inputs, {"projection_shares": projection_shares, "movie_shares": movie_shares, "weight": weight})
    movie = stored.read_movie(spark, movie_path)
    records = bundle.part("rois", lambda: files.rois(spark, roi_path))
    pixels = rois.from_dense(records.select(F.col("id").cast("int").alias("roi"), "x", "y", "mask"))
    flat = bundle.part("projection", lambda: movies.projection(movie))
    parts = {"rois": records}
    for name, column in (("max", "max_v"), ("avg", "avg_v")):
        parts[name] = bundle.part(name, lambda column=column: scaled_image(flat.select("r", "c", F.col(column).alias("v")), projection_shares))
    parts["correlation"] = bundle.part("correlation", lambda: scaled_image(movies.graph_image(spark.read.parquet(edges_path), weight)))
    parts["movie"] = bundle.part("movie", lambda: movies.scaled(movie, *movie_shares))
    parts["colours"] = bundle.part("colours", lambda: rois.colours(pixels))
    parts["traces"] = bundle.part("traces", lambda: traces.masked_mean(movie, pixels))
    still = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0)], "left_side double, right_side double, top double, bottom double")
    shift = (lambda: rois.motion_border(files.motion(spark, motion_path)).select("left_side", "right_side", "top", "bottom")) if motion_path else (lambda: still)
    parts["border"] = bundle.part("border", shift)
    bundle.finish()
    return parts | {"manifest": bundle.manifest}


def cut_outs(layers: dict[str, DataFrame], pixels: DataFrame, size: int) -> DataFrame:
    """roi, image, r, c, v: a window of each image around the middle of each region, and of its mask (255 on its pixels), 0 outside.

    Windows of all regions and images come from one join: a region's window goes to the tiles of ``size`` pixels that it meets,
    and there takes the pixels of all images.
    """
    boxes = rois.centres(pixels)
    low = lambda middle: F.col(middle) - size // 2
    windows = boxes.select("roi", low("middle_y").alias("r0"), low("middle_x").alias("c0"))
    tile = lambda c: F.floor(F.col(c) / size).cast("int")
    near = windows.withColumn("tr", F.explode(F.array(tile("r0"), tile("r0") + 1))).withColumn("tc", F.explode(F.array(tile("c0"), tile("c0") + 1)))
    stacked = None
    for name, image in layers.items():
        one = image.select(F.lit(name).alias("image"), "r", "c", F.col("v").cast("int").alias("v"))
        stacked = one if stacked is None else stacked.unionAll(one)
    met = stacked.withColumn("tr", tile("r")).withColumn("tc", tile("c")).join(if_small(near), ["tr", "tc"])
    seen = met.select("roi", "image", (F.col("r") - F.col("r0")).alias("r"), (F.col("c") - F.col("c0")).alias("c"), "v")
    own = pixels.select("roi", "r", "c").distinct().join(if_small(windows), "roi").select("roi", F.lit("mask").alias("image"), (F.col("r") - F.col("r0")).alias("r"), (F.col("c") - F.col("c0")).alias("c"), F.lit(255).alias("v"))
    inside = F.col("r").between(0, size - 1) & F.col("c").between(0, size - 1)
    steps = F.sequence(F.lit(0), F.lit(size - 1))
    names = F.array(*(F.lit(n) for n in (*layers, "mask")))
    grid = windows.select("roi", F.explode(names).alias("image")).select("*", F.explode(steps).alias("r")).select("*", F.explode(steps).alias("c"))
    return grid.join(seen.unionAll(own).where(inside), ["roi", "image", "r", "c"], "left").select("roi", "image", "r", "c", F.coalesce("v", F.lit(0)).alias("v"))


def classifier_bundle(spark: SparkSession, out: str, movie_path: str, roi_path: str, edges_path: str, size: int = 128, shares: tuple[float, float] = (0.2, 0.99), selected: list[int] | None = None, weight: str = "filtered_hnc_Gaussian") -> dict[str, DataFrame]:
    """manifest, cut_outs (of the selected regions, all if none are named; one directory for each image), and empty: regions of which
    the window shows no pixel."""
    bundle = _Bundle(spark, out, {"movie": movie_path, "rois": roi_path, "correlation": edges_path}, {"size": size, "shares": shares, "selected": selected, "weight": weight})
    records = files.rois(spark, roi_path).select(F.col("id").cast("int").alias("roi"), "x", "y", "mask")
    chosen = records if selected is None else records.where(F.col("roi").isin(selected))
    layers = _projections(stored.read_movie(spark, movie_path)) | {"correlation": movies.graph_image(spark.read.parquet(edges_path), weight)}
    scaled = {name: bundle.part(name, lambda image=image: scaled_image(image, shares)) for name, image in layers.items()}
    made = bundle.part("cut_outs", lambda: cut_outs(scaled, rois.from_dense(chosen), size))
    empty = made.where("image = 'mask'").groupBy("roi").agg(F.max("v").alias("v")).where("v = 0").select("roi")
    bundle.finish()
    return {"manifest": bundle.manifest, "cut_outs": made, "empty": empty}


def selected_windows(bundle: dict[str, DataFrame], image: str) -> DataFrame:
    """roi, window: one row for each region, the rows of its window as arrays, for a classifier."""
    rows = bundle["cut_outs"].where(F.col("image") == image).groupBy("roi", "r").agg(F.transform(F.sort_array(F.collect_list(F.struct("c", "v"))), lambda p: p["v"]).alias("row"))
    return rows.groupBy("roi").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "row"))), lambda p: p["row"]).alias("window"))
