"""Splitting what a scanner recorded in turn: pages of all planes in one file become a movie for each plane.

The file is read once; each page goes to its plane and block of frames by its number alone, so the write's shuffle is the only
one. What a plane's frames are is checked before a movie is declared whole.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.operators import selection
from lumenflow.operators.traces import if_small
from lumenflow.sources import tiff

#: Frames of one file of a plane's movie.
BLOCK = 1000


@dataclass(frozen=True)
class Plane:
    """A region and depth, in the order in which the scanner goes through them."""

    place: int
    region: int
    z: float


def planes_of(header: dict) -> list[Plane]:
    """The planes of a file in page order. Depths come region by region; with one channel the scanner writes a zero behind each."""
    depths = json.loads(header["depths"])
    if not isinstance(depths, list):
        raise ValueError("it is unclear how to split a file with one depth")
    flat = [z for part in depths for z in (part if isinstance(part, list) else [part])]
    channels = json.loads(header["channels"])
    if channels == 1:
        if any(flat[1::2]):
            raise ValueError("with one channel every second depth must be zero")
        flat = flat[::2]
    elif channels != [1, 2]:
        raise ValueError(f"channels {channels} can't be split")
    owners: dict[int, int] = {}
    for k, region in enumerate(json.loads(header["regions"])):
        zs = region["zs"] if isinstance(region["zs"], list) else [region["zs"]]
        keys = [round(z * 1e6) for z in zs]
        if len(set(keys)) < len(keys):
            raise ValueError(f"region {k} has a depth twice")
        for z in keys:
            if z in owners:
                raise ValueError(f"depth {z / 1e6} belongs to two regions")
            owners[z] = k
    out = []
    for place, z in enumerate(flat):
        if round(z * 1e6) not in owners:
            raise ValueError(f"depth {z} belongs to no region")
        out.append(Plane(place, owners[round(z * 1e6)], float(z)))
    return out


def by_plane(pages: DataFrame, planes: int) -> DataFrame:
    """The pages with place (of the plane) and t (frame in it): planes follow each other in turn."""
    return pages.withColumn("place", (F.col("page") % planes).cast("int")).withColumn("t", F.floor(F.col("page") / planes).cast("long"))


def shapes(pages: DataFrame) -> DataFrame:
    """rows, columns, kind, n of the kinds of pages."""
    return pages.groupBy("rows", "columns", "kind").agg(F.count("*").alias("n"))


@dataclass
class Split:
    """``planes``: place, experiment, region, z, path, frames, rows, columns. ``frames``: place, t, rows, columns, kind, pixels, as
    written."""

    planes: DataFrame
    frames: DataFrame


def split_movies(spark: SparkSession, path: str, out: str, experiments: dict[int, int] | None = None, at_once: int = tiff.PAGES_AT_ONCE) -> Split:
    """Writes each plane of a recording under ``out``/movies, in blocks of frames, and gives a table of the planes.

    ``experiments`` names the planes by place (all of them; else the place is the name). Pages of different shape or kind are
    refused, and so are experiments that don't name all planes; planes may differ by a frame, as a recording can stop anywhere.
    """
    header = tiff.headers(spark, [path]).first().asDict()
    planes = planes_of(header)
    if experiments is not None and set(experiments) != {p.place for p in planes}:
        raise ValueError(f"{len(experiments)} experiments are named for {len(planes)} planes")
    pages = tiff.read_pages(spark, [path], at_once)
    kinds = shapes(pages.select("rows", "columns", "kind")).collect()
    if len(kinds) > 1:
        raise ValueError(f"pages differ in shape or kind: {sorted((k['rows'], k['columns'], k['kind']) for k in kinds)}")
    placed = by_plane(pages, len(planes)).select("place", F.floor(F.col("t") / BLOCK).cast("int").alias("block"), "t", "rows", "columns", "kind", "pixels")
    placed.repartition("place", "block").sortWithinPartitions("place", "block", "t").write.partitionBy("place", "block").parquet(f"{out}/movies")
    named = [(p.place, (experiments or {}).get(p.place, p.place), p.region, p.z, f"{out}/movies/place={p.place}") for p in planes]
    names = spark.createDataFrame(named, "place int, experiment long, region int, z double, path string")
    frames = spark.read.schema("t long, rows int, columns int, kind string, pixels binary, place int, block int").parquet(f"{out}/movies").drop("block")
    counts = frames.groupBy("place").agg(F.count("*").alias("frames"), F.first("rows").alias("rows"), F.first("columns").alias("columns"))
    return Split(names.join(F.broadcast(counts), "place", "left").withColumn("frames", F.coalesce("frames", F.lit(0))), frames)


def plane_movie(frames: DataFrame, place: int) -> DataFrame:
    """r, c, t, v of one plane."""
    return tiff.pixels(frames.where(F.col("place") == place).select("t", "rows", "columns", "kind", "pixels")).select("r", "c", F.col("t").cast("int").alias("t"), "v")


def average_images(spark: SparkSession, path: str, at_once: int = tiff.PAGES_AT_ONCE) -> DataFrame:
    """region, z, r, c, v: the mean image of each plane of a file of repeated scans; their number must be volumes times slices."""
    header = tiff.headers(spark, [path]).first().asDict()
    planes = planes_of(header)
    pages = tiff.read_pages(spark, [path], at_once)
    names = spark.createDataFrame([(p.place, p.region, p.z) for p in planes], "place int, region int, z double")
    summed = tiff.pixels(by_plane(pages, len(planes))).groupBy("place", "r", "c").agg(F.avg("v").alias("v"))
    return summed.join(F.broadcast(names), "place").select("region", "z", "r", "c", "v")


def full_field_image(spark: SparkSession, path: str, at_once: int = tiff.PAGES_AT_ONCE) -> DataFrame:
    """r, c, v: the mean of all pages of a scan of the full field."""
    header = tiff.headers(spark, [path]).first()
    pages = tiff.pixels(tiff.read_pages(spark, [path], at_once))
    return selection.page_average(pages, header["volumes"], header["slices"])


def split_job(spark: SparkSession, recording: str, depths: str, out: str, experiments: dict[int, int] | None = None) -> DataFrame:
    """Splits a recording and its depth scan, and gives the planes with their average image's path: place, experiment, region, z,
    path, frames, rows, columns, depth_path. Both files must scan the same regions and depths."""
    split = split_movies(spark, recording, out, experiments)
    held = average_images(spark, depths).withColumn("key", F.concat_ws("_", "region", F.format_string("%.3f", "z")))
    tiff.write_page_averages(held.select("key", "r", "c", "v"), f"{out}/depths")
    found = held.select("region", "z", "key").distinct()
    met = split.planes.join(if_small(found), ["region", "z"], "full")
    if met.where("place is null or key is null").limit(1).count():
        raise ValueError("the recording and the depth scan differ in their regions or depths")
    return met.select("place", "experiment", "region", "z", "path", "frames", "rows", "columns", F.concat(F.lit(f"{out}/depths/key="), "key").alias("depth_path"))
