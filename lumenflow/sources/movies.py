"""A movie as a table in blocks of frames and tiles of pixels, so that a window of it is read from few files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Frames of a block, and rows and columns of a tile. A file holds one tile over one block.
BLOCK, TILE = 1000, 128


def _part(column: str, size: int) -> Column:
    return F.floor(F.col(column) / size).cast("int")


def write_movie(movie: DataFrame, path: str, block: int = BLOCK, tile: int = TILE, **about) -> None:
    """Writes r, c, t, v. Sizes of blocks and tiles, and what else is told of the movie, lie beside the pixels in ``about``."""
    spark = movie.sparkSession
    keys = ["block", "tile_r", "tile_c"]
    placed = movie.select("r", "c", "t", "v", _part("t", block).alias("block"), _part("r", tile).alias("tile_r"), _part("c", tile).alias("tile_c"))
    placed.repartition(*keys).sortWithinPartitions(*keys, "t", "r", "c").write.partitionBy(*keys).parquet(f"{path}/pixels")
    spark.createDataFrame([(json.dumps(about | {"block": block, "tile": tile}),)], "about string").coalesce(1).write.text(f"{path}/about")


def about(spark: SparkSession, path: str) -> dict:
    """What was told of a movie."""
    return json.loads(spark.read.text(f"{path}/about").first()[0])


def read_movie(spark: SparkSession, path: str, t: tuple[int, int] | None = None, r: tuple[int, int] | None = None, c: tuple[int, int] | None = None) -> DataFrame:
    """r, c, t, v of a written movie, of the frames, rows and columns from the first to before the second of each pair. Files of
    other blocks and tiles aren't opened."""
    sizes = about(spark, path)
    out = spark.read.schema("r int, c int, t int, v double, block int, tile_r int, tile_c int").parquet(f"{path}/pixels")
    for column, part, size, limits in (("t", "block", sizes["block"], t), ("r", "tile_r", sizes["tile"], r), ("c", "tile_c", sizes["tile"], c)):
        if limits is not None:
            lo, hi = limits
            out = out.where(F.col(part).between(lo // size, (hi - 1) // size) & (F.col(column) >= lo) & (F.col(column) < hi))
    return out.select("r", "c", "t", "v")


def read_region(spark: SparkSession, path: str, pixels: DataFrame, margin: int = 0) -> DataFrame:
    """The window of a written movie around the pixels (r, c) of a graph or of regions."""
    box = pixels.agg(F.min("r"), F.max("r"), F.min("c"), F.max("c")).first()
    if box[0] is None:
        return read_movie(spark, path, t=(0, 0))
    return read_movie(spark, path, r=(box[0] - margin, box[1] + margin + 1), c=(box[2] - margin, box[3] + margin + 1))


def read_in_blocks(spark: SparkSession, path: str, blocks: int) -> list[DataFrame]:
    """The movie as one table for each run of ``blocks`` of its blocks, for work that goes through it in parts."""
    sizes = about(spark, path)
    last = spark.read.parquet(f"{path}/pixels").agg(F.max("block")).first()[0]
    step = blocks * sizes["block"]
    return [] if last is None else [read_movie(spark, path, t=(lo, lo + step)) for lo in range(0, (last + 1) * sizes["block"], step)]
