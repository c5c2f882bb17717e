"""Geometry of scanned regions, page series of z-stacks, pixel figures and overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.functions.scalars import to_range
from lumenflow.operators import graphs, images, movies


def _refuse(bad: DataFrame, why: str) -> None:
    if not bad.isEmpty():
        raise ValueError(why)


def scan_regions(fields: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """region, x, y, width, height, columns, rows of each region's scan fields; fields of one region must agree."""
    near = lambda c: F.max(c) - F.min(c) > 1e-8 + tolerance * F.max(F.abs(c))
    off = [F.max(F.abs(c)) > tolerance for c in (F.col("x") - F.col("mx"), F.col("y") - F.col("my"))]
    middle = fields.groupBy("region").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    out = fields.join(middle, "region").groupBy("region").agg(
        F.first("mx").alias("x"), F.first("my").alias("y"), *(F.first(c).alias(c) for c in ("width", "height", "columns", "rows")),
        (off[0] | off[1]).alias("apart"), (near("width") | near("height")).alias("sized"), ((F.min("columns") != F.max("columns")) | (F.min("rows") != F.max("rows"))).alias("fine"),
    )
    _refuse(out.where("apart or sized or fine"), "scan fields of one region differ in centre, size or resolution")
    return out.drop("apart", "sized", "fine")


def stitched(image: DataFrame, regions: DataFrame) -> DataFrame:
    """r, c, v of the regions' tiles side by side. ``image`` holds them below each other with a gap; of tiles that
    overlap the later region's counts; uncovered pixels are 0. All regions must have one size and resolution."""
    one = regions.agg(F.count("*").alias("n"), *(F.min(c).alias(c) for c in ("columns", "rows", "width", "height")), F.min(F.col("x") - F.col("width") / 2).alias("left"), F.min(F.col("y") - F.col("height") / 2).alias("top"), F.size(F.collect_set(F.struct("columns", "rows", "width", "height"))).alias("kinds")).first()
    if one["n"] == 0 or one["kinds"] != 1:
        raise ValueError("regions of one size and resolution are needed")
    seen = image.agg((F.max("r") + 1).alias("rows"), (F.max("c") + 1).alias("columns")).first()
    gap = (seen["rows"] - one["rows"] * one["n"]) // max(one["n"] - 1, 1)
    if (seen["rows"], seen["columns"]) != (one["n"] * one["rows"] + (one["n"] - 1) * gap, one["columns"]) or gap < 0:
        raise ValueError("the image's shape is not that of its tiles")
    step = one["rows"] + gap
    row0 = F.rint((F.col("y") - one["height"] / 2 - one["top"]) * one["rows"] / one["height"])
    column0 = F.rint((F.col("x") - one["width"] / 2 - one["left"]) * one["columns"] / one["width"])
    tiles = image.withColumn("region", F.floor(F.col("r") / step).cast("int")).withColumn("r", F.col("r") % step).where(F.col("r") < one["rows"])
    at = regions.select(F.col("region").cast("int").alias("region"), row0.cast("int").alias("row0"), column0.cast("int").alias("column0"))
    placed = tiles.join(F.broadcast(at), "region").select((F.col("r") + F.col("row0")).alias("r"), (F.col("c") + F.col("column0")).alias("c"), "region", "v")
    held = placed.groupBy("r", "c").agg(F.max_by("v", "region").alias("v"))
    grid = image.sparkSession.range(one["rows"] * one["columns"] * one["n"]).select(F.floor(F.col("id") / (one["columns"] * one["n"])).cast("int").alias("r"), (F.col("id") % (one["columns"] * one["n"])).cast("int").alias("c"))
    return grid.join(held, ["r", "c"], "left").select("r", "c", F.coalesce("v", F.lit(0.0)).alias("v"))


def stack_pages(pages: DataFrame, modes: DataFrame, depths: DataFrame) -> DataFrame:
    """region, z, n, r, c, v of z-stack files. Of each file's regions (path, region, mode) one has mode 0 and owns the
    file; its pages (path, page, r, c, v) alternate between two depths, the means of the two columns of the file's
    depths (path, side, z)."""
    owner = modes.groupBy("path").agg(F.count_if(F.col("mode") == 0).alias("n"), F.min(F.when(F.col("mode") == 0, F.col("region"))).alias("region"))
    _refuse(owner.where("n <> 1"), "each file needs one region with mode 0")
    _refuse(modes.select("region").distinct().join(owner, "region", "left_anti"), "a region has no file of its own")
    mean = depths.groupBy("path", "side").agg(F.avg("z").alias("z"))
    sided = pages.withColumn("side", (F.col("page") % 2).cast("int")).withColumn("n", F.floor(F.col("page") / 2).cast("int"))
    return sided.join(F.broadcast(mean), ["path", "side"]).join(F.broadcast(owner.select("path", "region")), "path").select("region", "z", "n", "r", "c", "v")


def _deviation(values: Column) -> Column:
    """Deviation (n) of a sorted array, null without values, from sums above the least value. These are exact for whole numbers, so that
    a deviation that is a whole number isn't cut to the one below, as it may be with running means, by the order of rows."""
    add = lambda s, v: F.struct((s["n"] + 1).alias("n"), (s["d"] + v).alias("d"), (s["dd"] + v * v).alias("dd"))
    zero = F.struct(*(F.lit(0.0).alias(c) for c in ("n", "d", "dd")))
    above = F.transform(values, lambda v: v - F.get(values, F.lit(0)))
    return F.aggregate(above, zero, add, lambda s: F.when(s["n"] > 0, F.sqrt(F.greatest(s["n"] * s["dd"] - s["d"] * s["d"], F.lit(0.0))) / s["n"]))


def pixel_figures(movie: DataFrame, every: int = 8) -> DataFrame:
    """r, c, mean, deviation (over every 8th frame) and mode (of equal counts the least), the first two cut to whole numbers."""
    some = F.sort_array(F.collect_list(F.when(F.col("t") % every == 0, F.col("v").cast("double"))))
    out = movie.groupBy("r", "c").agg(F.avg("v").cast("int").alias("mean"), some.alias("some"), F.mode("v", True).alias("mode"))
    return out.select("r", "c", "mean", _deviation(F.col("some")).cast("int").alias("deviation"), "mode")


def whole_positive(movie: DataFrame, top: int = 65_535) -> DataFrame:
    """Pixels as whole numbers from 0 on: negative ones are 0, parts are cut off."""
    return movie.withColumn("v", F.least(F.greatest(F.col("v"), F.lit(0.0)), F.lit(float(top))).cast("int"))


def shared_shift(regions: DataFrame) -> DataFrame:
    """One row y1, y0, x0, x1: the shift up, down, right and left that all regions must share."""
    kinds = regions.select(F.col("up").alias("y1"), F.col("down").alias("y0"), F.col("right").alias("x0"), F.col("left").alias("x1")).distinct().limit(2)
    if kinds.count() != 1:
        raise ValueError("all regions must share one shift")
    return kinds


def decay_times(sessions: DataFrame, lookup: DataFrame) -> DataFrame:
    """``decay`` by genotype (lookup: genotype, decay), which overrides a given one and says so; without a genotype the
    given one stays. An unknown genotype, or neither of the two, is an error."""
    known = lookup.select("genotype", F.col("decay").alias("known"))
    met = sessions.join(F.broadcast(known), "genotype", "left")
    _refuse(met.where("known is null and (genotype is not null or decay is null)"), "genotype not in the lookup, or no decay time")
    return met.withColumn("overridden", F.col("known").isNotNull() & F.col("decay").isNotNull()).withColumn("decay", F.coalesce("known", "decay")).drop("known")


def global_pixels(masks: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pixels of masks in the frame's coordinates: those in the box, moved by its corner (roi, x, y)."""
    return masks.join(boxes.select("roi", "x", "y"), "roi").select("roi", (F.col("r") + F.col("y")).alias("r"), (F.col("c") + F.col("x")).alias("c"))


def cropped_acutance(image: DataFrame, top: int, bottom: int, left: int, right: int) -> DataFrame:
    """Acutance of the image without so many rows and columns at each side."""
    size = F.broadcast(image.agg((F.max("r") + 1).alias("rows"), (F.max("c") + 1).alias("columns")))
    kept = (F.col("r") >= top) & (F.col("r") < F.col("rows") - bottom) & (F.col("c") >= left) & (F.col("c") < F.col("columns") - right)
    return images.acutance(image.join(size).where(kept).select("r", "c", "v"))


def scaled_window(movie: DataFrame, origin: tuple[int, int], shape: tuple[int, int], shares: tuple[float, float] | None = None, limits: tuple[float, float] | None = None) -> DataFrame:
    """A window of the movie as 0 to 255, between two of its quantiles or two given values: exactly one of both is given."""
    if (shares is None) == (limits is None):
        raise ValueError("give either quantiles or limits")
    part = movie.where(F.col("r").between(origin[0], origin[0] + shape[0] - 1) & F.col("c").between(origin[1], origin[1] + shape[1] - 1))
    if shares is not None:
        return movies.scaled(part, *shares)
    return part.select("r", "c", "t", to_range(F.col("v"), *(F.lit(float(x)) for x in limits)).cast("int").alias("v"))


def outlined(image: DataFrame, pixels: DataFrame, colour: tuple[int, int, int], alpha: float) -> DataFrame:
    """red, green, blue of an image with the regions' contours blended in, region after region."""
    times = images.contour(pixels).groupBy("r", "c").agg(F.count("*").cast("int").alias("times"))

    def blend(channel: str, tone: int) -> Column:
        once = lambda v, _: F.rint(F.lit(alpha * tone) + (1.0 - alpha) * v)
        start = F.col(channel).cast("double")
        return F.aggregate(F.array_repeat(F.lit(0), F.coalesce("times", F.lit(0))), start, once).cast("int").alias(channel)

    return image.join(times, ["r", "c"], "left").select("r", "c", *(blend(*x) for x in zip(("red", "green", "blue"), colour)))


#: Edge weights by name: each takes a movie and the settings it needs.
METRICS = {
    "Pearson": lambda movie, **_: movies.neighbour_correlation(movie),
    "FilteredPearson": lambda movie, share, **_: graphs.filtered_correlation(movie, share),
    "HNC_Gaussian": lambda movie, radius, **_: graphs.hnc_gaussian(movie, radius),
    "FilteredHNC_Gaussian": lambda movie, radius, share, **_: graphs.hnc_gaussian(movie, radius, share),
}


def attribute(graph: DataFrame, name: str | None = None) -> str:
    """The name of a graph's only edge attribute, or the given one if it has that; else an error."""
    names = [c for c in graph.columns if c not in ("r0", "c0", "r1", "c1")]
    if name is None and len(names) == 1:
        return names[0]
    if name not in names:
        raise ValueError(f"which attribute is meant? There are {names}")
    return name
