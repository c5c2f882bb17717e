"""Choosing frames, regions, splits and parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.sources.scratch import written


def representative_batches(movie: DataFrame, batches: int, size: int, start: int = 0, end: int = 0) -> DataFrame:
    """batch, and the movie's rows of ``batches`` runs of ``size`` frames, evenly placed between the trimmed ends. A movie
    of fewer frames is one batch."""
    span = F.broadcast(movie.agg((F.max("t") + 1).alias("n")))  # one row
    n = F.col("n") - start - end
    runs = F.transform(F.sequence(F.lit(0), F.lit(batches - 1)), lambda i: F.struct(i.alias("batch"), (F.floor(i * n / batches) + start).alias("first")))
    placed = movie.join(span).withColumn("b", F.explode(F.when(n <= batches * size, F.array(F.struct(F.lit(0).alias("batch"), F.lit(start).cast("long").alias("first")))).otherwise(runs)))
    length = F.when(n <= batches * size, n).otherwise(F.lit(size))
    return placed.where((F.col("t") >= F.col("b.first")) & (F.col("t") < F.col("b.first") + length)).select(F.col("b.batch").alias("batch"), *movie.columns)


def frame_means(movie: DataFrame) -> DataFrame:
    return movie.groupBy("t").agg(F.avg("v").alias("m"))


def clipped_means(means: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Rows (t, m) that stay when those beyond ``sigmas`` deviations are cut again and again; equal means all stay. A round adds a filter
    on two numbers, which Spark joins to one."""
    kept, n = means, -1
    while True:
        figures = kept.agg(F.count("m").alias("n"), F.avg("m").alias("a"), F.stddev_pop("m").alias("s")).first()
        if figures["n"] == n or not figures["s"]:
            return kept
        n, reach = figures["n"], sigmas * figures["s"]
        kept = kept.where(F.col("m").between(figures["a"] - reach, figures["a"] + reach))


def usual_frames(movie: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Frames whose mean stays when means beyond ``sigmas`` deviations are cut again and again: t, m."""
    return clipped_means(written(frame_means(movie)), sigmas)


def empty_ends(movie: DataFrame, sigmas: float = 5.0) -> DataFrame:
    """lowest, highest: empty frames at the start and at the end. A frame is empty if its mean is ``sigmas`` deviations (by
    quartiles) below the mean of all; those of a half count only if they reach its end of the movie without a gap."""
    means = frame_means(movie)
    stats = F.broadcast(means.agg(F.avg("m").alias("a"), F.percentile("m", F.array(F.lit(0.25), F.lit(0.75))).alias("q"), F.count("*").alias("n")))
    marked = means.join(stats).where(F.col("m") < F.col("a") - sigmas * (F.col("q")[1] - F.col("q")[0]) / (2 * 0.6745))
    early = F.col("t") < F.floor(F.col("n") / 2)
    counts = marked.agg(F.count_if(early).alias("ne"), F.max(F.when(early, F.col("t"))).alias("last"), F.count_if(~early).alias("nl"), F.min(F.when(~early, F.col("t"))).alias("first"), F.max("n").alias("n"))
    return counts.select(F.when(F.col("ne") == F.col("last") + 1, F.col("ne")).otherwise(0).cast("long").alias("lowest"), F.when(F.col("nl") == F.col("n") - F.col("first"), F.col("nl")).otherwise(0).cast("long").alias("highest"))


def best_frames(scores: DataFrame, n: int) -> DataFrame:
    """The ``n`` frames with the highest score (t, score)."""
    return scores.orderBy(F.desc("score"), "t").limit(n)


def sample_regions(regions: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` regions without replacement, by a hash with the seed, in order of experiment and position."""
    if regions.limit(n).count() < n:
        raise ValueError(f"there are fewer than {n} regions")
    return regions.orderBy(F.xxhash64(F.lit(seed), "experiment", "position"), "experiment", "position").limit(n).orderBy("experiment", "position")


def train_and_validation(frames: DataFrame, share: float, window: int, seed: int = 1) -> DataFrame:
    """t, part and place: frames with ``window`` others on both sides; the first share trains, in an order drawn by the seed;
    ``2 * window`` frames are left out between the parts."""
    n = F.broadcast(frames.agg((F.max("t") + 1).alias("n")))
    cut = F.floor(share * (F.col("n") - 2 * window)) + window
    part = F.when(F.col("t") < cut, F.lit("train")).when(F.col("t") >= cut + 2 * window, F.lit("validation"))
    known = frames.join(n).where((F.col("t") >= window) & (F.col("t") < F.col("n") - window)).withColumn("part", part).where("part is not null")
    order = Window.partitionBy("part").orderBy(F.when(F.col("part") == "train", F.xxhash64(F.lit(seed), "t")).otherwise(F.lit(0)), "t")
    return known.select("t", "part", (F.row_number().over(order) - 1).cast("long").alias("place"))


def split_by_labels(regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Regions without and with exclusion labels."""
    out = F.size("exclusion_labels") > 0
    return regions.where(~out), regions.where(out)


def without_labels(regions: DataFrame, barred: list[str]) -> DataFrame:
    """valid is false where any of the barred labels is there."""
    return regions.withColumn("valid", ~F.arrays_overlap("exclusion_labels", F.array(*map(F.lit, barred))))


def valid_only(trace: DataFrame, regions: DataFrame) -> DataFrame:
    return trace.join(regions.where("valid").select("roi"), "roi", "left_semi")


def misaligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """Regions that one of two trace files lacks or holds at another place (roi, place)."""
    both = a.select("roi", F.col("place").alias("pa")).join(b.select("roi", F.col("place").alias("pb")), "roi", "full")
    return both.where(~F.col("pa").eqNullSafe(F.col("pb")))


def in_region_order(trace: DataFrame, regions: DataFrame) -> DataFrame:
    """place, roi, t, f in the order of the regions; one that has no trace is an error."""
    lost = regions.join(trace.select("roi").distinct(), "roi", "left_anti").select("roi").first()
    if lost:
        raise ValueError(f"region {lost[0]} has no trace")
    return trace.join(regions.select("roi", "place"), "roi").select("place", "roi", "t", "f")


def parameter_grid(values: dict[str, list[float]], df: DataFrame) -> DataFrame:
    """All combinations of parameter values, one row each."""
    out = df.sparkSession.range(1).select()
    for name, options in values.items():
        out = out.select("*", F.explode(F.array(*map(F.lit, options))).alias(name))
    return out


def best_parameters(scored: DataFrame, order: list[str]) -> DataFrame:
    """The parameters with the highest score; of equal ones the first in the given order."""
    return scored.orderBy(F.desc("score"), *order).limit(1)


def depth_ids(depths: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """z and an id shared by depths that follow one another within the tolerance. Depths are a few per recording."""
    known = depths.select("z").distinct()
    order = Window.orderBy("z")
    new = F.coalesce((F.col("z") - F.lag("z").over(order) > tolerance).cast("int"), F.lit(0))
    return known.withColumn("new", new).select("z", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("id"))


def pages_of(pages: DataFrame, regions: int, depths: int, region: int, depth: int) -> DataFrame:
    """Pages of one region and depth, which take turns: depths within regions."""
    return pages.where(F.col("page") % (regions * depths) == region * depths + depth)


def page_average(pages: DataFrame, volumes: int, slices: int) -> DataFrame:
    """Mean over all pages of a full field (page, r, c, v), whose number must be volumes times slices."""
    n = pages.select("page").distinct().count()
    if n != volumes * slices:
        raise ValueError(f"{n} pages are not {volumes} x {slices}")
    return pages.groupBy("r", "c").agg(F.avg("v").alias("v"))


def depth_manifest(depths: DataFrame, planes: DataFrame) -> DataFrame:
    """place, z, region: the scanner's order of depths (place, z) with the region (region, z) of each; a depth of no region
    or of several is an error."""
    met = depths.join(planes, "z", "left").groupBy("place", "z").agg(F.count("region").alias("n"), F.min("region").alias("region"))
    if met.where("n <> 1").limit(1).count():
        raise ValueError("each depth must belong to one region")
    return met.select("place", "z", "region")


def nearest_centre(points: DataFrame, centres: DataFrame) -> DataFrame:
    """The nearest centre (centre, x, y; a few per recording) of each point (point, x, y); of equal ones the first."""
    far = lambda c: F.struct(F.hypot(c["x"] - F.col("x"), c["y"] - F.col("y")).alias("d"), c["centre"].alias("centre"))
    all_ = F.broadcast(centres.agg(F.collect_list(F.struct("centre", "x", "y")).alias("all")))
    return points.join(all_).select("point", F.array_min(F.transform("all", far))["centre"].alias("centre"))


def cut_out(centre: Column, size: Column, width: int) -> tuple[Column, Column, Column, Column]:
    """Of a window of ``width`` around a centre: its bounds inside the image, and the padding before and after."""
    lo = F.rint(centre).cast("int") - width // 2
    hi = lo + width
    zero = F.lit(0)
    return F.greatest(zero, lo), F.least(size, hi), F.greatest(zero, -lo), F.greatest(zero, hi - size)


def thumbnail(x: Column, y: Column, width: Column, height: Column, columns: int, rows: int, padding: int) -> Column:
    """A square around a box, its side a multiple of 16, pushed into the frame: x, y and side."""
    side = F.least(F.ceil((F.greatest(width, height) + 2 * padding) / 16) * 16, F.lit(max(rows, columns))).cast("int")
    at = lambda lo, size, most: F.greatest(F.lit(0), F.least(F.floor(lo + size / 2 - side / 2), F.lit(most) - side)).cast("int")
    return F.struct(at(x, width, columns).alias("x"), at(y, height, rows).alias("y"), side.alias("side"))


def centred_image(image: DataFrame, box: DataFrame, width: int) -> DataFrame:
    """roi, r, c, v: a window of the image around each region's middle (roi, x, y, width, height), zero outside."""
    steps = F.sequence(F.lit(0), F.lit(width - 1))
    low = lambda lo, size: F.rint(F.col(lo) + F.col(size) / 2).cast("int") - width // 2
    grid = box.select("roi", low("y", "height").alias("r0"), low("x", "width").alias("c0"), F.explode(steps).alias("r")).select("*", F.explode(steps).alias("c"))
    held = image.select(F.col("r").alias("ir"), F.col("c").alias("ic"), "v")
    met = grid.join(held, (F.col("r0") + F.col("r") == F.col("ir")) & (F.col("c0") + F.col("c") == F.col("ic")), "left")
    return met.select("roi", "r", "c", F.coalesce("v", F.lit(0.0)).alias("v"))


def experiment_id(path: Column) -> Column:
    """The number after ``ophys_experiment_`` in a path."""
    return F.nullif(F.regexp_extract(path, r"ophys_experiment_(\d+)", 1), F.lit("")).cast("long")


def region_number(name: Column) -> Column:
    """A region's id as a number, whether it came as a number or as text; else null."""
    return name.cast("string").try_cast("long")


def clipped_frames(shift: DataFrame) -> DataFrame:
    """Frames whose motion was clipped in either direction (t, clipped_x, clipped_y)."""
    return shift.where("clipped_x").select("t").union(shift.where("clipped_y").select("t")).distinct()


def joined_in_time(parts: list[DataFrame]) -> DataFrame:
    """Movies one after the other; each starts where the one before it ends."""
    out = parts[0]
    for part in parts[1:]:
        n = F.broadcast(out.agg(F.coalesce(F.max("t") + 1, F.lit(0)).cast("int").alias("n")))
        out = out.unionByName(part.join(n).withColumn("t", F.col("t") + F.col("n")).drop("n"))
    return out
