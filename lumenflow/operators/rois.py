"""Regions of interest as pixel rows: thresholds, bounds, labels and overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.sources.scratch import written

#: Regions of one mask that a row holds where pairs of masks become pairs of regions.
BLOCK = 1024


def same_masks(pixels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """mask, roi of all regions, and mask, r, c: regions of the same pixels have one mask, named by the least of them, so that what
    depends on the pixels is worked out once for all copies. A region's pixels are one row."""
    whole = written(pixels.groupBy("roi").agg(F.sort_array(F.collect_list(F.struct("r", "c"))).alias("on")))
    named = written(whole.groupBy("on").agg(F.min("roi").alias("mask")))
    return written(whole.join(named, "on").select("mask", "roi")), named.select("mask", F.inline("on"))


def _in_blocks(members: DataFrame, end: str) -> DataFrame:
    """The regions of each mask in rows of about ``BLOCK``: mask_a and rois_a, or those of the other end."""
    parts = members.groupBy("mask").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    dealt = members.join(parts, "mask").groupBy("mask", F.pmod(F.xxhash64("roi"), F.col("parts")).alias("part"))
    return dealt.agg(F.collect_list("roi").alias(f"rois_{end}")).select(F.col("mask").alias(f"mask_{end}"), f"rois_{end}")


def pairs_of_regions(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of masks (mask_a, mask_b and more) as pairs of their regions, roi_a and roi_b beside the rest. Blocks of regions meet and
    are dealt over all tasks before they are spread out, so no key is large and no task holds a mask's regions."""
    met = pairs.join(_in_blocks(a, "a"), "mask_a").join(_in_blocks(b, "b"), "mask_b").repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rest = [c for c in pairs.columns if c not in ("mask_a", "mask_b")]
    one = met.select("mask_a", "mask_b", *rest, "rois_b", F.explode("rois_a").alias("roi_a"))
    return one.select("mask_a", "mask_b", *rest, "roi_a", F.explode("rois_b").alias("roi_b"))


def binarize(pixels: DataFrame, quantile: float = 0.1, threshold: float | None = None) -> DataFrame:
    """Pixels of at least the region's weight quantile (interpolated), or above an absolute threshold."""
    if threshold is not None:
        return pixels.where(F.col("w") > threshold)
    least = pixels.groupBy("roi").agg(F.percentile("w", F.lit(quantile)).alias("least"))
    return pixels.join(least, "roi").where(F.col("w") >= F.col("least")).drop("least")


def bounds(pixels: DataFrame) -> DataFrame:
    """Origin, size, area and centroid of each region."""
    return pixels.groupBy("roi").agg(
        F.min("c").alias("x"), F.min("r").alias("y"), (F.max("c") - F.min("c") + 1).alias("width"), (F.max("r") - F.min("r") + 1).alias("height"),
        F.count("*").alias("area"), F.avg("c").alias("centroid_x"), F.avg("r").alias("centroid_y"),
    )


def middles(box: DataFrame) -> DataFrame:
    """The boxes (roi, x, y, width, height) with middle_x and middle_y, halves to even."""
    at = lambda lo, size: F.rint(F.col(lo) + F.col(size) / 2).cast("int")
    return box.withColumn("middle_x", at("x", "width")).withColumn("middle_y", at("y", "height"))


def centres(pixels: DataFrame) -> DataFrame:
    """roi, middle_x, middle_y of each region's box."""
    return middles(bounds(pixels)).select("roi", "middle_x", "middle_y")


def shared_pixels(a: DataFrame, b: DataFrame) -> DataFrame:
    """roi_a, roi_b, r, c: the pixels that a region of one set has in common with a region of the other."""
    one, two = (x.select(F.col("roi").alias(n), "r", "c").distinct() for x, n in ((a, "roi_a"), (b, "roi_b")))
    return one.join(two, ["r", "c"]).select("roi_a", "roi_b", "r", "c")


def keep_round(pixels: DataFrame, least_aspect: float = 0.2) -> DataFrame:
    """Regions that aren't too long in one direction."""
    box = bounds(pixels)
    ratio = F.least(F.col("height") / F.col("width"), F.col("width") / F.col("height"))
    return pixels.join(box.where(ratio > least_aspect).select("roi"), "roi", "left_semi")


def exclusion_labels(pixels: DataFrame, border: dict[str, float], extent: DataFrame, least_pixels: int) -> DataFrame:
    """roi, exclusion_labels and valid: outside the frame left by motion, or too small."""
    box = bounds(pixels).join(extent)
    inside = (
        (F.col("x") >= F.ceil(F.lit(border["right"]))) & (F.col("x") + F.col("width") <= F.floor(F.col("columns") - border["left"]))
        & (F.col("y") >= F.ceil(F.lit(border["down"]))) & (F.col("y") + F.col("height") <= F.floor(F.col("rows") - border["up"]))
    )
    labels = F.array_compact(F.array(F.when(~inside, F.lit("motion_border")), F.when(F.col("area") <= least_pixels, F.lit("small_size"))))
    return box.select("roi", labels.alias("exclusion_labels"), (F.size(labels) == 0).alias("valid"))


def overlaps(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of regions that share pixels: how many, and their share of either. Masks are compared, and pairs of masks spread to regions."""
    (own, shapes), (other, shapes_b) = same_masks(a), same_masks(b)
    area = lambda x, end: x.groupBy("mask").agg(F.count("*").alias(f"n_{end}")).withColumnRenamed("mask", f"mask_{end}")
    shared = shapes.withColumnRenamed("mask", "mask_a").join(shapes_b.withColumnRenamed("mask", "mask_b"), ["r", "c"]).groupBy("mask_a", "mask_b").agg(F.count("*").alias("n"))
    sized = shared.join(area(shapes, "a"), "mask_a").join(area(shapes_b, "b"), "mask_b")
    pairs = sized.select("mask_a", "mask_b", "n", (F.col("n") / F.col("n_a")).alias("share_a"), (F.col("n") / F.col("n_b")).alias("share_b"))
    return pairs_of_regions(pairs, own, other).select("roi_a", "roi_b", "n", "share_a", "share_b")


def abutting(pixels: DataFrame, distance: float = 2**0.5) -> DataFrame:
    """Pairs of regions with two pixels within the distance: roi_a < roi_b. An equi-join on shifted pixels of the masks."""
    reach = int(distance)
    steps = [(dr, dc) for dr in range(-reach, reach + 1) for dc in range(-reach, reach + 1) if dr * dr + dc * dc <= distance * distance + 1e-9]
    members, shapes = same_masks(pixels)
    moved = shapes.select(F.col("mask").alias("mask_a"), "r", "c", F.explode(F.array(*[F.struct(F.lit(x).alias("dr"), F.lit(y).alias("dc")) for x, y in steps])).alias("s"))
    moved = moved.select("mask_a", (F.col("r") + F.col("s.dr")).alias("r"), (F.col("c") + F.col("s.dc")).alias("c"))
    near = moved.join(shapes.select(F.col("mask").alias("mask_b"), "r", "c"), ["r", "c"]).where("mask_a <= mask_b").select("mask_a", "mask_b").distinct()
    # of one mask each pair is met from both sides, of two masks once
    met = pairs_of_regions(near, members, members).where("mask_a < mask_b or roi_a < roi_b")
    return met.select(F.least("roi_a", "roi_b").alias("roi_a"), F.greatest("roi_a", "roi_b").alias("roi_b"))


def motion_border(shift: DataFrame, most: float = 30.0) -> DataFrame:
    """Largest shifts in each direction, outliers beyond ``most`` left out, and the border they leave. NaN is an error."""
    gap = F.coalesce(F.max(F.isnan(F.col("x").cast("double")) | F.isnan(F.col("y").cast("double"))), F.lit(False))
    refuse = F.raise_error(F.lit("a shift is NaN")).cast("double")
    ok = shift.agg(gap.alias("gap"), *(f(F.when(F.abs(c) <= most, F.col(c))).alias(n) for f, c, n in ((F.max, "x", "hi_x"), (F.min, "x", "lo_x"), (F.max, "y", "hi_y"), (F.min, "y", "lo_y"))))
    up = lambda c: F.greatest(c, F.lit(0.0))
    ok = ok.withColumn("hi_x", F.when(F.col("gap"), refuse).otherwise(F.col("hi_x")))
    return ok.select(F.col("hi_x").alias("left"), (-F.col("lo_x")).alias("right"), F.col("hi_y").alias("up"), (-F.col("lo_y")).alias("down"), up(F.col("hi_y")).alias("bottom"), up(-F.col("lo_y")).alias("top"), up(-F.col("lo_x")).alias("left_side"), up(F.col("hi_x")).alias("right_side"))


def pixel_list(masks: DataFrame) -> DataFrame:
    """roi, r, c, w of sparse masks (roi, ypix, xpix, lam: arrays of one length)."""
    both = masks.select("roi", F.explode(F.arrays_zip("ypix", "xpix", "lam")).alias("p"))
    return both.select("roi", F.col("p.ypix").alias("r"), F.col("p.xpix").alias("c"), F.col("p.lam").cast("double").alias("w"))


def from_dense(masks: DataFrame) -> DataFrame:
    """roi, r, c of cropped masks (roi, x, y, mask: rows of flags), in places of the frame."""
    rows = masks.select("roi", "x", "y", F.posexplode("mask").alias("dr", "line"))
    return rows.select("roi", "x", "y", "dr", F.posexplode("line").alias("dc", "on")).where(F.col("on").cast("boolean")).select("roi", (F.col("y") + F.col("dr")).alias("r"), (F.col("x") + F.col("dc")).alias("c"))


def to_dense(pixels: DataFrame) -> DataFrame:
    """roi, x, y, width, height and mask (rows of flags) cropped to each region's box. A region's pixels are one row."""
    boxed = pixels.groupBy("roi").agg(F.min("c").alias("x"), F.min("r").alias("y"), F.max("c").alias("x1"), F.max("r").alias("y1"), F.collect_set(F.struct("r", "c")).alias("on"))
    mask = F.transform(F.sequence("y", "y1"), lambda r: F.transform(F.sequence(F.col("x"), F.col("x1")), lambda c: F.array_contains("on", F.struct(r.alias("r"), c.alias("c")))))
    return boxed.select("roi", "x", "y", (F.col("x1") - F.col("x") + 1).alias("width"), (F.col("y1") - F.col("y") + 1).alias("height"), mask.alias("mask"))


def renamed(masks: DataFrame) -> DataFrame:
    """Region records under the names of the extraction step: id, x, y, width, height, mask, valid, exclusion_labels."""
    old = {"mask_matrix": "mask", "valid_roi": "valid", "cell_specimen_id": "specimen"}
    out = masks.withColumnsRenamed({k: v for k, v in old.items() if k in masks.columns})
    return out if "exclusion_labels" in out.columns else out.withColumn("exclusion_labels", F.array().cast("array<string>"))


def mask_problems(pixels: DataFrame, regions: DataFrame, flagged: DataFrame, group: str = "roi") -> DataFrame:
    """roi, label: regions without pixels, and those flagged at the border."""
    empty = regions.select("roi").join(pixels.select("roi").distinct(), "roi", "left_anti").withColumn("label", F.lit(f"empty_{group}_mask"))
    return empty.unionByName(flagged.where("at_border").select("roi", F.lit("motion_border").alias("label")))


def at_border(pixels: DataFrame, border: tuple[float, float, float, float], extent: DataFrame) -> DataFrame:
    """roi, at_border: the box leaves the frame less its border (left, right, bottom, top). Nothing is cut off."""
    left, right, bottom, top = border
    box = bounds(pixels).join(extent)
    out = (F.col("x") < F.ceil(F.lit(float(left)))) | (F.col("x") + F.col("width") - 1 > F.floor(F.col("columns") - right) - 1)
    out = out | (F.col("y") < F.ceil(F.lit(float(top)))) | (F.col("y") + F.col("height") - 1 > F.floor(F.col("rows") - bottom) - 1)
    return box.select("roi", out.alias("at_border"))


def overlap_groups(pixels: DataFrame) -> DataFrame:
    """roi, other: regions that share pixels with a region, or with one that does (itself included). Masks are compared, and the pairs
    of masks spread to their regions."""
    members, shapes = same_masks(pixels.select("roi", "r", "c").distinct())
    near = written(shapes.join(shapes.withColumnRenamed("mask", "mid"), ["r", "c"]).select("mask", "mid").distinct())
    pairs = near.select(F.col("mask").alias("mask_a"), "mid").join(near.select(F.col("mask").alias("mask_b"), "mid"), "mid").select("mask_a", "mask_b").distinct()
    return pairs_of_regions(pairs, members, members).select(F.col("roi_a").alias("roi"), F.col("roi_b").alias("other"))


def overlapping(pixels: DataFrame, chosen: DataFrame) -> DataFrame:
    """roi: the regions that share pixels with one of ``chosen`` (roi), or with one that does. No pairs are made."""
    mask, out = pixels.select("roi", "r", "c").distinct(), chosen.select("roi").distinct()
    for _ in range(2):
        lit = mask.join(out, "roi", "left_semi").select("r", "c").distinct()
        out = mask.join(lit, ["r", "c"], "left_semi").select("roi").distinct()
    return out


def in_label_order(regions: DataFrame) -> DataFrame:
    """Regions by their label as text."""
    return regions.orderBy(F.col("roi").cast("string"))


def postprocessed(pixels: DataFrame, shift: DataFrame, extent: DataFrame, least_aspect: float = 0.2, quantile: float = 0.1, most_shift: float = 30.0, least_pixels: int = 50) -> DataFrame:
    """roi, exclusion_labels, valid: elongated regions go, weights are cut, then labels by motion border and size."""
    kept = binarize(keep_round(pixels, least_aspect), quantile)
    b = motion_border(shift, most_shift).first()  # one row
    return exclusion_labels(kept, {k: b[k] for k in ("left", "right", "up", "down")}, extent, least_pixels)


def colours(pixels: DataFrame, distance: float = 2**0.5) -> DataFrame:
    """roi, colour: touching regions differ. A region takes its colour when no uncoloured neighbour has more neighbours (then
    the lesser id), the least that none of its coloured neighbours has; rounds run in Spark, and what each gives is
    written, so that no lineage grows."""
    pairs = abutting(pixels, distance)
    near = written(pairs.union(pairs.select("roi_b", "roi_a")).select(F.col("roi_a").alias("roi"), F.col("roi_b").alias("other")))
    degree = pixels.select("roi").distinct().join(near.groupBy("roi").agg(F.count("*").alias("n")), "roi", "left").select("roi", F.coalesce("n", F.lit(0)).alias("n"))
    degree = written(degree)
    done = degree.sparkSession.createDataFrame([], "roi int, colour int")
    while True:
        left = degree.join(done, "roi", "left_anti")
        if left.isEmpty():
            return done
        rivals = near.join(left.select(F.col("roi").alias("other"), F.col("n").alias("m")), "other").groupBy("roi").agg(F.max(F.struct("m", (-F.col("other")).alias("id"))).alias("top"))
        ready = left.join(rivals, "roi", "left").where(F.col("top").isNull() | (F.struct(F.col("n").alias("m"), (-F.col("roi")).alias("id")) > F.col("top"))).select("roi")
        used = near.join(done.select(F.col("roi").alias("other"), "colour"), "other").groupBy("roi").agg(F.collect_set("colour").alias("used"))
        free = F.array_min(F.array_except(F.sequence(F.lit(0), F.size(F.coalesce("used", F.array().cast("array<int>")))), F.coalesce("used", F.array().cast("array<int>"))))
        done = written(done.unionByName(ready.join(used, "roi", "left").select("roi", free.alias("colour"))))
