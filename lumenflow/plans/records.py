"""Queries of records and files: regions, labels, selections, pages, written and read tables, reports. Each has its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenflow.operators import decrosstalk, graphs, movies, planes, reports, rois, seeding, selection, traces
from lumenflow.plans.recordings import _round
from lumenflow.sources import adapters as views
from lumenflow.sources import files
from lumenflow.sources.scratch import new_folder

QUERIES, SQL = {}, {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = f"WITH {views.SQL}{sql if sql.startswith(',') else ' ' + sql}"
        return f

    return add


def _regions(spark: SparkSession, d: str) -> DataFrame:
    """roi, exclusion_labels: every third region is small, every fifth touches the border."""
    labels = F.array_compact(F.array(F.when(F.col("roi") % 3 == 0, F.lit("small_size")), F.when(F.col("roi") % 5 == 0, F.lit("motion_border"))))
    return views.roi_pixels(spark, d).select("roi").distinct().withColumn("exclusion_labels", labels)


_REGIONS = "(SELECT DISTINCT roi FROM roi_pixels)"
_BOX = "b AS (SELECT roi, min(c) AS x, min(r) AS y, max(c) - min(c) + 1 AS width, max(r) - min(r) + 1 AS height FROM roi_pixels GROUP BY roi)"
_FLAGS = f"""f AS (SELECT b.roi, y + i.r AS r, x + j.c AS c, EXISTS (SELECT 1 FROM roi_pixels p WHERE p.roi = b.roi AND p.r = b.y + i.r AND p.c = b.x + j.c) AS held FROM b, range(3) i(r), range(4) j(c))"""


@_query(f", {_BOX}, {_FLAGS} SELECT b.roi, x, y, width, height, b.roi % 2 = 0 AS valid, string_agg(CASE WHEN held THEN '1' ELSE '0' END, '' ORDER BY r, c) AS mask, 0 AS labels FROM b JOIN f USING (roi) GROUP BY ALL")
def renamed_regions(spark: SparkSession, d: str) -> DataFrame:
    masks = rois.to_dense(views.roi_pixels(spark, d)).withColumnRenamed("mask", "mask_matrix").withColumn("valid_roi", F.col("roi") % 2 == 0)
    flat = F.array_join(F.transform(F.flatten("mask"), lambda x: F.when(x, "1").otherwise("0")), "")
    return rois.renamed(masks).select("roi", "x", "y", "width", "height", "valid", flat.alias("mask"), F.size("exclusion_labels").alias("labels"))


@_query("SELECT roi, r, c, w FROM roi_pixels")
def sparse_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Pixel lists of sparse masks, through a JSON file of them."""
    path = new_folder(spark)
    lists = views.roi_pixels(spark, d).groupBy("roi").agg(F.collect_list(F.struct("r", "c", "w")).alias("p"))
    record = F.struct(F.col("roi"), F.col("p.r").alias("ypix"), F.col("p.c").alias("xpix"), F.col("p.w").alias("lam"))
    lists.agg(F.to_json(F.collect_list(record))).coalesce(1).write.text(path)  # such a file is one array
    return rois.pixel_list(files.sparse_rois(spark, path)).select(F.col("roi").cast("int").alias("roi"), "r", "c", "w")


@_query("SELECT DISTINCT roi, r, c FROM roi_pixels")
def dense_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return rois.from_dense(rois.to_dense(views.roi_pixels(spark, d)))


@_query(f"""SELECT roi, 'empty_roi_mask' AS label FROM {_REGIONS} WHERE roi % 4 = 0
UNION ALL SELECT roi, 'motion_border' FROM roi_pixels WHERE roi % 4 <> 0 GROUP BY roi HAVING min(c) < 3 OR max(c) > 31 - 4 OR min(r) < 1 OR max(r) > (SELECT max(r) FROM movie) - 2""")
def mask_labels(spark: SparkSession, d: str) -> DataFrame:
    pixels = views.roi_pixels(spark, d)
    held = pixels.where("roi % 4 <> 0")
    return rois.mask_problems(held, pixels.select("roi").distinct(), rois.at_border(held, (3, 4, 2, 1), movies.extent(views.movie(spark, d))))


@_query(f"SELECT roi, roi % 3 = 0 OR roi % 5 = 0 AS excluded FROM {_REGIONS}")
def split_regions(spark: SparkSession, d: str) -> DataFrame:
    kept, out = selection.split_by_labels(_regions(spark, d))
    return kept.select("roi", F.lit(False).alias("excluded")).unionAll(out.select("roi", F.lit(True)))


@_query("SELECT roi, t, round(f, 6) AS f FROM trace WHERE roi IN (SELECT roi FROM roi_pixels WHERE roi % 5 <> 0)")
def allowed_traces(spark: SparkSession, d: str) -> DataFrame:
    """Traces of the regions without a barred label."""
    return _round(selection.valid_only(views.trace(spark, d), selection.without_labels(_regions(spark, d), ["motion_border"])))


@_query("SELECT p.place, t.roi, t.t, round(t.f, 6) AS f FROM trace t JOIN (SELECT roi, row_number() OVER (ORDER BY roi DESC) AS place FROM (SELECT DISTINCT roi FROM trace)) p USING (roi)")
def ordered_traces(spark: SparkSession, d: str) -> DataFrame:
    trace = views.trace(spark, d)
    regions = trace.select("roi").distinct().withColumn("place", F.row_number().over(Window.orderBy(F.desc("roi"))).cast("long"))
    return _round(selection.in_region_order(trace, regions))


@_query(f"SELECT roi, CASE WHEN roi % 7 <> 0 THEN roi END AS pa, CASE WHEN roi % 6 <> 0 THEN CASE WHEN roi % 4 = 1 THEN roi + 1 ELSE roi END END AS pb FROM {_REGIONS} WHERE NOT (roi % 7 = 0 AND roi % 6 = 0) AND (roi % 7 = 0 OR roi % 6 = 0 OR roi % 4 = 1)")
def misaligned_regions(spark: SparkSession, d: str) -> DataFrame:
    regions = views.roi_pixels(spark, d).select("roi").distinct()
    one = regions.where("roi % 7 <> 0").select("roi", F.col("roi").alias("place"))
    two = regions.where("roi % 6 <> 0").select("roi", F.when(F.col("roi") % 4 == 1, F.col("roi") + 1).otherwise(F.col("roi")).alias("place"))
    return selection.misaligned(one, two)


@_query("SELECT r, c FROM (SELECT DISTINCT r, c FROM movie UNION SELECT (SELECT max(r) FROM movie), c FROM movie) WHERE sqrt((r - 5.5) ** 2 + (c - 10) ** 2) <= 4.3")
def circle_pixels(spark: SparkSession, d: str) -> DataFrame:
    return graphs.neighbourhood(views.movie(spark, d), 5.5, 10.0, 4.3)


@_query("SELECT r0, c0, r1, c1, CASE WHEN r0 % 3 = 0 THEN CAST(r0 + c0 AS DOUBLE) ELSE CAST(r1 * 100 AS DOUBLE) END AS weight FROM (SELECT DISTINCT a.r AS r0, a.c AS c0, a.r + 1 AS r1, a.c AS c1 FROM movie a WHERE a.r < 6)")
def merged_graphs(spark: SparkSession, d: str) -> DataFrame:
    edges = views.movie(spark, d).where("r < 6").select("r", "c").distinct().select(F.col("r").alias("r0"), F.col("c").alias("c0"), (F.col("r") + 1).alias("r1"), F.col("c").alias("c1"))
    first = edges.withColumn("weight", (F.col("r1") * 100).cast("double"))
    return graphs.merged(first, edges.where("r0 % 3 = 0").withColumn("weight", (F.col("r0") + F.col("c0")).cast("double")), ["weight"])


@_query("SELECT o_orderkey AS point, CAST(arg_min(n, (round(sqrt((px - cx) ** 2 + (py - cy) ** 2), 9), n)) AS INT) AS centre FROM (SELECT o_orderkey, o_orderkey % 97 AS px, o_orderkey % 89 AS py FROM orders), (SELECT n_nationkey AS n, (n_nationkey * 13) % 97 AS cx, (n_nationkey * 29) % 89 AS cy FROM nation) GROUP BY o_orderkey")
def nearest_centres(spark: SparkSession, d: str) -> DataFrame:
    k, n = F.col("o_orderkey"), F.col("n_nationkey")
    points = views._table(spark, d, "orders").select(k.alias("point"), (k % 97).alias("x"), (k % 89).alias("y"))
    centres = views._table(spark, d, "nation").select(n.cast("int").alias("centre"), ((n * 13) % 97).alias("x"), ((n * 29) % 89).alias("y"))
    return selection.nearest_centre(points, centres)


@_query(f"SELECT s AS sigma, t AS sigma_time, CAST(count(*) AS BIGINT) AS n FROM {_REGIONS}, (VALUES (0.5), (1.0), (2.0)) a(s), (VALUES (0), (3)) b(t) WHERE roi % 2 = t % 2 GROUP BY ALL".replace("s AS sigma", "CAST(s AS DOUBLE) AS sigma"))
def settings_grid(spark: SparkSession, d: str) -> DataFrame:
    regions = views.roi_pixels(spark, d).select("roi").distinct()
    grid = selection.parameter_grid({"sigma": [0.5, 1.0, 2.0], "sigma_time": [0, 3]}, regions)
    return regions.join(grid, F.col("roi") % 2 == F.col("sigma_time") % 2).groupBy("sigma", "sigma_time").agg(F.count("*").alias("n"))


@_query("SELECT r, c, round(avg(v), 6) AS v FROM movie WHERE t % 12 = 6 GROUP BY r, c")
def page_series(spark: SparkSession, d: str) -> DataFrame:
    """The mean of the pages of one region and depth, with three regions of four depths taking turns."""
    pages = views.movie(spark, d).withColumnRenamed("t", "page")
    return _round(selection.pages_of(pages, 3, 4, 1, 2).groupBy("r", "c").agg(F.avg("v").alias("v")))


@_query("SELECT r, c, round(avg(v), 6) AS v FROM movie GROUP BY r, c")
def full_field(spark: SparkSession, d: str) -> DataFrame:
    return _round(selection.page_average(views.movie(spark, d).withColumnRenamed("t", "page"), 16, 4))


@_query("SELECT CAST(n_nationkey AS INT) AS place, CAST(n_nationkey * 1.5 AS DOUBLE) AS z, CAST(n_regionkey AS INT) AS region FROM nation")
def depth_manifest(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey").cast("int")
    nations = views._table(spark, d, "nation").select(k.alias("place"), (k * 1.5).alias("z"), F.col("n_regionkey").cast("int").alias("region"))
    return selection.depth_manifest(nations.select("place", "z"), nations.select("region", "z"))


@_query("SELECT CAST(z AS DOUBLE) AS z, CAST(dense_rank() OVER (ORDER BY floor(z)) - 1 AS INT) AS id FROM (SELECT DISTINCT o_orderkey % 50 + CASE WHEN o_orderkey % 3 = 0 THEN 4e-7 ELSE 0 END AS z FROM orders)")
def depth_ids(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return selection.depth_ids(views._table(spark, d, "orders").select((k % 50 + F.when(k % 3 == 0, F.lit(4e-7)).otherwise(F.lit(0.0))).alias("z")))


@_query(f""", {_BOX}, k AS (SELECT *, CAST(round_even(x + width / 2, 0) AS INT) - 4 AS lo, CAST(least(ceil((greatest(width, height) + 4) / 16.0) * 16, 32) AS INT) AS side FROM b)
SELECT roi, greatest(0, lo) AS first, least(32, lo + 8) AS last, greatest(0, -lo) AS before, greatest(0, lo + 8 - 32) AS behind, side, CAST(greatest(0, least(floor(x + width / 2 - side / 2), 32 - side)) AS INT) AS tx, CAST(greatest(0, least(floor(y + height / 2 - side / 2), 16 - side)) AS INT) AS ty FROM k""")
def window_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Cut-outs along one axis, and thumbnails, around each region's box."""
    box = rois.bounds(views.roi_pixels(spark, d))
    cut = selection.cut_out(F.col("x") + F.col("width") / 2, F.lit(32), 8)
    thumb = selection.thumbnail(F.col("x"), F.col("y"), F.col("width"), F.col("height"), 32, 16, 2)
    return box.select("roi", *(c.alias(n) for c, n in zip(cut, ("first", "last", "before", "behind"))), thumb["side"].alias("side"), thumb["x"].alias("tx"), thumb["y"].alias("ty"))


@_query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 1000 END AS experiment, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey END AS region FROM orders")
def ids_from_text(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    path = F.concat(F.lit("/a/"), F.when(k % 3 > 0, F.concat(F.lit("ophys_experiment_"), (k % 1000).cast("string"))).otherwise(F.lit("none")), F.lit("/x.h5"))
    name = F.when(k % 4 > 0, k.cast("string")).otherwise(F.lit("union"))
    return views._table(spark, d, "orders").select(k.alias("k"), selection.experiment_id(path).alias("experiment"), selection.region_number(name).alias("region"))


@_query("SELECT t FROM shift WHERE abs(x) > 30 OR abs(y) > 32")
def clipped_frames(spark: SparkSession, d: str) -> DataFrame:
    return selection.clipped_frames(views.shift(spark, d).select("t", (F.abs("x") > 30).alias("clipped_x"), (F.abs("y") > 32).alias("clipped_y")))


@_query("SELECT r, c, CAST(CASE WHEN t < 10 THEN t WHEN t >= 50 THEN t - 40 END AS INT) AS t, v FROM movie WHERE t < 10 OR t >= 50")
def joined_movies(spark: SparkSession, d: str) -> DataFrame:
    movie = views.movie(spark, d)
    late = movie.where("t >= 50").withColumn("t", F.col("t") - 50)
    return selection.joined_in_time([movie.where("t < 10"), late]).select("r", "c", F.col("t").cast("int").alias("t"), "v")


@_query('SELECT max(y) FILTER (abs(y) <= 30) AS y1, -min(y) FILTER (abs(y) <= 30) AS y0, -min(x) FILTER (abs(x) <= 30) AS x0, max(x) FILTER (abs(x) <= 30) AS x1 FROM shift')
def shared_shift(spark: SparkSession, d: str) -> DataFrame:
    regions = views.roi_pixels(spark, d).select("roi").distinct().join(F.broadcast(rois.motion_border(views.shift(spark, d))))
    return planes.shared_shift(regions).select("y1", "y0", F.col("x0").alias("x1"), F.col("x1").alias("x0"))


@_query(f"SELECT min(roi) AS roi, CAST(min(roi) * 0.25 AS DOUBLE) AS m00 FROM {_REGIONS} WHERE roi % 2 = 1")
def first_open_mixing(spark: SparkSession, d: str) -> DataFrame:
    regions = views.roi_pixels(spark, d).select("roi").distinct()
    return decrosstalk.first_open_mixing(regions.select("roi", (F.col("roi") * 0.25).alias("m00"), (F.col("roi") % 2 == 0).alias("converged")))


@_query("SELECT part, round(mean, 6) AS mean, round(deviation, 6) AS deviation, CAST(n AS INT) AS n FROM (SELECT CASE WHEN t % 4 = 3 THEN 'validation' ELSE 'train' END AS part, count(DISTINCT t) AS n FROM trace GROUP BY 1), (SELECT avg(f) AS mean, stddev_pop(f) AS deviation FROM trace WHERE t % 4 < 3)")
def training_figures(spark: SparkSession, d: str) -> DataFrame:
    trace = views.trace(spark, d)
    parts = trace.select("t", F.when(F.col("t") % 4 == 3, "validation").otherwise("train").alias("part")).distinct()
    return _round(decrosstalk.labelled_frames(parts, trace).select("part", "mean", "deviation", F.size("frames").alias("n")))


@_query("SELECT roi, t, f FROM trace WHERE roi < 8")
def stored_traces(spark: SparkSession, d: str) -> DataFrame:
    """Traces of a few regions out of a written trace file."""
    path = new_folder(spark)
    files.write_traces(views.trace(spark, d), path)
    return files.traces(spark, path).where("roi < 8").select("roi", F.col("t"), "f")


@_query("SELECT roi, t, f FROM trace WHERE roi % 2 = 0 AND f > 80")
def stored_events(spark: SparkSession, d: str) -> DataFrame:
    """The event file of valid regions."""
    path = new_folder(spark)
    trace = views.trace(spark, d)
    files.write_events(trace.where("f > 80"), trace.where("roi % 2 = 0").select("roi").distinct(), path)
    return files.traces(spark, path).select("roi", "t", "f")


@_query("SELECT t, x, y FROM shift WHERE t % 7 = 0")
def stored_motion(spark: SparkSession, d: str) -> DataFrame:
    """Offsets out of a registration CSV."""
    path = new_folder(spark)
    views.shift(spark, d).where("t % 7 = 0").select(F.col("t").alias("framenumber"), "x", "y", F.lit(0.5).alias("correlation")).write.csv(path, header=True)
    return files.motion(spark, path).select(F.col("t").cast("long").alias("t"), "x", "y")


@_query("SELECT DISTINCT CAST(roi AS BIGINT) AS roi, r, c FROM roi_pixels")
def stored_masks(spark: SparkSession, d: str) -> DataFrame:
    """Masks out of JSON records."""
    path = new_folder(spark)
    files.write_masks(views.roi_pixels(spark, d), path)
    back = spark.read.schema(files.ROI).json(path)
    return rois.from_dense(back.select(F.col("id").alias("roi"), "x", "y", "mask"))


@_query("SELECT roi, t, CASE WHEN t % 5 = 0 THEN NULL ELSE f END AS f, CASE WHEN t % 5 = 0 THEN 'nan' WHEN t % 7 = 0 THEN 'inf' END AS odd FROM (SELECT roi, t, CASE WHEN t % 7 = 0 THEN 0 ELSE f END AS f FROM trace)")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Traces with numbers that JSON lacks, as text and back."""
    odd = F.when(F.col("t") % 5 == 0, F.lit(float("nan"))).when(F.col("t") % 7 == 0, F.lit(float("-inf"))).otherwise(F.col("f"))
    back = files.decoded(files.encoded(views.trace(spark, d).select("roi", "t", odd.alias("f"))), "roi long, t int, f double")
    kind = F.when(F.isnan("f"), F.lit("nan")).when(F.col("f") == float("-inf"), F.lit("inf"))
    value = F.when(F.isnan("f"), F.lit(None).cast("double")).when(F.col("f") == float("-inf"), F.lit(0.0)).otherwise(F.col("f"))
    return back.select("roi", "t", value.alias("f"), kind.alias("odd"))


@_query("SELECT 'prod' AS model_name, max(o_orderkey) AS ts, 's3://b/' || max(o_orderkey) AS artifact_location FROM orders WHERE o_orderkey % 3 = 0")
def active_model(spark: SparkSession, d: str) -> DataFrame:
    """The last model that was put into an environment, from a log of all."""
    k = F.col("o_orderkey").cast("long")
    log = views._table(spark, d, "orders").select(F.when(k % 3 == 0, "prod").when(k % 3 == 1, "stage").otherwise("cells").alias("model_name"), k.alias("ts"), F.concat(F.lit("s3://b/"), k.cast("string")).alias("artifact_location"), F.lit("r").alias("run_id"))
    return files.active_model(log, "prod").select("model_name", "ts", "artifact_location")


@_query(", i AS (SELECT r, c, round(max(v), 9) AS v FROM movie GROUP BY r, c) SELECT r, c, v, CASE WHEN k <= floor(0.4 * n) THEN 'never considered' ELSE 'excluded by fraction' END AS status FROM (SELECT *, row_number() OVER (ORDER BY v DESC, r, c) AS k, count(*) OVER () AS n FROM (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY r // 4, c // 4 ORDER BY v DESC, r, c) = 1))")
def seed_log(spark: SparkSession, d: str) -> DataFrame:
    """What became of all seeds before any was handed out."""
    image = movies.projection(views.movie(spark, d)).select("r", "c", F.round("max_v", 9).alias("v"))
    return seeding.Seeds(seeding.image_candidates(image, 0.4, 4)).log().drop("batch")


@_query("SELECT r, c, CAST(t // 6 AS INT) AS t, round(arg_max(v, t), 6) AS v FROM movie GROUP BY ALL")
def binned_movie(spark: SparkSession, d: str) -> DataFrame:
    return _round(reports.binned(views.movie(spark, d), 31, 5, "last"))


@_query(""", q AS (SELECT roi, quantile_cont(w, 0.1) AS q FROM roi_pixels GROUP BY roi), p AS (SELECT roi, r, c, w, CASE WHEN w >= q THEN 1.0 ELSE 0.0 END AS b FROM roi_pixels JOIN q USING (roi)),
s AS (SELECT roi, t, sum(v * w) / count(*) AS weighted, sum(v * b) / sum(b) AS bin FROM movie JOIN p USING (r, c) GROUP BY roi, t)
SELECT n.roi, n.n_weighted, n.n_binary, round(k.correlation, 6) AS correlation FROM (SELECT roi, count(*) AS n_weighted, CAST(sum(b) AS BIGINT) AS n_binary FROM p GROUP BY roi) n LEFT JOIN (SELECT roi, corr(weighted, bin) AS correlation FROM s GROUP BY roi) k USING (roi)""")
def region_report(spark: SparkSession, d: str) -> DataFrame:
    return _round(reports.region_report(views.movie(spark, d), views.roi_pixels(spark, d))[1])


_SIDE = "(SELECT r, c, CAST(t // 4 AS INT) AS t, avg(v) AS v FROM {0} GROUP BY ALL)"


@_query(f""", m AS (SELECT r, c, t, v * v AS v FROM movie), a AS {_SIDE.format("movie")}, b AS {_SIDE.format("m")},
la AS (SELECT quantile_cont(v, 0.1) AS lo, quantile_cont(v, 0.9) AS hi FROM (SELECT avg(v) AS v FROM a GROUP BY r, c)), lb AS (SELECT quantile_cont(v, 0.1) AS lo, quantile_cont(v, 0.9) AS hi FROM (SELECT avg(v) AS v FROM b GROUP BY r, c))
SELECT r, CAST(c AS INT) AS c, t, CAST(round_even((least(greatest(v, lo), hi) - lo) / (hi - lo) * 255, 0) AS INT) AS v FROM a, la UNION ALL SELECT r, CAST(c + 32 AS INT), t, CAST(round_even((least(greatest(v, lo), hi) - lo) / (hi - lo) * 255, 0) AS INT) FROM b, lb""")
def registration_preview(spark: SparkSession, d: str) -> DataFrame:
    movie = views.movie(spark, d)
    return reports.preview(movie, movie.withColumn("v", F.col("v") * F.col("v")), 2.0, 2.0, (0.1, 0.9))


@_query("SELECT count(*) AS frames, max(abs(x)) AS x, max(abs(y)) AS y FROM shift")
def shift_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.shift_summary(views.shift(spark, d))


@_query("SELECT r, c, t, g AS red, g AS green, g AS blue FROM (SELECT r, c, t, CAST(round_even((least(greatest(v, -0.1), 0.2) + 0.1) / (0.2 + 0.1) * 255, 0) AS INT) AS g FROM movie WHERE t = 9)")
def grey_as_rgb(spark: SparkSession, d: str) -> DataFrame:
    return reports.rgb(views.movie(spark, d).where("t = 9"), -0.1, 0.2)


@_query(""", w AS (SELECT k, exp(-k * k / (2 * 1.3 * 1.3)) AS w FROM range(-5, 6) x(k))
SELECT m.r, m.c, CAST(m.t AS BIGINT) AS t, round(sum(w.w * n.v) / (SELECT sum(w) FROM w), 6) AS v FROM movie m, w JOIN movie n ON n.r = m.r AND n.c = m.c AND n.t = least(greatest(m.t + w.k, 0), 63) GROUP BY m.r, m.c, m.t""")
def gaussian_movie(spark: SparkSession, d: str) -> DataFrame:
    """The movie smoothed over time."""
    return _round(reports.filtered_in_time(views.movie(spark, d), 1.3, "gaussian"))


@_query("SELECT r, c, CAST(t AS BIGINT) AS t, round(v - m, 6) AS v FROM movie JOIN (SELECT t, avg(v) AS m FROM movie WHERE r < (SELECT max(r) FROM movie) GROUP BY t) USING (t) WHERE r < (SELECT max(r) FROM movie)")
def filtered_frames(spark: SparkSession, d: str) -> DataFrame:
    """Frames through a rule of one's own: here without their mean."""
    movie = views.movie(spark, d)
    whole = movie.join(movies.extent(movie)).where("r < rows - 1").select("r", "c", "t", "v")
    return _round(reports.filtered_frames(whole, lambda x: x - x.mean(axis=(1, 2), keepdims=True)))


@_query("SELECT roi, CAST(count(*) AS BIGINT) AS n, round(max(f) - min(f), 6) AS span FROM trace GROUP BY roi")
def rule_for_each_trace(spark: SparkSession, d: str) -> DataFrame:
    return _round(reports.each_trace(views.trace(spark, d), lambda x: {"n": len(x), "span": float(x.max() - x.min())}, "n long, span double"))


@_query("SELECT o_orderkey AS k, o_custkey AS experiment, c_name AS name FROM orders JOIN customer ON c_custkey = o_custkey")
def experiment_metadata(spark: SparkSession, d: str) -> DataFrame:
    orders = views._table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("experiment"))
    customers = views._table(spark, d, "customer").select(F.col("c_custkey").alias("experiment"), F.col("c_name").alias("name"))
    return reports.with_metadata(orders, customers)


@_query("SELECT roi, CAST(round_even(min(c) + (max(c) - min(c) + 1) / 2, 0) AS INT) AS middle_x, CAST(round_even(min(r) + (max(r) - min(r) + 1) / 2, 0) AS INT) AS middle_y FROM roi_pixels GROUP BY roi")
def region_middles(spark: SparkSession, d: str) -> DataFrame:
    return rois.centres(views.roi_pixels(spark, d))


@_query("SELECT DISTINCT a.roi AS roi_a, b.roi AS roi_b, a.r, a.c FROM roi_pixels a JOIN roi_pixels b USING (r, c) WHERE a.roi % 3 = 0 AND b.roi % 3 > 0")
def shared_pixels(spark: SparkSession, d: str) -> DataFrame:
    pixels = views.roi_pixels(spark, d)
    return rois.shared_pixels(pixels.where("roi % 3 = 0"), pixels.where("roi % 3 > 0"))


@_query(""", near AS (SELECT DISTINCT roi, r + dr AS r, c + dc AS c FROM roi_pixels, range(-2, 3) a(dr), range(-2, 3) b(dc)),
rim AS (SELECT n.* FROM near n WHERE r BETWEEN 1 AND (SELECT max(r) FROM movie) - 1 AND c BETWEEN 3 AND 31 AND NOT EXISTS (SELECT 1 FROM roi_pixels p WHERE p.r = n.r AND p.c = n.c)),
o AS (SELECT roi, t, avg(v) AS f FROM movie JOIN (SELECT roi, r, c FROM roi_pixels) USING (r, c) GROUP BY roi, t), n AS (SELECT roi, t, avg(v) AS np FROM movie JOIN rim USING (r, c) GROUP BY roi, t)
SELECT roi, t, round(f, 6) AS f, round(np, 6) AS np FROM o FULL JOIN n USING (roi, t)""")
def regions_and_surroundings(spark: SparkSession, d: str) -> DataFrame:
    """Traces of regions and their surroundings in one pass."""
    movie = views.movie(spark, d)
    return _round(traces.regions_and_surroundings(movie, views.roi_pixels(spark, d), 2, movies.extent(movie), (3, 0, 1, 1)))
