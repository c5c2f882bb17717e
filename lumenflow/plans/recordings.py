"""Queries of whole processing steps of a recording, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.operators import artifacts, denoise, dewarp, plane_jobs, registration, resampling, seeding, splitting
from lumenflow.operators.movies import extent, projection
from lumenflow.sources import adapters as views
from lumenflow.sources import movies as files
from lumenflow.sources import tiff
from lumenflow.sources.scratch import new_folder

QUERIES, SQL = {}, {}


def _query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"WITH {'RECURSIVE ' if 'RECURSIVE' in sql else ''}{views.SQL}{sql.replace('RECURSIVE', '') if sql.startswith(',') else ' ' + sql}"
        return f

    return add


def _round(df: DataFrame) -> DataFrame:
    """Doubles to 6 places: sums depend on their order."""
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _drifting(spark: SparkSession, d: str) -> DataFrame:
    """The movie's first frame, wandering by up to two pixels, under a share of each frame's own values."""
    movie = views.movie(spark, d)
    first = movie.where("t = 0").select(F.col("r").alias("r0"), F.col("c").alias("c0"), F.col("v").alias("still"))
    at = movie.join(extent(movie)).withColumn("r0", F.pmod(F.col("r") - ((F.col("t") * 53) % 5 - 2), "rows")).withColumn("c0", F.pmod(F.col("c") - ((F.col("t") * 37) % 5 - 2), "columns"))
    return at.join(first, ["r0", "c0"]).select("r", "c", "t", (F.col("still") + 0.25 * F.col("v")).alias("v"))


@_query("SELECT DISTINCT t, CAST((t * 53) % 5 AS INT) AS dy, CAST((t * 37) % 5 AS INT) AS dx FROM movie")
def registered_shifts(spark: SparkSession, d: str) -> DataFrame:
    """Shifts that registration finds in a drifting movie, against that of the first frame; the SQL states those that were put in."""
    shifts = registration.register(_drifting(spark, d), registration.Settings(most=0.4, sigma=0.5))
    start = F.broadcast(shifts.where("t = 0").select(F.col("dy").alias("dy0"), F.col("dx").alias("dx0")))
    return shifts.join(start).select(F.col("t").cast("int").alias("t"), (F.col("dy") - F.col("dy0")).alias("dy"), (F.col("dx") - F.col("dx0")).alias("dx"))


_BRIGHT = "SELECT r, c, t, floor((v + 1) * 1000) AS v FROM movie"
_WARPED = """, m AS (BRIGHT),
side AS (SELECT * FROM (VALUES ('l', 10.0, 4.5), ('r', 8.0, 3.0)) s(side, a, b)),
x AS (SELECT side, CAST(j AS INT) AS j, a, CASE WHEN j < a THEN j - trunc(b * (1.0 - sin((j / (a * 3.0) + 1.0 / 6.0) * 3.14159265)) + 0.5) ELSE 0 END AS x,
  CASE WHEN j < a THEN j + 0.5 - b * (1.0 - sin(((j + 0.5) / (a * 3.0) + 1.0 / 6.0) * 3.14159265)) ELSE 0 END AS hi FROM (SELECT side, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b FROM side), range(16) r(j)),
y AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY side ORDER BY j), 0) AS lo, lead(hi) OVER (PARTITION BY side ORDER BY j) AS after FROM x),
g AS (SELECT side, min(j) AS margin, arg_min(after - hi, j) AS gain FROM y WHERE x >= 0 AND hi >= 0 GROUP BY side),
e AS (SELECT side, j, margin, CASE WHEN NOISE > 0 THEN 1 ELSE gain END AS gain, x, lo, hi, floor(lo) AS s, floor(hi) AS e FROM y JOIN g USING (side) WHERE j < a),
parts AS (SELECT side, j, s AS i, s + 1 - lo AS w FROM e WHERE x >= 0 AND lo >= 0 UNION ALL SELECT side, j, e, hi - e FROM e WHERE x >= 0 AND lo >= 0
  UNION ALL SELECT side, j, s + 1, 1 FROM e WHERE x >= 0 AND lo >= 0 AND e - s > 1 UNION ALL SELECT side, j, x, gain FROM e WHERE x >= 0 AND lo < 0 UNION ALL SELECT side, j, j, 0 FROM e WHERE x < 0),
fig AS (SELECT r, c, CAST(trunc(avg(v)) AS BIGINT) AS level, CAST(trunc(stddev_pop(v) FILTER (t % 8 = 0)) AS BIGINT) AS dev FROM m GROUP BY r, c),
cm AS (SELECT c, arg_min(level, (-n, level)) AS level FROM (SELECT c, level, count(*) AS n FROM fig GROUP BY c, level) GROUP BY c),
cd AS (SELECT c, arg_min(dev, (-n, dev)) AS dev FROM (SELECT c, dev, count(*) AS n FROM fig GROUP BY c, dev) GROUP BY c),
rows AS (SELECT r, level, dev FROM (SELECT DISTINCT r FROM m) d JOIN cm ON cm.c = d.r % 32 JOIN cd ON cd.c = d.r % 32),
edge AS (SELECT m.r, m.t, p.side, p.j, sum(p.w * m.v) AS v FROM m JOIN parts p ON m.c = CASE p.side WHEN 'l' THEN p.i ELSE 31 - p.i END GROUP BY ALL),
val AS (SELECT f.r, f.t, e.side, e.j, e.margin, CASE WHEN x < 0 THEN level * gain WHEN lo < 0 THEN v ELSE least(greatest(
    CASE NOISE WHEN 1 THEN v - 2 * dev * (hi - lo - 1) WHEN 2 THEN v / (hi - lo) - dev * (hi - lo - 1) WHEN 3 THEN v / (hi - lo) ELSE v END, 0), 65535) END AS v
  FROM (SELECT DISTINCT r, t FROM m) f CROSS JOIN e JOIN rows USING (r) JOIN edge ON edge.r = f.r AND edge.t = f.t AND edge.side = e.side AND edge.j = e.j),
whole AS (SELECT r, CASE side WHEN 'l' THEN j ELSE 31 - j END AS c, t, v FROM val WHERE j >= margin UNION ALL SELECT r, c, t, v FROM m WHERE c BETWEEN 10 AND 23)
SELECT r, CAST(c - (SELECT margin FROM g WHERE side = 'l') AS INT) AS c, t, CAST(floor(round(v, 9)) AS INT) AS v FROM whole""".replace("BRIGHT", _BRIGHT)


def _dewarped(spark: SparkSession, d: str, noise: int) -> DataFrame:
    movie = views.movie(spark, d).withColumn("v", F.floor((F.col("v") + 1) * 1000).cast("double"))
    return dewarp.dewarped(movie, (10.0, 4.5), (8.0, 3.0), noise, views.WIDTH)


@_query(_WARPED.replace("NOISE", "0"))
def dewarped_movie(spark: SparkSession, d: str) -> DataFrame:
    return _dewarped(spark, d, 0)


@_query(_WARPED.replace("NOISE", "1"))
def dewarped_less_noise(spark: SparkSession, d: str) -> DataFrame:
    return _dewarped(spark, d, 1)


@_query(_WARPED.replace("NOISE", "2"))
def dewarped_scaled_less_noise(spark: SparkSession, d: str) -> DataFrame:
    return _dewarped(spark, d, 2)


@_query(_WARPED.replace("NOISE", "3"))
def dewarped_scaled(spark: SparkSession, d: str) -> DataFrame:
    return _dewarped(spark, d, 3)


@_query("SELECT r, c, t, v FROM movie WHERE t >= 20 AND t < 45 AND r BETWEEN 3 AND 10 AND c BETWEEN 5 AND 19")
def stored_window(spark: SparkSession, d: str) -> DataFrame:
    """A window of the movie, from a copy in blocks of frames and tiles."""
    path = new_folder(spark)
    files.write_movie(views.movie(spark, d), path, block=16, tile=8)
    return files.read_movie(spark, path, t=(20, 45), r=(3, 11), c=(5, 20))


@_query("SELECT m.r, m.c, m.t, m.v FROM movie m, (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM roi_pixels WHERE roi = 3) b WHERE m.r BETWEEN r0 - 1 AND r1 + 1 AND m.c BETWEEN c0 - 1 AND c1 + 1")
def stored_region(spark: SparkSession, d: str) -> DataFrame:
    """What the movie shows around a region, from a copy in blocks and tiles."""
    path = new_folder(spark)
    files.write_movie(views.movie(spark, d), path, block=64, tile=4)
    return files.read_region(spark, path, views.roi_pixels(spark, d).where("roi = 3"), 1)


def _two_planes(spark: SparkSession, d: str) -> DataFrame:
    """Four channels of each region: its trace, mixed with that of the next region, and slower ones around it."""
    trace = views.trace(spark, d)
    other = trace.select((F.col("roi") + 1).alias("roi"), "t", F.col("f").alias("g"))
    both = trace.join(other, ["roi", "t"])
    return both.select("roi", "t", (0.9 * F.col("f") + 0.1 * F.col("g")).alias("signal"), (0.2 * F.col("f") + 0.8 * F.col("g")).alias("crosstalk"), (F.col("f") * 0.5 + 20).alias("np_signal"), F.when(F.col("roi") % 10 != 0, F.col("g") * 0.3 + 10).alias("np_crosstalk"))


@_query(None)
def decrosstalk_flags(spark: SparkSession, d: str) -> DataFrame:
    """The lists of the decrosstalk job as flags of each region."""
    pairs = _two_planes(spark, d)
    rules = plane_jobs.Rules(threshold=3.0, spread=2, clip_size=50, fits=2)
    job = plane_jobs.take_out_crosstalk(pairs, new_folder(spark), rules)
    return plane_jobs.without_crosstalk(job, pairs.select("roi").distinct())[1]


@_query(""", u AS (SELECT DISTINCT user_id AS roi FROM events), w AS (SELECT a.roi FROM trace a JOIN trace b ON a.roi = b.roi + 1 AND a.t = b.t GROUP BY a.roi)
SELECT roi, roi % 10 = 0 AS failed FROM w""")
def decrosstalk_raw_failures(spark: SparkSession, d: str) -> DataFrame:
    """Which regions have gaps in their raw channels, by the decrosstalk job's first table."""
    raw = plane_jobs._marked(_two_planes(spark, d))
    return raw.groupBy("roi").agg((~F.first("valid")).alias("failed"))


@_query(None)
def demixing_job(spark: SparkSession, d: str) -> DataFrame:
    """Traces of all regions after demixing."""
    pixels = views.roi_pixels(spark, d)
    labels = pixels.select("roi").distinct().select("roi", F.when(F.col("roi") % 3 == 0, F.array(F.lit("union"))).otherwise(F.array().cast("array<string>")).alias("exclusion_labels"))
    movie = views.movie(spark, d).withColumn("v", F.col("v") + 1)
    return _round(plane_jobs.demix_job(movie, pixels, labels, new_folder(spark), ["union", "duplicate"], 20).traces)


@_query("SELECT DISTINCT CAST(roi AS BIGINT) AS roi FROM roi_pixels WHERE roi % 3 = 0")
def demixing_excluded(spark: SparkSession, d: str) -> DataFrame:
    """Regions that the demixing job leaves out by their labels."""
    pixels = views.roi_pixels(spark, d)
    labels = pixels.select("roi").distinct().select("roi", F.when(F.col("roi") % 3 == 0, F.array(F.lit("union"))).otherwise(F.array().cast("array<string>")).alias("exclusion_labels"))
    movie = views.movie(spark, d).withColumn("v", F.col("v") + 1)
    return plane_jobs.demix_job(movie, pixels, labels, new_folder(spark), ["union", "duplicate"], 20).listed.where("reason = 'excluded'").select("roi")


_FILTER = """, hraw AS (SELECT j, x, CASE WHEN x = 0 THEN 1.0 ELSE sin(pi() * x / 31) / (pi() * x / 31) END / 31 * list_sum(list_transform(range(40), lambda m: pow(6.25 * (1 - (x / 310.0) ** 2), m) / pow(gamma(m + 1), 2))) AS h FROM (SELECT CAST(j AS INT) AS j, CAST(j - 310 AS DOUBLE) AS x FROM range(621) r(j))),
h AS (SELECT j, h / (SELECT sum(h) FROM hraw) * 4 AS h FROM hraw), tr AS (SELECT *, count(*) OVER (PARTITION BY roi) AS n, median(f) OVER (PARTITION BY roi) AS m FROM trace),
k AS (SELECT roi, n, m, unnest(range(CAST(ceil(n * 4 / 31.0) AS BIGINT))) AS k FROM (SELECT DISTINCT roi, n, m FROM tr))"""


@_query(_FILTER + " SELECT k.roi, k.k AS t, round(any_value(k.m) + sum(h.h * (tr.f - tr.m)), 6) AS f FROM k JOIN tr ON tr.roi = k.roi AND abs(k.k * 31 - tr.t * 4) <= 310 JOIN h ON h.j = k.k * 31 - tr.t * 4 + 310 GROUP BY k.roi, k.k")
def resampled_traces(spark: SparkSession, d: str) -> DataFrame:
    """Traces of 31 Hz at 4 Hz."""
    return _round(resampling.resampled(views.trace(spark, d), 31, 4))


def _bright(spark: SparkSession, d: str) -> DataFrame:
    """The movie's maximum as an image."""
    return projection(views.movie(spark, d)).select("r", "c", F.round("max_v", 9).alias("v"))


_CANDIDATES = """, img AS (SELECT r, c, round(max(v), 9) AS v FROM movie GROUP BY r, c),
best AS (SELECT * FROM img QUALIFY row_number() OVER (PARTITION BY r // 4, c // 4 ORDER BY v DESC, r, c) = 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY v DESC, r, c) AS k, count(*) OVER () AS n FROM best)"""


@_query(_CANDIDATES + " SELECT r, c, v, k <= floor(0.4 * n) AS kept FROM ranked")
def seed_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The brightest pixel of each block, and whether it is among the brightest share of them."""
    return seeding.image_candidates(_bright(spark, d), 0.4, 4)


@_query(_CANDIDATES + """, queue AS (SELECT * FROM ranked WHERE k <= floor(0.4 * n)),
s RECURSIVE AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(r INT, c INT, b BIGINT)[]) AS l
  UNION ALL SELECT q.k, list_append(l, {'r': q.r, 'c': q.c, 'b': list_min(list_filter(range(0, q.k), lambda b: len(list_filter(l, lambda e: e.b = b)) < 10 AND len(list_filter(l, lambda e: e.b = b AND (e.r - q.r) ** 2 + (e.c - q.c) ** 2 < 81)) = 0))})
  FROM s JOIN queue q ON q.k = s.k + 1),
whole AS (SELECT unnest(l, recursive := true) FROM (SELECT l FROM s ORDER BY k DESC LIMIT 1))
SELECT CAST(b AS INT) AS batch, r, c FROM whole""")
def seed_batches(spark: SparkSession, d: str) -> DataFrame:
    """All kept seeds in batches of ten at least nine pixels apart; the SQL puts each in the first batch that has room for it."""
    candidates = seeding.image_candidates(_bright(spark, d), 0.4, 4).where("kept")
    none = candidates.select("r", "c").where("false")
    return seeding.seed_batches(candidates, none, 10, 9.0).select("batch", "r", "c")


@_query(None)
def pca_denoised(spark: SparkSession, d: str) -> DataFrame:
    """The movie from its five strongest components."""
    return _round(denoise.denoised(views.movie(spark, d), 5))


@_query("SELECT r, c, round(avg(v), 6) AS mean FROM movie GROUP BY r, c")
def pca_means(spark: SparkSession, d: str) -> DataFrame:
    """What denoising leaves as it is: each pixel's mean."""
    return _round(denoise.denoised(views.movie(spark, d), 5).groupBy("r", "c").agg(F.avg("v").alias("mean")))


@_query("SELECT CAST(t % 3 AS INT) AS place, r, c, round(avg(v), 6) AS v FROM movie WHERE r < (SELECT max(r) FROM movie) GROUP BY ALL")
def plane_averages(spark: SparkSession, d: str) -> DataFrame:
    """The mean image of each of three planes whose pages follow each other in turn."""
    movie = views.movie(spark, d).join(extent(views.movie(spark, d))).where("r < rows - 1").select("r", "c", "t", "v")
    pages = registration.packed_frames(movie).select(F.col("t").alias("page"), "rows", "columns", F.lit("<f8").alias("kind"), "pixels")
    return _round(tiff.pixels(splitting.by_plane(pages, 3)).groupBy("place", "r", "c").agg(F.avg("v").alias("v")))


@_query(""", b AS (SELECT roi, CAST(round_even(min(r) + (max(r) - min(r) + 1) / 2, 0) AS INT) - 4 AS r0, CAST(round_even(min(c) + (max(c) - min(c) + 1) / 2, 0) AS INT) - 4 AS c0 FROM roi_pixels GROUP BY roi),
img AS (SELECT 'max' AS image, r, c, CAST(floor((max(v) + 1) * 100) AS INT) AS v FROM movie GROUP BY r, c UNION ALL SELECT 'avg', r, c, CAST(floor(round((avg(v) + 1) * 1000, 6)) AS INT) FROM movie GROUP BY r, c),
g AS (SELECT roi, r0, c0, image, CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM b, (VALUES ('max'), ('avg'), ('mask')) n(image), range(8) x(r), range(8) y(c))
SELECT g.roi, g.image, g.r, g.c, CASE WHEN g.image = 'mask' THEN CASE WHEN p.roi IS NULL THEN 0 ELSE 255 END ELSE coalesce(i.v, 0) END AS v FROM g
  LEFT JOIN img i ON i.image = g.image AND i.r = g.r0 + g.r AND i.c = g.c0 + g.c LEFT JOIN (SELECT DISTINCT roi, r, c FROM roi_pixels) p ON p.roi = g.roi AND p.r = g.r0 + g.r AND p.c = g.c0 + g.c""")
def region_cut_outs(spark: SparkSession, d: str) -> DataFrame:
    """Windows of two images and of the mask around each region."""
    both = projection(views.movie(spark, d))
    layers = {"max": both.select("r", "c", F.floor((F.col("max_v") + 1) * 100).alias("v")), "avg": both.select("r", "c", F.floor(F.round((F.col("avg_v") + 1) * 1000, 6)).alias("v"))}
    return artifacts.cut_outs(layers, views.roi_pixels(spark, d), 8)


@_query("SELECT r, c, CAST(round_even((least(greatest(v, lo), hi) - lo) / (hi - lo) * 255, 0) AS INT) AS v FROM (SELECT r, c, max(v) AS v FROM movie GROUP BY r, c), (SELECT quantile_cont(v, 0.2) AS lo, quantile_cont(v, 0.99) AS hi FROM (SELECT max(v) AS v FROM movie GROUP BY r, c))")
def scaled_projection(spark: SparkSession, d: str) -> DataFrame:
    """The movie's maximum as an image of 0 to 255."""
    return artifacts.scaled_image(projection(views.movie(spark, d)).select("r", "c", F.col("max_v").alias("v")), (0.2, 0.99))
