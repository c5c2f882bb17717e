"""Queries of the imaging operators on the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.functions.scalars import unmix
from lumenflow.operators import analysis, checks, decrosstalk, graphs, images, movies, planes, rois, selection, signals, traces
from lumenflow.sources import adapters as views

QUERIES, SQL = {}, {}
#: The frame of 500 vectors, for closed_and_opened and its SQL; the other queries take the movie's own.
_ROWS, _COLUMNS, _REACH = 16, 32, 3


def _query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            # a recursive table is marked as one; the mark belongs in front of the first
            head = "RECURSIVE " if "RECURSIVE" in sql else ""
            SQL[f.__name__] = f"WITH {head}{views.SQL}{sql.replace('RECURSIVE ', '') if sql.startswith(',') else ' ' + sql}"
        return f

    return add


def _round(df: DataFrame) -> DataFrame:
    """Doubles to 6 places: sums depend on their order."""
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@_query("SELECT roi, t, round(avg(v), 6) AS f FROM movie JOIN roi_pixels USING (r, c) GROUP BY ALL")
def roi_trace(spark: SparkSession, d: str) -> DataFrame:
    return _round(traces.masked_mean(views.movie(spark, d), views.roi_pixels(spark, d)))


@_query("SELECT roi, t, round(sum(v * w) / count(*), 6) AS f FROM movie JOIN roi_pixels USING (r, c) GROUP BY ALL")
def weighted_roi_trace(spark: SparkSession, d: str) -> DataFrame:
    return _round(traces.weighted_trace(views.movie(spark, d), views.roi_pixels(spark, d)))


_NEAR = f"""SELECT DISTINCT roi, r + dr AS r, c + dc AS c FROM roi_pixels, range(-{_REACH}, {_REACH + 1}) a(dr), range(-{_REACH}, {_REACH + 1}) b(dc)
  WHERE r + dr BETWEEN 0 AND (SELECT max(r) FROM movie) AND c + dc BETWEEN 0 AND (SELECT max(c) FROM movie)"""


@_query(f"SELECT n.* FROM ({_NEAR}) n ANTI JOIN roi_pixels p ON n.r = p.r AND n.c = p.c")
def neuropil_mask(spark: SparkSession, d: str) -> DataFrame:
    return traces.neuropil_mask(views.roi_pixels(spark, d), _REACH, movies.extent(views.movie(spark, d)))


@_query(f"SELECT roi, t, round(avg(v), 6) AS f FROM movie JOIN (SELECT n.* FROM ({_NEAR}) n ANTI JOIN roi_pixels p ON n.r = p.r AND n.c = p.c) USING (r, c) GROUP BY ALL")
def neuropil_trace(spark: SparkSession, d: str) -> DataFrame:
    return _round(traces.masked_mean(views.movie(spark, d), traces.neuropil_mask(views.roi_pixels(spark, d), _REACH, movies.extent(views.movie(spark, d)))))


@_query("SELECT p.* FROM roi_pixels p JOIN (SELECT roi, quantile_cont(w, 0.1) AS q FROM roi_pixels GROUP BY roi) USING (roi) WHERE w >= q")
def binarized_rois(spark: SparkSession, d: str) -> DataFrame:
    return rois.binarize(views.roi_pixels(spark, d))


_BOUNDS = "SELECT roi, min(c) AS x, min(r) AS y, max(c) - min(c) + 1 AS width, max(r) - min(r) + 1 AS height, count(*) AS area, round(avg(c), 6) AS centroid_x, round(avg(r), 6) AS centroid_y FROM roi_pixels GROUP BY roi"


@_query(_BOUNDS)
def roi_bounds(spark: SparkSession, d: str) -> DataFrame:
    return _round(rois.bounds(views.roi_pixels(spark, d)))


@_query(f"SELECT roi, array_to_string(list_filter([CASE WHEN NOT (x >= 2 AND x + width <= 30 AND y >= 1 AND y + height <= lim) THEN 'motion_border' END, CASE WHEN area <= 11 THEN 'small_size' END], lambda l: l IS NOT NULL), ',') AS labels, (x >= 2 AND x + width <= 30 AND y >= 1 AND y + height <= lim) AND area > 11 AS valid FROM ({_BOUNDS}), (SELECT floor(max(r) + 1 - 2.2) AS lim FROM movie)")
def roi_exclusion(spark: SparkSession, d: str) -> DataFrame:
    out = rois.exclusion_labels(views.roi_pixels(spark, d), {"left": 1.5, "right": 1.5, "up": 2.2, "down": 0.3}, movies.extent(views.movie(spark, d)), 11)
    return out.select("roi", F.array_join("exclusion_labels", ",").alias("labels"), "valid")


@_query("SELECT a.roi AS roi_a, b.roi AS roi_b, count(*) AS n, round(count(*) / 12.0, 6) AS share_a, round(count(*) / 12.0, 6) AS share_b FROM roi_pixels a JOIN roi_pixels b USING (r, c) WHERE a.roi % 2 = 0 AND b.roi % 2 = 1 GROUP BY ALL")
def roi_overlaps(spark: SparkSession, d: str) -> DataFrame:
    pixels = views.roi_pixels(spark, d)
    return _round(rois.overlaps(pixels.where("roi % 2 = 0"), pixels.where("roi % 2 = 1")))


@_query("SELECT DISTINCT a.roi AS roi_a, b.roi AS roi_b FROM roi_pixels a JOIN roi_pixels b ON a.roi < b.roi AND (a.r - b.r) ** 2 + (a.c - b.c) ** 2 <= 2")
def abutting_rois(spark: SparkSession, d: str) -> DataFrame:
    return rois.abutting(views.roi_pixels(spark, d))


@_query('SELECT max(x) FILTER (abs(x) <= 30) AS "left", -min(x) FILTER (abs(x) <= 30) AS "right", max(y) FILTER (abs(y) <= 30) AS up, -min(y) FILTER (abs(y) <= 30) AS down, greatest(max(y) FILTER (abs(y) <= 30), 0) AS bottom, greatest(-min(y) FILTER (abs(y) <= 30), 0) AS top, greatest(-min(x) FILTER (abs(x) <= 30), 0) AS left_side, greatest(max(x) FILTER (abs(x) <= 30), 0) AS right_side FROM shift')
def motion_border(spark: SparkSession, d: str) -> DataFrame:
    return rois.motion_border(views.shift(spark, d))


@_query("SELECT r, c, round(max(v), 6) AS max_v, round(avg(v), 6) AS avg_v FROM movie GROUP BY ALL")
def movie_projection(spark: SparkSession, d: str) -> DataFrame:
    return _round(movies.projection(views.movie(spark, d)))


@_query("SELECT r, c, CAST(t // 7 AS INT) AS t_out, round(avg(v), 6) AS average, round(max(v), 6) AS maximum, round(arg_min(v, t), 6) AS first, round(arg_max(v, t), 6) AS last FROM movie GROUP BY ALL")
def movie_downsample(spark: SparkSession, d: str) -> DataFrame:
    return _round(movies.downsample(views.movie(spark, d), 7, ["r", "c"]))


@_query("SELECT CAST(r // 4 AS INT) AS br, CAST(c // 4 AS INT) AS bc, t, round(sum(v) / 16, 6) AS v FROM movie GROUP BY ALL")
def movie_block_mean(spark: SparkSession, d: str) -> DataFrame:
    return _round(movies.block_mean(views.movie(spark, d), 4))


@_query("SELECT r, c, t, CAST(round_even((least(greatest(v, lo), hi) - lo) / (hi - lo) * 255, 0) AS INT) AS v FROM movie, (SELECT quantile_cont(v, 0.1) AS lo, quantile_cont(v, 0.99) AS hi FROM movie)")
def movie_scaled(spark: SparkSession, d: str) -> DataFrame:
    return movies.scaled(views.movie(spark, d), 0.1, 0.99)


@_query("SELECT event_id AS page, CAST(event_id % 6 AS INT) AS plane, CAST(event_id // 6 AS BIGINT) AS frame FROM events")
def deinterleaved_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("page"))
    return movies.deinterleave(pages, 6)


_EDGES = "SELECT a.r AS r0, a.c AS c0, b.r AS r1, b.c AS c1, corr(a.v, b.v) AS pearson FROM movie a JOIN movie b ON a.t = b.t AND ((b.r = a.r AND b.c = a.c + 1) OR (b.r = a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1)) GROUP BY ALL"


@_query(f"SELECT r0, c0, r1, c1, round(pearson, 6) AS pearson FROM ({_EDGES})")
def pixel_correlation(spark: SparkSession, d: str) -> DataFrame:
    return _round(movies.neighbour_correlation(views.movie(spark, d)))


@_query(f", e AS ({_EDGES}) SELECT r, c, round(avg(pearson), 6) AS v FROM (SELECT r0 AS r, c0 AS c, pearson FROM e UNION ALL SELECT r1, c1, pearson FROM e) GROUP BY ALL")
def correlation_image(spark: SparkSession, d: str) -> DataFrame:
    return _round(movies.graph_image(movies.neighbour_correlation(views.movie(spark, d)), "pearson"))


@_query("SELECT r, c, round(v, 6) AS v, CASE WHEN k <= floor(0.4 * n) THEN 'kept' ELSE 'excluded by fraction' END AS status FROM (SELECT *, row_number() OVER (ORDER BY v DESC, r, c) AS k, count(*) OVER () AS n FROM (SELECT * FROM (SELECT r, c, max(v) AS v FROM movie GROUP BY r, c) QUALIFY row_number() OVER (PARTITION BY r // 4, c // 4 ORDER BY v DESC, r, c) = 1))")
def seed_pixels(spark: SparkSession, d: str) -> DataFrame:
    image = movies.projection(views.movie(spark, d)).select("r", "c", F.col("max_v").alias("v"))
    return _round(movies.seeds(image, 4, 0.4))


@_query("SELECT r, c, t FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY v DESC, t) AS k, count(*) OVER (PARTITION BY r, c) AS n FROM movie) WHERE k <= floor(0.2 * n)")
def bright_frames(spark: SparkSession, d: str) -> DataFrame:
    return movies.bright_frames(views.movie(spark, d), 0.2)


def _rolling(half: int, quantile: str) -> str:
    return f"""SELECT roi, t, f, (SELECT {quantile} FROM (SELECT g.f AS x FROM unnest(list_transform(range(t - {half}, t + {half + 1}), lambda p: CASE WHEN p < 0 THEN -1 - p WHEN p >= n THEN 2 * n - 1 - p ELSE p END)) u(p) JOIN (SELECT roi AS ro, t AS ti, f FROM trace) g ON g.ro = z.roi AND g.ti = u.p)) AS q FROM (SELECT *, count(*) OVER (PARTITION BY roi) AS n FROM trace) z"""


@_query(f"SELECT roi, t, round(q, 6) AS median FROM ({_rolling(5, 'median(x)')})")
def rolling_median(spark: SparkSession, d: str) -> DataFrame:
    return _round(traces.rolling_median(views.trace(spark, d), 11).select("roi", "t", F.col("q").alias("median")))


_NOISE = f""", m AS ({_rolling(5, 'median(x)')}), k AS (SELECT * FROM (SELECT roi, f - q AS d, min(f - q) OVER (PARTITION BY roi) AS low FROM m) WHERE d < 1.5 * abs(low)),
s AS (SELECT roi, 1.4826 * mad(d) AS s FROM k GROUP BY roi), noise AS (SELECT roi, 1.4826 * mad(d) AS noise FROM k JOIN s USING (roi) WHERE abs(d) < 2.5 * s GROUP BY roi)"""


@_query(f"{_NOISE} SELECT roi, round(noise, 6) AS noise FROM noise")
def trace_noise(spark: SparkSession, d: str) -> DataFrame:
    return _round(traces.noise_std(views.trace(spark, d), 11))


@_query(f"{_NOISE}, b AS ({_rolling(10, 'median(x)')}) SELECT roi, t, round((f - q) / greatest(q, noise), 6) AS dff, q <= noise AS small_baseline FROM b JOIN noise USING (roi)")
def dff(spark: SparkSession, d: str) -> DataFrame:
    return _round(traces.dff(views.trace(spark, d), 11, 21))


@_query("SELECT roi, t, max(f > 50) OVER (PARTITION BY roi ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS active FROM trace")
def dilated_activity(spark: SparkSession, d: str) -> DataFrame:
    return traces.dilate(views.trace(spark, d).select("roi", "t", (F.col("f") > 50).alias("active")), 3)


@_query("SELECT s.roi, s.t FROM trace s WHERE f > 60 AND NOT EXISTS (SELECT 1 FROM trace x WHERE x.roi = s.roi AND x.f < 10 AND abs(x.t - s.t) <= 2)")
def independent_events(spark: SparkSession, d: str) -> DataFrame:
    t = views.trace(spark, d)
    return traces.independent_events(t.where("f > 60").select("roi", "t"), t.where("f < 10").select("roi", "t"))


@_query("SELECT roi, avg(f) + stddev_pop(f) < 0 AS negative_baseline, avg(f) < stddev_pop(f) AS zero_baseline FROM trace GROUP BY roi")
def baseline_flags(spark: SparkSession, d: str) -> DataFrame:
    return traces.baseline_flags(views.trace(spark, d))


@_query("SELECT roi, count(*) FILTER (f - 50 > 0) AS n_events, round(coalesce(min(f - 50) FILTER (f - 50 > 0), 0), 6) AS least FROM trace GROUP BY roi")
def event_summary(spark: SparkSession, d: str) -> DataFrame:
    return _round(traces.event_summary(views.trace(spark, d).withColumn("f", F.col("f") - 50)))


@_query("SELECT roi, t, round((0.8 * f - 0.2 * t) / 0.66, 6) AS signal, round((0.9 * t - 0.3 * f) / 0.66, 6) AS other FROM trace")
def unmixed_pair(spark: SparkSession, d: str) -> DataFrame:
    t = views.trace(spark, d)
    signal, other = unmix(F.lit(0.9), F.lit(0.2), F.lit(0.3), F.lit(0.8), F.col("f"), F.col("t"))
    return _round(t.select("roi", "t", signal.alias("signal"), other.alias("other")))


@_query(""", p AS (SELECT roi, t, f FROM trace UNION ALL SELECT roi, -k, m FROM (SELECT roi, avg(f) AS m FROM trace WHERE t < 20 GROUP BY roi), range(1, 20) u(k)),
b AS (SELECT roi, t, CAST(f < avg(f) OVER w - 1.2 * stddev_pop(f) OVER w AS INT) AS b FROM p WINDOW w AS (PARTITION BY roi ORDER BY t ROWS 19 PRECEDING))
SELECT DISTINCT roi FROM (SELECT roi, sum(b) OVER (PARTITION BY roi ORDER BY t ROWS 1 PRECEDING) AS n FROM b WHERE t >= 0) WHERE n = 2""")
def negative_transients(spark: SparkSession, d: str) -> DataFrame:
    return traces.negative_transients(views.trace(spark, d), 20, 2, 1.2)


_EXTENT = "(SELECT max(r) + 1 AS rows, max(c) + 1 AS columns FROM movie)"
_MIRROR = "CASE WHEN {x} < 0 THEN -1 - ({x}) WHEN {x} >= {n} THEN 2 * {n} - 1 - ({x}) ELSE {x} END"


def _median(source: str) -> str:
    r, c = _MIRROR.format(x="a.r + dr", n="rows"), _MIRROR.format(x="a.c + dc", n="columns")
    return f"SELECT a.r, a.c, a.t, median(b.v) AS v FROM (SELECT * FROM {source}, {_EXTENT}, range(-1, 2) x(dr), range(-1, 2) y(dc)) a JOIN {source} b ON b.t = a.t AND b.r = {r} AND b.c = {c} GROUP BY a.r, a.c, a.t"


@_query(f"SELECT r, c, t, round(v, 6) AS v FROM ({_median('movie')})")
def median_filtered(spark: SparkSession, d: str) -> DataFrame:
    return _round(images.median_filter(views.movie(spark, d), 3))


@_query(f", slow AS (SELECT r, c, CAST(t // 4 AS INT) AS t, avg(v) AS v FROM movie GROUP BY ALL) SELECT r, c, round(max(v), 6) AS v FROM ({_median('slow')}) GROUP BY r, c")
def median_filtered_projection(spark: SparkSession, d: str) -> DataFrame:
    slow = movies.downsample(views.movie(spark, d), 4, ["r", "c"]).select("r", "c", F.col("t_out").alias("t"), F.col("average").alias("v"))
    return _round(images.median_filter(slow, 3).groupBy("r", "c").agg(F.max("v").alias("v")))


_DISK = "(VALUES (0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)) k(dr, dc)"
_INSIDE = f"r BETWEEN 0 AND {_ROWS - 1} AND c BETWEEN 0 AND {_COLUMNS - 1}"


def _dilated(x: str) -> str:
    return f"SELECT * FROM (SELECT DISTINCT roi, r + dr AS r, c + dc AS c FROM {x}, {_DISK}) WHERE {_INSIDE}"


def _eroded(x: str) -> str:
    return f"SELECT roi, r, c FROM {x} p WHERE NOT EXISTS (SELECT 1 FROM {x} q, {_DISK} WHERE q.roi = p.roi AND q.r = p.r AND q.c = p.c AND p.r + dr BETWEEN 0 AND {_ROWS - 1} AND p.c + dc BETWEEN 0 AND {_COLUMNS - 1} AND (p.roi, p.r + dr, p.c + dc) NOT IN (SELECT (roi, r, c) FROM {x}))"


@_query(f", m1 AS ({_dilated('roi_pixels')}), m2 AS ({_eroded('m1')}), m3 AS ({_eroded('m2')}), m4 AS ({_dilated('m3')}) SELECT * FROM m4")
def closed_and_opened(spark: SparkSession, d: str) -> DataFrame:
    return images.close_and_open(views.roi_pixels(spark, d), _ROWS, _COLUMNS)


@_query("SELECT roi, r, c FROM roi_pixels p WHERE (SELECT count(*) FROM roi_pixels q WHERE q.roi = p.roi AND abs(q.r - p.r) + abs(q.c - p.c) = 1) < 4")
def roi_contours(spark: SparkSession, d: str) -> DataFrame:
    return images.contour(views.roi_pixels(spark, d))


@_query(""", i AS (SELECT r, c, avg(v) AS v FROM movie GROUP BY ALL),
g AS (SELECT v, lag(v) OVER y AS n, lead(v) OVER y AS s, lag(v) OVER x AS w, lead(v) OVER x AS e FROM i WINDOW y AS (PARTITION BY c ORDER BY r), x AS (PARTITION BY r ORDER BY c))
SELECT round(avg(((coalesce(s, v) - coalesce(n, v)) / CASE WHEN n IS NULL OR s IS NULL THEN 1 ELSE 2 END) ** 2 + ((coalesce(e, v) - coalesce(w, v)) / CASE WHEN w IS NULL OR e IS NULL THEN 1 ELSE 2 END) ** 2), 6) AS acutance FROM g""")
def image_acutance(spark: SparkSession, d: str) -> DataFrame:
    return _round(images.acutance(movies.projection(views.movie(spark, d)).select("r", "c", F.col("avg_v").alias("v"))))


@_query(f"SELECT round(quantile_cont(v, 0.1), 6) AS lo, round(quantile_cont(v, 0.99), 6) AS hi FROM movie, {_EXTENT} WHERE rows <= 6 OR columns <= 6 OR (r >= 3 AND r < rows - 3 AND c >= 3 AND c < columns - 3)")
def display_limits(spark: SparkSession, d: str) -> DataFrame:
    return _round(images.display_limits(views.movie(spark, d), 0.1, 0.99, 3))


@_query("SELECT a.r, a.c, a.t, round(avg(b.v), 6) AS v FROM (SELECT *, least(greatest(t + o, 0), n - 1) AS p FROM (SELECT *, count(*) OVER (PARTITION BY r, c) AS n FROM movie), range(-2, 2) x(o)) a JOIN movie b ON b.r = a.r AND b.c = a.c AND b.t = a.p GROUP BY a.r, a.c, a.t")
def boxcar_movie(spark: SparkSession, d: str) -> DataFrame:
    return _round(signals.boxcar(views.movie(spark, d), 4, ["r", "c"]))


_HELD = "m AS (SELECT a.roi, a.t, a.f, median(b.f) AS q FROM (SELECT *, least(greatest(t + o, 0), n - 1) AS p FROM (SELECT *, count(*) OVER (PARTITION BY roi) AS n FROM trace), range(-5, 6) x(o)) a JOIN trace b ON b.roi = a.roi AND b.t = a.p GROUP BY a.roi, a.t, a.f)"


@_query(f", {_HELD} SELECT roi, t, round(CASE WHEN abs(f - q) > 20 THEN q + 20 * sign(f - q) ELSE f END, 6) AS f FROM m")
def clipped_trace(spark: SparkSession, d: str) -> DataFrame:
    return _round(signals.clip_outliers(views.trace(spark, d), 11, 20.0))


@_query(f", {_HELD} SELECT roi, t, round(f - least(q, 2.5 * s), 6) AS f FROM m JOIN (SELECT roi, stddev_pop(f) / 4 AS s FROM trace GROUP BY roi) USING (roi)")
def detrended_trace(spark: SparkSession, d: str) -> DataFrame:
    t = views.trace(spark, d)
    return _round(signals.event_detrend(t, t.groupBy("roi").agg((F.stddev_pop("f") / 4).alias("noise")), 11))


@_query("SELECT t, CASE WHEN t < 7 OR t >= n - 9 THEN 0 ELSE x END AS x, CASE WHEN t < 7 OR t >= n - 9 THEN 0 ELSE y END AS y FROM shift, (SELECT max(t) + 1 AS n FROM shift)")
def trimmed_shift(spark: SparkSession, d: str) -> DataFrame:
    return signals.reset_trimmed(views.shift(spark, d), 7, 9)


@_query("SELECT * FROM movie WHERE t IN (SELECT CAST(i * n // least(n, 11) + 3 AS INT) FROM (SELECT max(t) + 1 - 5 AS n FROM movie), range(11) x(i) WHERE i < n)")
def spaced_frames(spark: SparkSession, d: str) -> DataFrame:
    return signals.spaced_frames(views.movie(spark, d), 11, 3, 2)


@_query("SELECT roi, round(CASE WHEN r > 1 THEN fill ELSE r END, 6) AS r, r > 1 AS filled FROM (SELECT roi, avg(f) / 50 AS r FROM trace GROUP BY roi), (SELECT CASE WHEN count(*) >= 5 THEN avg(r) ELSE 0.7 END AS fill FROM (SELECT avg(f) / 50 AS r FROM trace GROUP BY roi) WHERE r > 0 AND r <= 1)")
def refilled_ratios(spark: SparkSession, d: str) -> DataFrame:
    return _round(signals.refill_ratios(views.trace(spark, d).groupBy("roi").agg((F.avg("f") / 50).alias("r"))))


@_query("SELECT round(1 - a, 6) AS m00, round(a, 6) AS m01, round(b, 6) AS m10, round(1 - b, 6) AS m11 FROM (SELECT avg(least(x, 1 - x)) AS a, avg(least(y, 1 - y)) AS b FROM (SELECT roi % 11 / 16.0::DOUBLE AS x, roi % 7 / 8.0::DOUBLE AS y FROM (SELECT DISTINCT roi FROM trace) WHERE roi % 3 <> 0))")
def mean_mixing(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("roi") % 11 / 16, F.col("roi") % 7 / 8
    mixing = views.trace(spark, d).select("roi").distinct().select(x.alias("m00"), (1 - x).alias("m01"), y.alias("m10"), (1 - y).alias("m11"), (F.col("roi") % 3 != 0).alias("converged"))
    return _round(signals.mean_mixing(mixing))


@_query("SELECT roi, round(100 * regr_slope(CAST(t AS DOUBLE), f), 6) AS slope, abs(100 * regr_slope(CAST(t AS DOUBLE), f)) > 50 AS outlier FROM trace GROUP BY roi")
def crosstalk_outliers(spark: SparkSession, d: str) -> DataFrame:
    return _round(signals.crosstalk_outliers(views.trace(spark, d).select("roi", F.col("f").alias("signal"), F.col("t").cast("double").alias("crosstalk"))))


@_query("SELECT CAST(least(round_even((f - 0) / 4, 0), 24) AS INT) AS bx, CAST(least(round_even((t - 0) / 4, 0), 24) AS INT) AS by, count(*) AS n FROM trace GROUP BY ALL")
def pair_histogram(spark: SparkSession, d: str) -> DataFrame:
    return signals.histogram_2d(views.trace(spark, d).select(F.col("f").alias("x"), F.col("t").cast("double").alias("y")), (0.0, 100.0), (0.0, 100.0))


@_query("SELECT round(avg(f), 6) AS mean, round(stddev_pop(f), 6) AS deviation, CAST(round_even(sum(abs(f)), 0) AS BIGINT) % 4294967296 AS seed FROM trace")
def recording_figures(spark: SparkSession, d: str) -> DataFrame:
    return _round(signals.recording_figures(views.trace(spark, d)))


@_query("SELECT c_nationkey AS experiment, c_custkey AS position, row_number() OVER (ORDER BY c_nationkey, c_custkey) + 99 AS roi FROM customer")
def running_ids(spark: SparkSession, d: str) -> DataFrame:
    rois_ = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_nationkey").alias("experiment"), F.col("c_custkey").alias("position"))
    return signals.running_ids(rois_, 100)


@_query(f"SELECT roi FROM ({_BOUNDS}) WHERE NOT (y + height < 2 OR y >= 7 OR x + width < 5 OR x >= 15)")
def rois_in_field(spark: SparkSession, d: str) -> DataFrame:
    return checks.in_field(views.roi_pixels(spark, d), 2, 5, 5, 10)


@_query("SELECT roi, min(n) = max(n) AS valid FROM (SELECT roi, t % 2 AS channel, count(*) AS n FROM trace GROUP BY ALL) GROUP BY roi")
def valid_traces(spark: SparkSession, d: str) -> DataFrame:
    return checks.valid_traces(views.trace(spark, d).select("roi", (F.col("t") % 2).alias("channel"), "t", "f"))


@_query(", x AS (SELECT t, CASE WHEN t % 5 = 0 AND c = 3 THEN v + 1 ELSE v END AS v FROM movie), y AS (SELECT t, v FROM movie) SELECT DISTINCT t FROM ((SELECT * FROM x EXCEPT ALL SELECT * FROM y) UNION ALL (SELECT * FROM y EXCEPT ALL SELECT * FROM x))")
def moved_frames(spark: SparkSession, d: str) -> DataFrame:
    raw = views.movie(spark, d)
    moved = raw.select("t", F.when((F.col("t") % 5 == 0) & (F.col("c") == 3), F.col("v") + 1).otherwise(F.col("v")).alias("v"))
    return checks.moved_frames(moved, raw)


@_query("SELECT roi, count(*) FILTER (ok) AS n_independent, count(*) FILTER (ok) = 0 AS ghost FROM (SELECT s.roi, NOT EXISTS (SELECT 1 FROM trace x WHERE x.roi = s.roi AND x.f < 60 AND abs(x.t - s.t) <= 2) AS ok FROM trace s WHERE f > 85) GROUP BY roi")
def ghost_rois(spark: SparkSession, d: str) -> DataFrame:
    t = views.trace(spark, d)
    return checks.ghosts(t.where("f > 85").select("roi", "t"), t.where("f < 60").select("roi", "t"))


@_query("SELECT roi, round(corr(f, a), 6) AS c00, round(corr(f, b), 6) AS c01, round(corr(CAST(t AS DOUBLE), a), 6) AS c10, round(corr(CAST(t AS DOUBLE), b), 6) AS c11 FROM (SELECT roi, t, f, (0.8 * f - 0.2 * t) / 0.66 AS a, (0.9 * t - 0.3 * f) / 0.66 AS b FROM trace) GROUP BY roi")
def channel_correlation(spark: SparkSession, d: str) -> DataFrame:
    t = views.trace(spark, d)
    signal, other = unmix(F.lit(0.9), F.lit(0.2), F.lit(0.3), F.lit(0.8), F.col("f"), F.col("t"))
    return _round(checks.channel_correlation(t.select("roi", F.col("f").alias("in0"), F.col("t").cast("double").alias("in1"), signal.alias("out0"), other.alias("out1"))))


@_query(""", g AS (SELECT roi, t, CASE WHEN f <= 40 THEN f END AS f, count(*) OVER (PARTITION BY roi) AS n FROM trace),
m AS (SELECT a.roi, a.t, median(b.f) AS m FROM (SELECT *, CASE WHEN t + o < 0 THEN -1 - (t + o) WHEN t + o >= n THEN 2 * n - 1 - (t + o) ELSE t + o END AS p FROM g, range(-1, 2) x(o)) a JOIN g b ON b.roi = a.roi AND b.t = a.p GROUP BY a.roi, a.t),
s AS (SELECT *, max(CASE WHEN m IS NOT NULL THEN t END) OVER (PARTITION BY roi ORDER BY t) AS ta, min(CASE WHEN m IS NOT NULL THEN t END) OVER (PARTITION BY roi ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS tb FROM m)
SELECT s.roi, s.t, round(coalesce(s.m, a.m + (b.m - a.m) * (s.t - ta) / nullif(tb - ta, 0), a.m, b.m), 6) AS m FROM s LEFT JOIN m a ON a.roi = s.roi AND a.t = ta LEFT JOIN m b ON b.roi = s.roi AND b.t = tb""")
def gap_median(spark: SparkSession, d: str) -> DataFrame:
    return _round(checks.gap_median(views.trace(spark, d).withColumn("f", F.when(F.col("f") <= 40, F.col("f"))), 3))


@_query(None)
def demixed_traces(spark: SparkSession, d: str) -> DataFrame:
    return _round(checks.demix(views.movie(spark, d), views.roi_pixels(spark, d)))


@_query(f"""{_NOISE}, l AS ({_rolling(10, 'list_sort(list(x))[3]')}), g AS (SELECT roi, t, f, CASE WHEN f <= q + 3 * noise THEN f END AS i, noise, count(*) OVER (PARTITION BY roi) AS n FROM l JOIN noise USING (roi)),
md AS (SELECT a.roi, a.t, median(b.i) AS m FROM (SELECT *, CASE WHEN t + o < 0 THEN -1 - (t + o) WHEN t + o >= n THEN 2 * n - 1 - (t + o) ELSE t + o END AS p FROM g, range(-10, 11) x(o)) a JOIN g b ON b.roi = a.roi AND b.t = a.p GROUP BY a.roi, a.t)
SELECT roi, t, round((f - m) / greatest(m, noise), 6) AS dff, count(*) FILTER (m <= noise) OVER (PARTITION BY roi) AS n_small_baseline FROM md JOIN g USING (roi, t)""")
def dff_percentile(spark: SparkSession, d: str) -> DataFrame:
    return _round(analysis.dff(views.trace(spark, d), 11, 21).select("roi", "t", "dff", "n_small_baseline"))


@_query(""", g AS (SELECT *, CASE WHEN f <= 60 THEN f END AS i, count(*) OVER (PARTITION BY roi) AS n FROM trace)
SELECT z.roi, z.t, round(avg(x.i), 6) AS mean, round(stddev_samp(x.i), 6) AS sd FROM (SELECT *, least(greatest(t, 5), n - 5) AS centre FROM g) z JOIN g x ON x.roi = z.roi AND (z.n <= 10 OR x.t BETWEEN centre - 5 AND centre + 4) GROUP BY z.roi, z.t""")
def rolling_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _round(analysis.masked_rolling(views.trace(spark, d), 10, F.col("f") <= 60).select("roi", "t", "mean", "sd"))


@_query(""", g AS (SELECT *, CASE WHEN f <= 60 OR all_hot THEN f END AS i FROM (SELECT *, count(*) OVER (PARTITION BY roi) AS n, min(f) OVER (PARTITION BY roi) > 60 AS all_hot FROM trace)),
s AS (SELECT z.roi, z.t, avg(x.i) - 2 * stddev_samp(x.i) AS least FROM (SELECT *, least(greatest(t, 5), n - 5) AS centre FROM g) z JOIN g x ON x.roi = z.roi AND (z.n <= 10 OR x.t BETWEEN centre - 5 AND centre + 4) GROUP BY z.roi, z.t)
SELECT roi, t, round(greatest(f, coalesce(least, -999)), 6) AS f FROM trace JOIN s USING (roi, t)""")
def clipped_negatives(spark: SparkSession, d: str) -> DataFrame:
    t = views.trace(spark, d)
    return _round(analysis.clip_negative(t, t.select("roi", "t", (F.col("f") > 60).alias("active")), 10))


@_query(""", h AS RECURSIVE (SELECT roi, list(f ORDER BY f) AS l FROM trace GROUP BY roi
  UNION ALL SELECT roi, l[j:j + n - 1] FROM (SELECT roi, l, n, list_position(w, list_min(w)) AS j FROM (SELECT roi, l, n, list_transform(range(1, n + 1), lambda i: l[i + n - 1] - l[i]) AS w FROM (SELECT roi, l, (len(l) + 1) // 2 AS n FROM h WHERE len(l) > 3))))
SELECT roi, round(CASE len(l) WHEN 3 THEN CASE WHEN l[2] - l[1] < l[3] - l[2] THEN (l[1] + l[2]) / 2 ELSE l[2] END WHEN 2 THEN (l[1] + l[2]) / 2 ELSE l[1] END, 6) AS mode FROM h WHERE len(l) <= 3""")
def trace_modes(spark: SparkSession, d: str) -> DataFrame:
    return _round(analysis.modes(views.trace(spark, d)))


@_query(None)
def active_frames(spark: SparkSession, d: str) -> DataFrame:
    return analysis.active_frames(views.trace(spark, d), 3.0)


@_query(None)
def neuropil_corrected(spark: SparkSession, d: str) -> DataFrame:
    t = views.trace(spark, d)
    return _round(analysis.neuropil_corrected(t.select("roi", "t", (F.col("f") + 100).alias("f"), (40 + 10 * F.sin("t")).alias("np")), 2))


@_query(None)
def detected_events(spark: SparkSession, d: str) -> DataFrame:
    return _round(analysis.detect_events(views.trace(spark, d), 0.8, 2.0, 5, 11))


@_query(""", p AS (SELECT roi, t, f AS a, f * (t % 3) AS b FROM trace), m AS (SELECT roi, median(a) AS ma, median(b) AS mb, max(t) AS last FROM p GROUP BY roi),
k AS (SELECT roi, arg_max(t, (a - ma, -t)) AS ta, max(a - ma) AS ra, arg_max(t, (b - mb, -t)) AS tb, max(b - mb) AS rb, any_value(last) AS last FROM p JOIN m USING (roi) GROUP BY roi)
SELECT roi, start, least(start + 7, last + 1) AS "end" FROM (SELECT *, greatest(0, least(CASE WHEN ra >= rb THEN ta ELSE tb END - 3, last + 1 - 7)) AS start FROM k)""")
def active_sections(spark: SparkSession, d: str) -> DataFrame:
    t = views.trace(spark, d)
    return analysis.most_active_section(t.select("roi", "t", F.col("f").alias("a"), (F.col("f") * (F.col("t") % 3)).alias("b")), 7)


_BRIGHT = "SELECT r, c, t FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY v, t) AS k, count(*) OVER (PARTITION BY r, c) AS n FROM movie) WHERE k > round_even(0.8 * n, 0)"
_TOUCH = "((b.r = a.r AND b.c = a.c + 1) OR (b.r = a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1))"


@_query(f""", b AS ({_BRIGHT}), m AS (SELECT movie.*, b.t IS NOT NULL AS hot FROM movie LEFT JOIN b USING (r, c, t))
SELECT a.r AS r0, a.c AS c0, b.r AS r1, b.c AS c1, round(corr(a.v, b.v), 6) AS filtered FROM m a JOIN m b ON a.t = b.t AND {_TOUCH} WHERE a.hot OR b.hot GROUP BY ALL""")
def filtered_correlation(spark: SparkSession, d: str) -> DataFrame:
    return _round(graphs.filtered_correlation(views.movie(spark, d), 0.2))


@_query(f""", s AS (SELECT * FROM movie), e AS (SELECT DISTINCT a.r AS r0, a.c AS c0, b.r AS r1, b.c AS c1 FROM s a JOIN s b ON a.t = b.t AND {_TOUCH}),
p AS (SELECT r0, c0, r1, c1, n.r, n.c FROM e JOIN (SELECT DISTINCT r, c FROM s) n ON sqrt((n.r - (r0 + r1) / 2) ** 2 + (n.c - (c0 + c1) / 2) ** 2) <= 1.6),
g AS (SELECT r0, c0, r1, c1, p.r, p.c, corr(a.v, x.v) - corr(b.v, x.v) AS g FROM p JOIN s a ON a.r = r0 AND a.c = c0 JOIN s b ON b.r = r1 AND b.c = c1 AND b.t = a.t JOIN s x ON x.r = p.r AND x.c = p.c AND x.t = a.t GROUP BY ALL)
SELECT r0, c0, r1, c1, round(exp(-sum(g * g)), 6) AS hnc FROM g GROUP BY ALL""")
def hnc_gaussian(spark: SparkSession, d: str) -> DataFrame:
    return _round(graphs.hnc_gaussian(views.movie(spark, d), 1.6))


@_query(f""", e AS (SELECT r0, c0, r1, c1, 1 + pearson AS pearson FROM ({_EDGES})), img AS (SELECT r, c, avg(p) AS v FROM (SELECT r0 AS r, c0 AS c, pearson AS p FROM e UNION ALL SELECT r1, c1, pearson FROM e) GROUP BY r, c),
w AS (SELECT k, exp(-0.5 * (k / 1.5) ** 2) AS w FROM range(-6, 7) x(k)), n AS (SELECT k, w / (SELECT sum(w) FROM w) AS w FROM w),
one AS (SELECT a.r, a.c, sum(n.w * b.v) AS v FROM (SELECT *, max(r) OVER (PARTITION BY c) AS top FROM img) a, n JOIN img b ON b.c = a.c AND b.r = greatest(0, least(a.top, a.r + n.k)) GROUP BY a.r, a.c),
two AS (SELECT a.r, a.c, sum(n.w * b.v) AS v FROM (SELECT *, max(c) OVER (PARTITION BY r) AS top FROM one) a, n JOIN one b ON b.r = a.r AND b.c = greatest(0, least(a.top, a.c + n.k)) GROUP BY a.r, a.c)
SELECT r0, c0, r1, c1, round(pearson / ((x.v + y.v) / 2), 6) AS normalized FROM e JOIN two x ON x.r = r0 AND x.c = c0 JOIN two y ON y.r = r1 AND y.c = c1""")
def normalized_graph(spark: SparkSession, d: str) -> DataFrame:
    positive = movies.neighbour_correlation(views.movie(spark, d)).withColumn("pearson", 1 + F.col("pearson"))
    return _round(graphs.normalized(positive, "pearson", 1.5))


@_query("SELECT DISTINCT a.roi, c.roi AS other FROM roi_pixels a JOIN roi_pixels m USING (r, c) JOIN roi_pixels n ON n.roi = m.roi JOIN roi_pixels c ON c.r = n.r AND c.c = n.c")
def overlap_groups(spark: SparkSession, d: str) -> DataFrame:
    return rois.overlap_groups(views.roi_pixels(spark, d))


@_query(f"SELECT roi, x < 2 OR x + width - 1 > floor(nc - 3) - 1 OR y < 1 OR y + height - 1 > floor(nr - 2.5) - 1 AS at_border FROM ({_BOUNDS}), (SELECT max(r) + 1 AS nr, max(c) + 1 AS nc FROM movie)")
def border_flags(spark: SparkSession, d: str) -> DataFrame:
    return rois.at_border(views.roi_pixels(spark, d), (1.5, 3.0, 2.5, 0.2), movies.extent(views.movie(spark, d)))


@_query(f"SELECT roi FROM ({_BOUNDS}) WHERE least(height / width, width / height) > 0.75 - (roi % 2)")
def round_rois(spark: SparkSession, d: str) -> DataFrame:
    pixels = views.roi_pixels(spark, d)
    odd, even = (rois.keep_round(pixels.where(F.col("roi") % 2 == k), 0.75 - k) for k in (1, 0))
    return odd.union(even).select("roi").distinct()


@_query("SELECT CAST(i AS INT) AS batch, r, c, t, round(v, 6) AS v FROM movie, range(4) u(i) WHERE t >= 3 + floor(i * 59 / 4) AND t < 3 + floor(i * 59 / 4) + 5")
def batch_frames(spark: SparkSession, d: str) -> DataFrame:
    return _round(selection.representative_batches(views.movie(spark, d), 4, 5, 3, 2))


@_query("SELECT r, c, t, round(v, 6) AS v FROM movie WHERE t >= 4 AND t < 6")
def late_frames(spark: SparkSession, d: str) -> DataFrame:
    return _round(selection.representative_batches(views.movie(spark, d).where("t < 8"), 3, 2, 4, 2).drop("batch"))


@_query(", m AS (SELECT t, avg(v) AS m FROM movie GROUP BY t) SELECT t, round(m, 6) AS score FROM m ORDER BY m DESC, t LIMIT 9")
def best_frames(spark: SparkSession, d: str) -> DataFrame:
    return _round(selection.best_frames(selection.frame_means(views.movie(spark, d)).withColumnRenamed("m", "score"), 9))


@_query(""", m AS (SELECT t, avg(v) AS m FROM movie GROUP BY t),
cut AS RECURSIVE (SELECT 0 AS i, CAST('-inf' AS DOUBLE) AS lo, CAST('inf' AS DOUBLE) AS hi
  UNION ALL SELECT i + 1, greatest(any_value(lo), avg(m) - 1.5 * stddev_pop(m)), least(any_value(hi), avg(m) + 1.5 * stddev_pop(m)) FROM cut JOIN m ON m BETWEEN lo AND hi WHERE i < 40 GROUP BY i)
SELECT t, round(m, 6) AS m FROM m, (SELECT * FROM cut WHERE i = 40) WHERE m BETWEEN lo AND hi""")
def usual_frames(spark: SparkSession, d: str) -> DataFrame:
    return _round(selection.usual_frames(views.movie(spark, d), 1.5))


@_query(""", m AS (SELECT t, avg(CASE WHEN t < 3 OR t > 61 THEN v - 9 ELSE v END) AS m FROM movie GROUP BY t), s AS (SELECT avg(m) AS a, quantile_cont(m, 0.75) - quantile_cont(m, 0.25) AS q, count(*) AS n FROM m),
e AS (SELECT t, n FROM m, s WHERE m < a - 5 * q / (2 * 0.6745))
SELECT CASE WHEN count(*) FILTER (t < n // 2) = max(t) FILTER (t < n // 2) + 1 THEN count(*) FILTER (t < n // 2) ELSE 0 END AS lowest, CASE WHEN count(*) FILTER (t >= n // 2) = max(n) - min(t) FILTER (t >= n // 2) THEN count(*) FILTER (t >= n // 2) ELSE 0 END AS highest FROM e""")
def empty_ends(spark: SparkSession, d: str) -> DataFrame:
    dark = F.when((F.col("t") < 3) | (F.col("t") > 61), F.col("v") - 9).otherwise(F.col("v"))
    return selection.empty_ends(views.movie(spark, d).withColumn("v", dark))


@_query("SELECT t, CASE WHEN t < floor(0.7 * (64 - 8)) + 4 THEN 'train' ELSE 'validation' END AS part FROM (SELECT DISTINCT t FROM movie) WHERE t >= 4 AND t < 60 AND NOT (t >= floor(0.7 * (64 - 8)) + 4 AND t < floor(0.7 * (64 - 8)) + 12)")
def frame_split(spark: SparkSession, d: str) -> DataFrame:
    return selection.train_and_validation(views.movie(spark, d).select("t").distinct(), 0.7, 4).select("t", "part")


@_query(f""", b AS ({_BRIGHT.replace('v, t) AS k', 'v DESC, t) AS k').replace('k > round_even(0.8 * n, 0)', 'k <= floor(0.2 * n)')}) SELECT DISTINCT a.r AS r0, a.c AS c0, b.r AS r1, b.c AS c1, t.t
  FROM (SELECT DISTINCT r, c FROM movie) a JOIN (SELECT DISTINCT r, c FROM movie) b ON b.r = a.r AND b.c = a.c + 1 JOIN b t ON (t.r = a.r AND t.c = a.c) OR (t.r = b.r AND t.c = b.c)""")
def bright_frames_of_pairs(spark: SparkSession, d: str) -> DataFrame:
    pixels = views.movie(spark, d).select("r", "c").distinct()
    pairs = pixels.select(F.col("r").alias("r0"), F.col("c").alias("c0")).join(pixels.select(F.col("r").alias("r1"), F.col("c").alias("c1")), (F.col("r0") == F.col("r1")) & (F.col("c1") == F.col("c0") + 1))
    return movies.bright_frames_of_pairs(views.movie(spark, d), pairs, 0.2)


@_query("SELECT roi, t, round(f, 6) AS f FROM (SELECT * FROM (SELECT DISTINCT roi FROM roi_pixels), range(64) u(t)) LEFT JOIN (SELECT roi, t, avg(v) AS f FROM movie JOIN roi_pixels USING (r, c) WHERE roi % 5 <> 0 GROUP BY ALL) USING (roi, t)")
def all_region_traces(spark: SparkSession, d: str) -> DataFrame:
    pixels = views.roi_pixels(spark, d)
    out = traces.all_regions_mean(views.movie(spark, d), pixels, pixels.where("roi % 5 = 0").select("roi").distinct())
    return _round(out.withColumn("f", F.nanvl("f", F.lit(None).cast("double"))))


def _two_traces(spark: SparkSession, d: str) -> DataFrame:
    """roi, t, signal, crosstalk: each region's pixels in the movie and in a movie of another plane."""
    movie = views.movie(spark, d)
    both = movie.withColumn("plane", F.lit(0)).union(movie.withColumn("v", F.col("v") * F.col("v") + F.col("t") / 64).withColumn("plane", F.lit(1)))
    return decrosstalk.paired_traces(both, views.roi_pixels(spark, d).withColumn("plane", F.col("roi") % 2))


@_query(""", m AS (SELECT r, c, t, v, 0 AS plane FROM movie UNION ALL SELECT r, c, t, v * v + t / 64, 1 FROM movie)
SELECT p.roi % 2 AS plane, roi, t, round(avg(v) FILTER (m.plane = p.roi % 2), 6) AS signal, round(avg(v) FILTER (m.plane <> p.roi % 2), 6) AS crosstalk FROM m JOIN roi_pixels p USING (r, c) GROUP BY ALL""")
def paired_traces(spark: SparkSession, d: str) -> DataFrame:
    return _round(_two_traces(spark, d))


@_query(""", planes AS (SELECT r, c, t, v, 0 AS plane FROM movie UNION ALL SELECT r, c, t, v * v + t / 64, 1 FROM movie),
p AS (SELECT roi, t, avg(v) FILTER (b.plane = p.roi % 2) AS x, avg(v) FILTER (b.plane <> p.roi % 2) AS y FROM planes b JOIN roi_pixels p USING (r, c) GROUP BY roi, t),
k AS (SELECT roi, avg(x) AS a, avg(y) AS b, var_pop(x) AS p, covar_pop(x, y) AS q, var_pop(y) AS s FROM p GROUP BY roi), e AS (SELECT *, sqrt(greatest(p * s - q * q, 0)) AS d FROM k)
SELECT roi, t, round(((s + d) * (x - a) - q * (y - b)) / (d * sqrt(p + s + 2 * d)), 6) AS x0, round(((e.p + d) * (y - b) - q * (x - a)) / (d * sqrt(e.p + s + 2 * d)), 6) AS x1 FROM p JOIN e USING (roi)""".replace("sqrt(p + s", "sqrt(e.p + s"))
def whitened_traces(spark: SparkSession, d: str) -> DataFrame:
    return _round(decrosstalk.whitened(_two_traces(spark, d)))


@_query(None)
def unmixed_traces(spark: SparkSession, d: str) -> DataFrame:
    return decrosstalk.unmixed(_two_traces(spark, d))


@_query(""", l AS (SELECT roi, s, CASE s WHEN 0 THEN roi % 3 = 0 WHEN 1 THEN roi % 5 = 0 WHEN 2 THEN roi % 4 = 1 WHEN 3 THEN roi % 7 = 1 ELSE roi % 2 = 0 END AS l FROM (SELECT DISTINCT roi FROM roi_pixels), range(5) x(s)),
w AS (SELECT roi, bool_or(l AND s = 0) AS a, bool_or(l AND s = 1) AS b, bool_or(l AND s = 2) AS c, bool_or(l AND s = 3) AS d, bool_or(l AND s = 4) AS ghost FROM l GROUP BY roi)
SELECT roi, CASE WHEN a THEN b ELSE true END AS raw, NOT (a OR b) AS raw_active, NOT (a OR b) AND (NOT c OR d) AS unmixed, NOT (a OR b OR c OR d) AS unmixed_active, ghost FROM w""")
def stage_flags(spark: SparkSession, d: str) -> DataFrame:
    regions, k = views.roi_pixels(spark, d).select("roi").distinct(), F.col("roi")
    lists = {"raw": k % 3 == 0, "raw_active": k % 5 == 0, "unmixed": k % 4 == 1, "unmixed_active": k % 7 == 1, "ghost": k % 2 == 0}
    on = F.filter(F.array(*(F.when(rule, F.lit(name)) for name, rule in lists.items())), lambda x: x.isNotNull())
    return decrosstalk.stage_flags(regions, regions.select("roi", F.explode(on).alias("stage")))


@_query("SELECT roi, t, CASE WHEN roi % 4 <> 0 THEN round(f, 6) END AS f FROM (SELECT roi, t, avg(v) AS f FROM movie JOIN roi_pixels USING (r, c) GROUP BY ALL)")
def traces_with_invalid(spark: SparkSession, d: str) -> DataFrame:
    pixels = views.roi_pixels(spark, d)
    whole = traces.masked_mean(views.movie(spark, d), pixels.where("roi % 4 <> 0"))
    out = decrosstalk.with_invalid(whole, pixels.join(views.movie(spark, d), ["r", "c"], "left_semi"))
    return _round(out.withColumn("f", F.nanvl("f", F.lit(None).cast("double"))))


@_query("SELECT roi AS region, CAST(1.5 * roi AS DOUBLE) AS x, CAST(2 AS DOUBLE) AS y, CAST(10 AS DOUBLE) AS width, CAST(20 AS DOUBLE) AS height, 5 AS columns, 9 AS rows FROM roi_pixels GROUP BY roi")
def scan_regions(spark: SparkSession, d: str) -> DataFrame:
    fields = views.roi_pixels(spark, d).select(F.col("roi").alias("region"), (1.5 * F.col("roi")).alias("x"), F.lit(2.0).alias("y"), F.lit(10.0).alias("width"), F.lit(20.0).alias("height"), F.lit(5).alias("columns"), F.lit(9).alias("rows"))
    return _round(planes.scan_regions(fields))


@_query(""", size AS (SELECT max(r) + 1 AS n FROM movie),
tiles AS (SELECT 0 AS region, r, c, v FROM movie WHERE t = 3 AND r < 7 UNION ALL SELECT 1, r - n + 7 + 2, c + 24, v FROM movie, size WHERE t = 3 AND r >= n - 7),
seen AS (SELECT r, c, arg_max(v, region) AS v FROM tiles GROUP BY r, c)
SELECT CAST(a AS INT) AS r, CAST(b AS INT) AS c, round(coalesce(v, 0), 6) AS v FROM range(7) y(a) CROSS JOIN range(64) x(b) LEFT JOIN seen ON seen.r = a AND seen.c = b""")
def stitched_tiles(spark: SparkSession, d: str) -> DataFrame:
    regions = spark.createDataFrame([(0, 10.0, 0.0, 20.0, 14.0, 32, 7), (1, 25.0, 4.0, 20.0, 14.0, 32, 7)], "region int, x double, y double, width double, height double, columns int, rows int")
    return _round(planes.stitched(views.movie(spark, d).where("t = 3").drop("t"), regions))


@_query("SELECT r % 2 AS region, CAST(1.5 + 2 * (t % 2) + 10 * (r % 2) AS DOUBLE) AS z, t // 2 AS n, r, c, round(v, 6) AS v FROM movie")
def stack_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = views.movie(spark, d).select((F.col("r") % 2).cast("string").alias("path"), F.col("t").alias("page"), "r", "c", "v")
    modes = spark.createDataFrame([(str(p), g, int(p != g)) for p in (0, 1) for g in (0, 1)], "path string, region int, mode int")
    depths = spark.createDataFrame([(str(p), s, float(k + 1 + 2 * s + 10 * p)) for p in (0, 1) for s in (0, 1) for k in (0, 1)], "path string, side int, z double")
    return _round(planes.stack_pages(pages, modes, depths))


@_query(""", whole AS (SELECT r, c, t, floor(v * 4) AS v FROM movie), n AS (SELECT r, c, v, count(*) AS n FROM whole GROUP BY ALL),
m AS (SELECT r, c, v FROM n QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY n DESC, v) = 1)
SELECT r, c, CAST(trunc(avg(w.v)) AS INT) AS mean, CAST(trunc(stddev_pop(w.v) FILTER (t % 8 = 0)) AS INT) AS deviation, any_value(m.v) AS mode FROM whole w JOIN m USING (r, c) GROUP BY r, c""")
def pixel_figures(spark: SparkSession, d: str) -> DataFrame:
    return planes.pixel_figures(views.movie(spark, d).withColumn("v", F.floor(F.col("v") * 4).cast("double")))


@_query("SELECT r, c, t, CASE WHEN v <= 0 THEN 0 ELSE CAST(trunc(1000 * v) AS INT) END AS v FROM movie")
def whole_positive(spark: SparkSession, d: str) -> DataFrame:
    return planes.whole_positive(views.movie(spark, d).withColumn("v", 1000 * F.col("v")))


@_query("SELECT roi, r, c FROM roi_pixels")
def global_pixels(spark: SparkSession, d: str) -> DataFrame:
    pixels = views.roi_pixels(spark, d)
    corner = pixels.groupBy("roi").agg(F.min("c").alias("x"), F.min("r").alias("y"))
    masks = pixels.join(corner, "roi").select("roi", (F.col("r") - F.col("y")).alias("r"), (F.col("c") - F.col("x")).alias("c"))
    return planes.global_pixels(masks, corner)


@_query(""", i AS (SELECT r, c, v FROM movie WHERE t = 5 AND r >= 2 AND r < (SELECT max(r) FROM movie) - 1 AND c BETWEEN 1 AND 27),
g AS (SELECT a.r, a.c, (coalesce(d.v, a.v) - coalesce(u.v, a.v)) / (CASE WHEN d.v IS NULL OR u.v IS NULL THEN 1 ELSE 2 END) AS gy, (coalesce(e.v, a.v) - coalesce(w.v, a.v)) / (CASE WHEN e.v IS NULL OR w.v IS NULL THEN 1 ELSE 2 END) AS gx
  FROM i a LEFT JOIN i u ON u.r = a.r - 1 AND u.c = a.c LEFT JOIN i d ON d.r = a.r + 1 AND d.c = a.c LEFT JOIN i w ON w.r = a.r AND w.c = a.c - 1 LEFT JOIN i e ON e.r = a.r AND e.c = a.c + 1)
SELECT round(avg(gy * gy + gx * gx), 6) AS acutance FROM g""")
def cropped_acutance(spark: SparkSession, d: str) -> DataFrame:
    return _round(planes.cropped_acutance(views.movie(spark, d).where("t = 5").drop("t"), 2, 2, 1, 4))


@_query("SELECT r, c, t, CAST(round_even(255 * (least(greatest(v, -0.1), 0.15) + 0.1) / 0.25, 0) AS INT) AS v FROM movie WHERE r BETWEEN 3 AND 7 AND c BETWEEN 4 AND 13")
def scaled_window(spark: SparkSession, d: str) -> DataFrame:
    return planes.scaled_window(views.movie(spark, d), (3, 4), (5, 10), limits=(-0.1, 0.15))


@_query(""", e AS (SELECT DISTINCT r, c FROM roi_pixels p WHERE (SELECT count(*) FROM roi_pixels q WHERE q.roi = p.roi AND abs(q.r - p.r) + abs(q.c - p.c) <= 1) < 5)
SELECT m.r, m.c, CASE WHEN e.r IS NULL THEN 10 ELSE 255 END AS red, CASE WHEN e.r IS NULL THEN 20 ELSE 0 END AS green, CASE WHEN e.r IS NULL THEN 30 ELSE 7 END AS blue FROM (SELECT r, c FROM movie WHERE t = 0) m LEFT JOIN e ON e.r = m.r AND e.c = m.c""")
def outlined_regions(spark: SparkSession, d: str) -> DataFrame:
    image = views.movie(spark, d).where("t = 0").select("r", "c", F.lit(10).alias("red"), F.lit(20).alias("green"), F.lit(30).alias("blue"))
    return planes.outlined(image, views.roi_pixels(spark, d), (255, 0, 7), 1.0)


@_query("SELECT roi, CASE WHEN roi % 3 < 2 THEN 'g' || (roi % 3) END AS genotype, CAST(CASE roi % 3 WHEN 0 THEN 0.7 WHEN 1 THEN 0.55 ELSE 0.5 END AS DOUBLE) AS decay, roi % 3 < 2 AND roi % 2 = 0 AS overridden FROM (SELECT DISTINCT roi FROM roi_pixels)")
def decay_times(spark: SparkSession, d: str) -> DataFrame:
    kind, given = F.col("roi") % 3, F.when((F.col("roi") % 3 == 2) | (F.col("roi") % 2 == 0), F.lit(0.5))
    sessions = views.roi_pixels(spark, d).select("roi").distinct().select("roi", F.when(kind < 2, F.concat(F.lit("g"), kind.cast("string"))).alias("genotype"), given.alias("decay"))
    return planes.decay_times(sessions, spark.createDataFrame([("g0", 0.7), ("g1", 0.55)], "genotype string, decay double")).select("roi", "genotype", "decay", "overridden")
