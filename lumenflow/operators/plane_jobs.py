"""Whole jobs on the regions of a plane: taking the crosstalk of another plane out, and demixing regions that overlap.

Both go through stages. What a stage gives is a table under the job's folder; a job that was lost reads the tables that are whole and
goes on from there. When no region is left, later tables are empty, with their columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.functions.scalars import unmix
from lumenflow.operators import analysis, checks, decrosstalk, rois, selection, signals, traces
from lumenflow.operators.traces import if_small
from lumenflow.sources.scratch import kept

#: What a region's traces are: those of its pixels and of its surroundings, in its own plane and in the other one.
CHANNELS = ("signal", "crosstalk", "np_signal", "np_crosstalk")
NAN = float("nan")


@dataclass(frozen=True)
class Rules:
    """Threshold of activity, frames that an event spreads to on both sides, frames around an event of the other plane that are not
    independent of it, fits of a region, and size and deviations of the clipping of dips."""

    threshold: float = 14.0
    spread: int = 20
    window: int = 2
    fits: int = 10
    clip_size: int = 1980
    clip_sigmas: float = 2.0


@dataclass
class Crosstalk:
    """Tables of a job. ``failed``: roi, stage, one row for each list that a region is on (raw, raw_active, unmixed, unmixed_active,
    ghost). ``raw``: roi, t, the channels, valid. ``raw_events`` and ``unmixed_events``: roi, channel (0 signal, 1 crosstalk), t, f of
    active frames. ``unmixed``: roi, t, the channels, signal and np_signal before they were clipped, and valid. ``mixing``: roi, the
    region's matrix and whether its own fit converged."""

    failed: DataFrame
    raw: DataFrame
    raw_events: DataFrame
    mixing: DataFrame
    unmixed: DataFrame
    unmixed_events: DataFrame


def _gap(c: str) -> Column:
    return F.col(c).isNull() | F.isnan(c)


def _marked(wide: DataFrame) -> DataFrame:
    """With ``valid``: no channel of the region has a gap. A channel that ends early has gaps behind its end."""
    bad = wide.groupBy("roi").agg(F.max(F.greatest(*(_gap(c).cast("int") for c in CHANNELS))).alias("bad"))
    return wide.join(if_small(bad), "roi").withColumn("valid", F.col("bad") == 0).drop("bad")


def _stacked(wide: DataFrame, first: str, second: str) -> DataFrame:
    """Two columns as traces of their own: key (twice the region, plus one for the second), t, f."""
    pair = F.array(*(F.struct((F.col("roi") * 2 + k).alias("key"), F.col(c).alias("f")) for k, c in enumerate((first, second))))
    return wide.select("t", F.inline(pair)).select(F.col("key").cast("long").alias("roi"), F.col("t").cast("long").alias("t"), "f")


def _events(wide: DataFrame, rules: Rules) -> DataFrame:
    """roi, channel, t, f of the active frames of signal and crosstalk."""
    both = _stacked(wide, "signal", "crosstalk")
    active = traces.dilate(analysis.active_frames(both, rules.threshold), rules.spread).where("active").select("roi", "t")
    return both.join(active, ["roi", "t"]).select(F.floor(F.col("roi") / 2).alias("roi"), (F.col("roi") % 2).cast("int").alias("channel"), "t", "f")


def _seeds(wide: DataFrame, events: DataFrame) -> DataFrame:
    """roi, seed: the whole light of the frames without events, so that a region's fit can be repeated."""
    quiet = wide.join(events.where("channel = 0").select("roi", "t"), ["roi", "t"], "left_anti").groupBy("roi").agg(F.rint(F.sum(F.abs("signal"))).alias("light"))
    return wide.select("roi").distinct().join(quiet, "roi", "left").select("roi", F.pmod(F.coalesce("light", F.lit(0.0)).cast("long"), F.lit(2**32)).alias("seed"))


def _unmixed(wide: DataFrame, mixing: DataFrame, rules: Rules) -> DataFrame:
    """The channels of regions and surroundings unmixed by each region's matrix (NaN without one), and dips of both signals clipped."""
    m = [F.col(f"m{i}{j}") for i in (0, 1) for j in (0, 1)]
    both = wide.join(if_small(mixing), "roi")
    out = {}
    for a, b in (("signal", "crosstalk"), ("np_signal", "np_crosstalk")):
        out[a], out[b] = (F.coalesce(x, F.lit(NAN)).alias(c) for x, c in zip(unmix(*m, F.col(a), F.col(b)), (a, b)))
    plain = both.select("roi", "t", *out.values())
    events = _events(plain.where(~F.isnan("signal")), rules).where("channel = 0")
    active = events.select(F.explode(F.array(F.col("roi") * 2, F.col("roi") * 2 + 1)).alias("roi"), "t", F.lit(True).alias("active"))
    clipped = analysis.clip_negative(_stacked(plain, "signal", "np_signal"), active, rules.clip_size, rules.clip_sigmas)
    side = lambda k, c: clipped.where(F.col("roi") % 2 == k).select(F.floor(F.col("roi") / 2).alias("roi"), "t", F.col("f").alias(c))
    before = plain.withColumnsRenamed({"signal": "unclipped_signal", "np_signal": "np_unclipped_signal"})
    return before.join(side(0, "signal"), ["roi", "t"]).join(side(1, "np_signal"), ["roi", "t"])


def take_out_crosstalk(channels: DataFrame, path: str, rules: Rules = Rules()) -> Crosstalk:
    """Runs the job on roi, t, signal, crosstalk, np_signal, np_crosstalk, with its tables under ``path``.

    A region goes on while its raw traces have no gaps, its raw signal has active frames, the unmixed traces have no gaps and the
    unmixed signal has active frames; what is left is a ghost if none of its active frames is independent of the other plane's. If no
    fit converges, all regions fail as unmixed. The seed of a fit comes from the trace, so the job gives the same when repeated.
    """
    spark = channels.sparkSession
    at = lambda name, make: kept(spark, f"{path}/{name}", make)
    regions = lambda df: df.select("roi").distinct()
    wide = channels.select(F.col("roi").cast("long").alias("roi"), F.col("t").cast("long").alias("t"), *(F.col(c).cast("double").alias(c) for c in CHANNELS))

    raw = at("raw", lambda: _marked(wide))
    good = raw.where("valid").drop("valid")
    raw_events = at("raw_events", lambda: _events(good, rules))
    active = good.join(if_small(regions(raw_events.where("channel = 0"))), "roi", "left_semi")
    own = at("own_mixing", lambda: decrosstalk.mixings(active.join(if_small(_seeds(active, raw_events)), "roi"), rules.fits))
    mixing = at("mixing", lambda: _with_mean(own))
    unmixed = at("unmixed", lambda: _marked(_unmixed(active, mixing, rules)))
    plain = unmixed.where("valid")
    unmixed_events = at("unmixed_events", lambda: _events(plain, rules))
    own_events, other = (unmixed_events.where(F.col("channel") == k).select("roi", "t") for k in (0, 1))
    lists = {
        "raw": regions(raw.where("not valid")),
        "raw_active": regions(good).join(regions(raw_events.where("channel = 0")), "roi", "left_anti"),
        "unmixed": regions(unmixed.where("not valid")),
        "unmixed_active": regions(plain).join(regions(own_events), "roi", "left_anti"),
        "ghost": checks.ghosts(own_events, other, rules.window).where("ghost").select("roi"),
    }

    def failed() -> DataFrame:
        out = None
        for stage, rows in lists.items():
            named = rows.select("roi", F.lit(stage).alias("stage"))
            out = named if out is None else out.unionAll(named)
        return out

    return Crosstalk(at("failed", failed), raw, raw_events, mixing, unmixed, unmixed_events)


def _with_mean(own: DataFrame) -> DataFrame:
    """Each region's matrix; where its fit did not converge, the mean one, or null if no fit did."""
    names = ["m00", "m01", "m10", "m11"]
    mean = signals.mean_mixing(own).select(F.lit(1).alias("k"), *(F.col(c).alias(f"mean_{c}") for c in names))  # one row at most
    both = own.withColumn("k", F.lit(1)).join(F.broadcast(mean), "k", "left")
    return both.select("roi", *(F.when(F.col("converged"), F.col(c)).otherwise(F.col(f"mean_{c}")).alias(c) for c in names), "converged")


def without_crosstalk(job: Crosstalk, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """roi, t, f of all regions for the next step, NaN where a region failed or is a ghost, and the stage flags of each."""
    out = job.unmixed.join(job.failed.select("roi").distinct(), "roi", "left_anti").select("roi", "t", F.col("signal").alias("f"))
    ids = regions.select(F.col("roi").cast("long").alias("roi"))
    return decrosstalk.with_invalid(out, ids), decrosstalk.stage_flags(ids, job.failed)


@dataclass
class Demixed:
    """``traces``: roi, t, f of all regions. ``listed``: roi, reason (excluded, negative_transient, negative_baseline); those excluded
    or with a negative baseline are NaN in all frames. ``frames``: t of frames that were dropped, as a region had no light in them."""

    traces: DataFrame
    listed: DataFrame
    frames: DataFrame


def demix_job(movie: DataFrame, pixels: DataFrame, labels: DataFrame, path: str, barred: list[str], window: int = 500, run: int = 10, sigmas: float = 3.0) -> Demixed:
    """Demixes the regions (roi, r, c) that no barred label excludes (labels: roi, exclusion_labels), with the tables under ``path``.

    A region with a negative baseline fails together with all that share pixels with it or with one that does, as light was
    shared out among them wrongly; one with a baseline near zero fails alone. Negative transients are listed only.
    """
    spark = movie.sparkSession
    at = lambda name, make: kept(spark, f"{path}/{name}", make)
    allowed = selection.without_labels(labels, barred).where("coalesce(valid, true)").select("roi")
    inside = pixels.join(if_small(allowed), "roi", "left_semi")
    shared = at("shared", lambda: checks.demix(movie, inside))
    own = shared.select("roi", "t", "f")

    def listed() -> DataFrame:
        flags = traces.baseline_flags(own)
        negative = flags.where("negative_baseline").select("roi")
        bad = rois.overlapping(inside, negative).union(flags.where("zero_baseline").select("roi")).distinct()
        parts = {"excluded": labels.select("roi").distinct().join(allowed, "roi", "left_anti"), "negative_transient": traces.negative_transients(own, window, run, sigmas), "negative_baseline": bad}
        out = None
        for reason, rows in parts.items():
            named = rows.select(F.col("roi").cast("long").alias("roi"), F.lit(reason).alias("reason"))
            out = named if out is None else out.unionAll(named)
        return out

    reasons = at("listed", listed)
    failed = reasons.where("reason <> 'negative_transient'").select("roi").distinct()
    good = own.join(if_small(failed), "roi", "left_anti")
    blank = pixels.select("roi").distinct().join(good.select("roi").distinct(), "roi", "left_anti")
    frames = movie.select("t").distinct()
    empty = frames.join(if_small(blank)).select("roi", "t", F.lit(NAN).alias("f"))
    return Demixed(good.unionByName(empty), reasons, shared.where("dropped").select("t").distinct())
