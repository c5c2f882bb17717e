"""Seeds of regions, handed out brightest first, alone or in batches of seeds that lie apart.

A batch is what going through the candidates in order would choose. Whether a candidate is chosen depends on brighter ones near
it only, so rounds find them side by side: one that no undecided brighter candidate is near is chosen, what is near a chosen one
waits for a later batch. Near pairs come from a join over cells of the minimum distance; no task or driver holds all candidates.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.operators.graphs import dilated_pixels
from lumenflow.operators.traces import if_small
from lumenflow.sources.scratch import written

#: Seeds that one job puts into batches where nothing is grown in between.
BLOCK = 16_384

NEVER, BY_REGION, BY_SHARE, PROVIDED = "never considered", "excluded by ROI", "excluded by fraction", "provided"


def image_candidates(image: DataFrame, keep: float, block: int | None = None) -> DataFrame:
    """r, c, v, kept: every pixel of an image or the brightest of each block (first in reading order), of which the brightest share
    is kept; equal ones in reading order."""
    if block is None:
        out = image.select("r", "c", "v")
    else:
        at = lambda c: F.floor(F.col(c) / block)
        best = image.groupBy(at("r").alias("br"), at("c").alias("bc")).agg(F.max(F.struct("v", (-F.col("r")).alias("nr"), (-F.col("c")).alias("nc"))).alias("m"))
        out = best.select((-F.col("m.nr")).alias("r"), (-F.col("m.nc")).alias("c"), F.col("m.v").alias("v"))
    ranked = _ranked(written(out))
    n = ranked.count()
    return ranked.select("r", "c", "v", (F.col("rank") < math.floor(keep * n)).alias("kept"))


def _ranked(candidates: DataFrame) -> DataFrame:
    """With ``rank`` from 0: brightest first, then in reading order. Candidates are sorted over all tasks; a task's first rank is the
    sum of the sizes of those before it."""
    order = [F.desc("v"), F.asc("r"), F.asc("c")]
    n = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(candidates.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    sizes = placed.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # one row for each task
    first, starts = 0, []
    for part, size in sizes:
        starts.append((part, first - (part << 33)))
        first += size
    at = candidates.sparkSession.createDataFrame(starts, "part long, shift long")
    return placed.join(F.broadcast(at), F.shiftright("at", 33) == F.col("part")).select("r", "c", "v", (F.col("at") + F.col("shift")).alias("rank"))


def near_pairs(ranked: DataFrame, distance: float) -> DataFrame:
    """a, b: ranks of candidates less than ``distance`` apart, the brighter one first."""
    if distance <= 0:
        return ranked.sparkSession.createDataFrame([], "a long, b long")
    size = max(1, math.ceil(distance))
    cell = lambda c: F.floor(F.col(c) / size)
    own = ranked.select(F.col("rank").alias("b"), F.col("r").alias("rb"), F.col("c").alias("cb"), cell("r").alias("x"), cell("c").alias("y"))
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    spread = ranked.select(F.col("rank").alias("a"), F.col("r").alias("ra"), F.col("c").alias("ca"), F.explode(steps).alias("s"), cell("r").alias("x0"), cell("c").alias("y0"))
    spread = spread.select("a", "ra", "ca", (F.col("x0") + F.col("s.i")).alias("x"), (F.col("y0") + F.col("s.j")).alias("y"))
    apart = F.hypot(F.col("ra") - F.col("rb"), F.col("ca") - F.col("cb"))
    return spread.join(own, ["x", "y"]).where((F.col("a") < F.col("b")) & (apart < distance)).select("a", "b")


def chosen_apart(ranks: DataFrame, near: DataFrame, most: int) -> DataFrame:
    """rank of the first ``most`` candidates that going through ``ranks`` in order and leaving out what is near a chosen one gives."""
    undecided, chosen = ranks.select("rank"), None
    near = near.join(ranks.select(F.col("rank").alias("a")), "a", "left_semi").join(ranks.select(F.col("rank").alias("b")), "b", "left_semi").select("a", "b")
    while True:
        open_pairs = near.join(undecided.select(F.col("rank").alias("a")), "a", "left_semi")
        free = undecided.join(open_pairs.select(F.col("b").alias("rank")), "rank", "left_anti")
        free = written(free)
        taken = near.join(free.select(F.col("rank").alias("a")), "a", "left_semi").select(F.col("b").alias("rank"))
        undecided = written(undecided.join(free, "rank", "left_anti").join(taken, "rank", "left_anti"))
        chosen = free if chosen is None else chosen.unionAll(free)
        first = undecided.agg(F.min("rank")).first()[0]
        sure = chosen if first is None else chosen.where(F.col("rank") < first)
        if first is None or sure.limit(most).count() == most:
            return sure.orderBy("rank").limit(most)


class Seeds:
    """Candidates (r, c, v, and kept, all if missing) that are handed out. Between two calls pixels of finished regions may be
    excluded; a seed on one of them, or within ``buffer`` rows and columns, is passed over once it is met."""

    def __init__(self, candidates: DataFrame, samples: int = 1, distance: float = 0.0, buffer: int = 1):
        kept = candidates if "kept" in candidates.columns else candidates.withColumn("kept", F.lit(True))
        self.samples, self.buffer, self.batch = samples, buffer, 0
        self.late = kept.where("not kept").select("r", "c", "v")
        self.left = written(_ranked(kept.where("kept").select("r", "c", "v")))
        self.near = written(near_pairs(self.left, distance))
        self.barred: DataFrame | None = None
        self.given: list[DataFrame] = []
        self.passed: list[DataFrame] = []

    def exclude(self, pixels: DataFrame) -> None:
        """Bars the pixels (r, c) of a finished region, and those around them."""
        more = dilated_pixels(pixels, self.buffer)
        self.barred = written(more if self.barred is None else self.barred.unionAll(more).distinct())

    def next(self) -> DataFrame | None:
        """batch, k, r, c, v of the next seeds, brightest first; None when no candidate is left."""
        if self.left.isEmpty():
            return None
        blocked = self.left.where("false") if self.barred is None else self.left.join(if_small(self.barred), ["r", "c"], "left_semi")
        free = self.left if self.barred is None else self.left.join(if_small(self.barred), ["r", "c"], "left_anti")
        ranks = [x["rank"] for x in chosen_apart(free, self.near, self.samples).collect()]  # one batch
        # those behind the last seed of a full batch were not met
        met = blocked.where(F.col("rank") < ranks[-1]) if len(ranks) == self.samples else blocked
        self.passed.append(written(met))
        numbers = self.left.sparkSession.createDataFrame([(x, k) for k, x in enumerate(ranks)], "rank long, k int")
        batch = written(self.left.join(F.broadcast(numbers), "rank").select(F.lit(self.batch).alias("batch"), "k", "r", "c", "v", "rank"))
        self.left = written(self.left.join(F.broadcast(numbers), "rank", "left_anti").join(self.passed[-1].select("rank"), "rank", "left_anti"))
        self.given.append(batch)
        self.batch += 1
        return batch.drop("rank")

    def log(self) -> DataFrame:
        """r, c, v, status, batch of all candidates: provided, or why not."""
        mark = lambda df, status: df.select("r", "c", "v", F.lit(status).alias("status"), (F.col("batch") if status == PROVIDED else F.lit(None)).cast("int").alias("batch"))
        out = mark(self.late, BY_SHARE).unionAll(mark(self.left, NEVER))
        for rows, status in (*((g, PROVIDED) for g in self.given), *((p, BY_REGION) for p in self.passed)):
            out = out.unionAll(mark(rows, status))
        return out


def _placing(samples: int, distance: float, begun: int):
    """A rule that gives batch, k and room (of its batch, in the end) to a block of seeds in order of rank; those that have a batch
    are the earlier members of batches with room. New batches are numbered from ``begun``."""
    size = max(1, math.ceil(distance))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        seeds = list(zip(rows["r"].tolist(), rows["c"].tolist()))
        batch = [-1 if x != x else int(x) for x in rows["batch"].astype(float)]
        place = [-1 if x != x else int(x) for x in rows["k"].astype(float)]
        count, cells, following = dict.fromkeys(sorted({b for b in batch if b >= 0}), 0), {}, begun
        for i, (r, c) in enumerate(seeds):
            x, y = r // size, c // size
            if batch[i] < 0:
                around = [p for dx in (-1, 0, 1) for dy in (-1, 0, 1) for p in cells.get((x + dx, y + dy), ())] if distance > 0 else []
                near = {b for r1, c1, b in around if math.hypot(r - r1, c - c1) < distance}
                batch[i] = next((b for b in count if b not in near), following)
                following = max(following, batch[i] + 1)
                place[i] = count.get(batch[i], 0)
            count[batch[i]] = count.get(batch[i], 0) + 1
            if count[batch[i]] == samples:
                del count[batch[i]]
            cells.setdefault((x, y), []).append((r, c, batch[i]))
        return rows.assign(batch=batch, k=place, room=[b in count for b in batch])

    return run


def seed_batches(candidates: DataFrame, excluded: DataFrame, samples: int = 10, distance: float = 20.0) -> DataFrame:
    """batch, k, r, c: all seeds (r, c, v) in batches whose members are at least ``distance`` apart. Seeds on excluded pixels have none.

    As no region is grown in between, each seed goes to the first batch with room and no seed near it. Blocks of ``BLOCK`` seeds go
    through in order, each a job of its own; a block hands the members of the batches that have room on to the next. A batch is
    begun only if all of these hold a seed near the new one, so they are at most one more than the seeds within ``distance`` of a pixel.
    """
    spark = candidates.sparkSession
    kinds = dict(candidates.dtypes)
    seeds = _ranked(candidates.join(if_small(excluded.select("r", "c").distinct()), ["r", "c"], "left_anti").select("r", "c", "v"))
    seeds = written(seeds.select("rank", "r", "c"))
    schema = f"rank long, r {kinds['r']}, c {kinds['c']}, batch int, k int, room boolean"
    out, held, begun = spark.createDataFrame([], schema), None, 0
    for first in range(0, seeds.count(), BLOCK):
        block = seeds.where(F.col("rank").between(first, first + BLOCK - 1)).select("*", *(F.lit(None).cast("int").alias(c) for c in ("batch", "k")))
        rows = block if held is None else block.unionByName(held.select("rank", "r", "c", "batch", "k"))
        placed = written(rows.groupBy(F.col("rank") < 0).applyInPandas(_placing(samples, distance, begun), schema))
        begun = max(begun, placed.agg(F.max("batch")).first()[0] + 1)
        out = out.unionAll(placed.where(F.col("rank") >= first))
        held = placed.where("room")
    return out.select("batch", "k", "r", "c")


def grown(seeds: Seeds, grow) -> DataFrame:
    """The log of handing out all seeds, with what ``grow`` makes of each batch (its pixels r, c) excluded before the next."""
    while (batch := seeds.next()) is not None:
        seeds.exclude(grow(batch))
    return seeds.log()
