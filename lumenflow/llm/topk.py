"""Exact top-k search by a Voronoi join, with the integer inner product as score.

Vectors are grouped by the pivot of the nearest direction; a cell is divided into rings by the angle
to its pivot, and of each ring a summary is kept: rows, angles and norms from least to greatest. The
angle between a query and a vector of a ring is at least the gap between the query's angle to the
pivot and the ring's angles, which bounds the ring's scores from above.

A query is first solved in the rings with its highest bounds that hold more than k vectors; the k-th
score found is a floor, and only rings whose bound reaches it are looked at afterwards. Data is cut into
blocks of bounded size and so are queries, homes next to each other in one block; a block of data meets
the blocks of queries that need it, where scores are one matrix product and only scores that reach the
floor go on. Queries are copied to the rings that they need, a block of data once for each block of queries
that needs it. Where directions hold no structure (independent random vectors of many components) no bound
can rule anything out and all blocks meet: the work is then that of the stated query set against all rows.

Defined cases: null vectors and vectors with null or non-finite components take no part; vectors of
different lengths have no score, so each length is searched by itself; a query leaves out its own row only:
rows that repeat its vec_id are others' rows; ties go to the smaller vec_id, null last; a null vec_id is
no query; fewer than k candidates give fewer rows; an empty table gives no rows; extra columns are ignored.
Sums are exact up to 2 ** 53.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.llm._common import materialize, session

K = 20
SCALE = 64
#: Pivots of a length: one for each _PER_PIVOT of its vectors, up to PIVOTS; they are a bounded sample.
PIVOTS, PER_PIVOT = 1024, 2048
#: Rows in a block of data and of queries.
DATA_BLOCK, QUERY_BLOCK = 8192, 8192
#: Steps of the angle to the pivot that rings are made of.
STEPS = 64
#: Angles are taken to be this much smaller, for what rounding does to them.
_CARE = 1e-6
#: Stands for a null vec_id inside a search.
_NO_ID = 2**63 - 1


def _usable(v: Column) -> Column:
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(ok, F.lit(False))


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and x, the integer vector, of all usable rows, each with a row number of its own."""
    ok = vectors.where(_usable(F.col("embedding"))).select(F.coalesce(F.col("vec_id").cast("long"), F.lit(_NO_ID)).alias("vec_id"), F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double")).alias("x"))
    return ok.withColumn("row", F.monotonically_increasing_id())


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _angles(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norm of each row and its angle to each pivot (pivots are unit vectors; a zero row counts as at angle 0)."""
    norm = np.sqrt((x**2).sum(1))
    cosine = np.where(norm[:, None] > 0, x @ pivots.T / np.maximum(norm, 1e-300)[:, None], 1.0)
    return norm, np.arccos(np.clip(cosine, -1, 1))


class Index:
    """Pivots of each vector length and summaries of the rings; cells and blocks are numbered over all lengths."""

    def __init__(self, picked: pd.DataFrame):
        self.pivots: dict[int, np.ndarray] = {}
        self.base: dict[int, int] = {}
        cells = 0
        for width, rows in picked.groupby("width"):
            x = np.unique(_matrix(rows["x"]), axis=0)
            norm = np.sqrt((x**2).sum(1))
            x = x[norm > 0] / norm[norm > 0][:, None] if (norm > 0).any() else np.eye(1, int(width))
            self.pivots[int(width)], self.base[int(width)] = x, cells
            cells += len(x)
        self.cells = cells

    def summarize(self, s: pd.DataFrame) -> None:
        """From rows, queries, angles and norms by cell and step: rings of whole steps, their blocks, and blocks of queries."""
        s = s.sort_values(["cell", "step"])
        cell, n = s["cell"].to_numpy(), s["n"].to_numpy()
        self.ring_of = np.full((self.cells, STEPS), -1, np.int64)
        rings: list[list] = []
        asked = np.zeros(self.cells, np.int64)
        for k in range(len(s)):
            asked[cell[k]] += s["asked"].iloc[k]
            if not rings or rings[-1][0] != cell[k] or rings[-1][1] + n[k] > DATA_BLOCK:
                rings.append([cell[k], 0, np.inf, -np.inf, np.inf, -np.inf])
            ring = rings[-1]
            ring[1] += n[k]
            for at, f, name in ((2, min, "a0"), (3, max, "a1"), (4, min, "n0"), (5, max, "n1")):
                ring[at] = f(ring[at], s[name].iloc[k])
            self.ring_of[cell[k], s["step"].iloc[k]] = len(rings) - 1
        table = np.array(rings, float).reshape(-1, 6)
        self.ring_cell, self.rows = table[:, 0].astype(np.int64), table[:, 1].astype(np.int64)
        self.near, self.far, self.short, self.long = table[:, 2:].T
        self.blocks = -(-self.rows // DATA_BLOCK)
        self.first_block = np.cumsum(self.blocks) - self.blocks
        self.home_block = np.cumsum(asked) // QUERY_BLOCK
        self.home_parts = np.maximum(1, -(-asked // QUERY_BLOCK))

    def bounds(self, x: np.ndarray, width: int) -> np.ndarray:
        """The highest score that each query may have in each ring of its length, as far as the summaries tell."""
        own, base = self.pivots[width], self.base[width]
        norm, angle = _angles(x, own)
        rings = self.rings(width)
        angle = angle[:, self.ring_cell[rings] - base]
        gap = np.maximum(np.maximum(angle - self.far[rings], self.near[rings] - angle) - _CARE, 0)
        cosine = np.cos(np.minimum(gap, np.pi))
        return norm[:, None] * np.where(cosine >= 0, self.long[rings], self.short[rings]) * cosine * (1 + 1e-9) + 1e-6

    def rings(self, width: int) -> np.ndarray:
        base = self.base[width]
        return np.flatnonzero((self.ring_cell >= base) & (self.ring_cell < base + len(self.pivots[width])))


def _by_width(f: pd.DataFrame):
    """The row numbers and vectors of each length in a frame."""
    width = f["x"].map(len).to_numpy()
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        yield int(w), at, _matrix(f["x"].iloc[at])


def _assign(index):
    def run(frames):
        for f in frames:
            cell, angle, norm = np.zeros(len(f), np.int32), np.zeros(len(f)), np.zeros(len(f))
            for w, at, x in _by_width(f):
                own, angles = _angles(x, index.value.pivots[w])
                best = angles.argmin(1)
                cell[at], angle[at], norm[at] = best + index.value.base[w], angles[np.arange(len(at)), best], own
            yield f.assign(cell=cell, angle=angle, norm=norm, step=np.minimum((angle / np.pi * STEPS).astype(np.int32), STEPS - 1))

    return run


def _wants(index, k: int, floors: bool):
    """For each query the blocks to look at: those of its most promising rings with more than ``k`` rows in all or, where
    a floor is known, of all further rings that reach it."""

    def run(frames):
        ix = index.value
        for f in frames:
            out = []
            for w, at, x in _by_width(f):
                bound, rings = ix.bounds(x, w), ix.rings(w)
                order = np.argsort(-bound, axis=1, kind="stable")
                held = np.cumsum(ix.rows[rings][order], axis=1)
                first = np.zeros(bound.shape, bool)
                np.put_along_axis(first, order, (held - ix.rows[rings][order]) <= k, 1)
                need = ~first & (bound >= f["floor"].to_numpy()[at][:, None]) if floors else first
                who, ring = np.nonzero(need)
                ring = rings[ring]
                count = ix.blocks[ring]
                who, ring = at[np.repeat(who, count)], np.repeat(ring, count)
                block = ix.first_block[ring] + np.arange(len(ring)) - np.repeat(np.cumsum(count) - count, count)
                home = f["cell"].to_numpy()[who]
                part = f["row"].to_numpy()[who] % ix.home_parts[home]
                columns = {c: f[c].to_numpy()[who] for c in ("row", "vec_id", "x", "floor")}
                out.append(pd.DataFrame(columns | {"block": block, "q_block": ix.home_block[home] * 1_000_000 + part}))
            if out:
                yield pd.concat(out)

    return run


def _blocks(index):
    def run(frames):
        ix = index.value
        for f in frames:
            ring = ix.ring_of[f["cell"].to_numpy(), f["step"].to_numpy()]
            yield pd.DataFrame({"row": f["row"], "vec_id": f["vec_id"], "x": f["x"], "block": ix.first_block[ring] + f["row"].to_numpy() % ix.blocks[ring]})

    return run


def _solve(k: int):
    def run(key, data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({"q_row": [], "query_id": [], "vec_id": [], "row": [], "score": []}).astype("int64")
        order = np.lexsort((data["row"], data["vec_id"]))
        ids, rows, x = data["vec_id"].to_numpy()[order], data["row"].to_numpy()[order], _matrix(data["x"])[order]
        out = []
        for lo in range(0, len(queries), 256):
            part = queries.iloc[lo : lo + 256]
            score = np.rint(_matrix(part["x"]) @ x.T)
            score[part["row"].to_numpy()[:, None] == rows[None, :]] = -np.inf
            score[score < part["floor"].to_numpy()[:, None]] = -np.inf
            take = min(k, len(rows))
            edge = np.partition(score, len(rows) - take, axis=1)[:, len(rows) - take]
            who, at = np.nonzero((score >= edge[:, None]) & np.isfinite(score))
            ranked = np.lexsort((at, -score[who, at], who))  # ties keep the smaller vec_id
            who, at = who[ranked], at[ranked]
            keep = np.arange(len(who)) - np.searchsorted(who, who) < k
            who, at = who[keep], at[keep]
            out.append(pd.DataFrame({"q_row": part["row"].to_numpy()[who], "query_id": part["vec_id"].to_numpy()[who], "vec_id": ids[at], "row": rows[at], "score": score[who, at].astype(np.int64)}))
        return pd.concat(out)

    return run


_FOUND = "q_row long, query_id long, vec_id long, row long, score long"
_ASKED = "row long, vec_id long, x array<double>, floor double, block long, q_block long"


def _meet(data: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The best of each block for each query that wants it. A block of data goes once to each block of queries."""
    wanted = asked.select(F.col("block").alias("of_block"), F.col("q_block").alias("to_block")).distinct()
    sent = data.join(wanted, data["block"] == wanted["of_block"]).select("row", "vec_id", "x", "of_block", "to_block")
    return sent.groupBy("of_block", "to_block").cogroup(asked.groupBy("block", "q_block")).applyInPandas(_solve(k), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_row", "query_id").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _likely(points: DataFrame, pivots: int, per_pivot: int) -> DataFrame:
    """Rows that a hash picks, about ``64 + 4 * wanted`` of each length, where ``wanted`` pivots are to be had."""
    wanted = F.least(F.lit(pivots), F.ceil(F.col("count") / per_pivot))
    sizes = points.groupBy("width").count().select("width", wanted.alias("wanted"), ((64 + 4 * wanted) / F.col("count")).alias("share"))
    place = F.xxhash64("row") / 2.0**64 + 0.5  # rows are numbered, so copies are picked one by one
    return points.join(sizes, "width").where(place < F.col("share"))


def _picked(points: DataFrame, pivots: int, per_pivot: int) -> DataFrame:
    """The pivots: one for ``per_pivot`` vectors of a length, up to ``pivots``. Only rows that a hash picks are put in order, so
    no task sees all vectors of a length; should it pick too few, which with 64 to spare hardly happens, there are fewer pivots."""
    order = Window.partitionBy("width").orderBy(F.xxhash64("row"), "row")
    return _likely(points, pivots, per_pivot).withColumn("r", F.row_number().over(order)).where(F.col("r") <= F.col("wanted"))


class Search:
    """The steps of a search, so that what each sends can be looked at."""

    def __init__(self, vectors: DataFrame, k: int = K, every: int = 20, scale: int = SCALE, pivots: int = PIVOTS, per_pivot: int = PER_PIVOT):
        spark, self.k = session(vectors), k
        self.points = materialize(scaled(vectors, scale).withColumn("width", F.size("x")))
        picked = _picked(self.points, pivots, per_pivot).select("width", "x").toPandas()  # at most ``pivots`` of a length
        index = Index(picked)
        held = spark.sparkContext.broadcast(index)  # its size is bounded by the pivots
        assigned = self.points.mapInPandas(_assign(held), "vec_id long, x array<double>, row long, width int, cell int, angle double, norm double, step int")
        self.assigned = materialize(assigned)
        query = (F.col("vec_id") % every == 0) & (F.col("vec_id") != _NO_ID)
        index.summarize(self.assigned.groupBy("cell", "step").agg(
            F.count("*").alias("n"), F.count_if(query).alias("asked"), F.min("angle").alias("a0"), F.max("angle").alias("a1"), F.min("norm").alias("n0"), F.max("norm").alias("n1"),
        ).toPandas())  # fmt: skip  # at most STEPS rows for each pivot
        self.index = index
        self.held = spark.sparkContext.broadcast(index)
        self.data = self.assigned.select("row", "vec_id", "x", "cell", "step").mapInPandas(_blocks(self.held), "row long, vec_id long, x array<double>, block long")
        self.queries = self.assigned.where(query).select("row", "vec_id", "x", "cell")

    def first(self) -> DataFrame:
        """Each query with the blocks that give its floor."""
        return self.queries.withColumn("floor", F.lit(float("-inf"))).mapInPandas(_wants(self.held, self.k, False), _ASKED)

    def further(self, found: DataFrame) -> DataFrame:
        """Each query with the blocks that may still hold one of its k best."""
        least = found.where(F.col("rank") == self.k).select(F.col("q_row").alias("row"), F.col("score").cast("double").alias("floor"))
        known = self.queries.join(least, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        return known.select("row", "vec_id", "x", "cell", "floor").mapInPandas(_wants(self.held, self.k, True), _ASKED)

    def result(self) -> DataFrame:
        near = materialize(_best(_meet(self.data, self.first(), self.k), self.k))
        rest = _meet(self.data, self.further(near), self.k)
        return _best(near.drop("rank").unionByName(rest), self.k).select("query_id", F.col("rank").cast("int").alias("rank"), F.nullif(F.col("vec_id"), F.lit(_NO_ID)).alias("vec_id"), "score")


def top_k(vectors: DataFrame, k: int = K, every: int = 20, scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score for the queries: rows whose vec_id is divisible by ``every``."""
    return Search(vectors, k, every, scale, pivots).result()


SQL = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x) AS score FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM k WHERE rank <= {K}"""
