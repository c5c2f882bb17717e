"""SimHash near-duplicates found by covering locality-sensitive hashing.

Each of the 64 bits gets a random vector of ``radius + 1`` bits; every non-zero vector v
gives a mask of the bits whose vector has an odd product with v. ``radius`` differing bits
never span the space, so some mask leaves all of them out: every pair within the radius
agrees under at least one of the ``2 ** (radius + 1) - 1`` masks. No pair can be missed.

Fingerprints are first reduced to distinct ones. In a bucket the links found are handed on
as a local forest (at most one edge per member), never as all pairs, and large buckets are
divided, across tasks too, by parts of the fingerprint, one of which must agree.

Defined cases: null and empty texts have fingerprint zero and link like any other; fewer
words than a shingle make one shingle of all words; a row without doc_id gets a fingerprint
and a null component; repeated rows each get the same result; an empty table gives an empty one;
extra columns of any name are ignored, and kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm import _text as tx
from lumenflow.llm._common import materialize, private, quoted, session, text_key
from lumenflow.llm._components import components

RADIUS = 3
SHINGLE = 3
_BLOCK = 1 << 17
#: A bucket of more distinct fingerprints than this is divided across tasks; that many keys of such buckets are broadcast.
HOT, HOT_BROADCAST = 1 << 16, 100_000


def _bit_counts(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of each row's hashes have each bit (lowest first). Rows are bounds[i] to bounds[i + 1]."""
    out = np.zeros((len(bounds) - 1, 64), np.int64)
    for lo in range(0, len(h), _BLOCK):
        part = h[lo : lo + _BLOCK]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.searchsorted(bounds, lo, "right") - 1
        last = np.searchsorted(bounds, lo + len(part), "left")
        cuts = np.clip(bounds[first:last] - lo, 0, None)
        rows = np.arange(first, last)
        full = np.flatnonzero(np.diff(np.append(cuts, len(part))) > 0)
        out[rows[full]] += np.add.reduceat(bits, cuts[full], axis=0, dtype=np.int64)
    return out


def fingerprints_of(column: pa.Array, shingle: int = SHINGLE, seed: int = 42) -> np.ndarray:
    words = tx.lowered(tx.words_of(column))
    n = np.diff(words.first)
    per_row = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    at = np.arange(int(bounds[-1])) + np.repeat(words.first[:-1] - bounds[:-1], per_row)
    last = at + np.repeat(np.minimum(n, shingle), per_row) - 1
    h = np.empty(len(at), np.uint64)
    for lo in range(0, len(at), _BLOCK):
        part = slice(lo, lo + _BLOCK)
        h[part] = tx.xxh64(words.buf, words.starts[at[part]], words.ends[last[part]], seed)
    ones = 2 * _bit_counts(h, bounds) > per_row[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = 42) -> DataFrame:
    """doc_id, text_key and the 64-bit fingerprint (as a signed long) of every row."""
    session(docs)

    def run(batches):
        for batch in batches:
            values = fingerprints_of(batch.column("text"), shingle, seed)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(values.view(np.int64))], ["doc_id", "text_key", "fp"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    return own.mapInArrow(run, "doc_id long, text_key long, fp long")


def covering_masks(radius: int = RADIUS, seed: int = 7) -> list[int]:
    """The masks of a covering family for 64 bits, as signed longs."""
    vectors = np.random.default_rng(seed).integers(1, 2 ** (radius + 1), 64)
    masks = []
    for v in range(1, 2 ** (radius + 1)):
        mask = sum(1 << i for i, x in enumerate(vectors) if bin(int(x) & v).count("1") % 2)
        masks.append(mask - 2**64 if mask >= 2**63 else mask)
    return masks


def _union(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the classes of each pair; labels hold the least index of a class."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(labels, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def forest(fp: np.ndarray, radius: int) -> np.ndarray:
    """The least index that each fingerprint reaches through links within these."""
    labels = np.arange(len(fp))
    views = [np.arange(len(fp))]
    if len(fp) > 256:  # radius differing bits leave one of radius + 1 parts of the bits alone
        width = 64 // (radius + 1)
        views = [np.argsort((fp >> np.uint64(width * k)) & np.uint64(2**width - 1), kind="stable") for k in range(radius + 1)]
    for k, order in enumerate(views):
        x = fp[order]
        part = (x >> np.uint64(64 // (radius + 1) * k)) & np.uint64(2 ** (64 // (radius + 1)) - 1) if len(views) > 1 else np.zeros(len(x), np.uint64)
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        for lo, hi in zip(cuts, cuts[1:]):
            for a in range(lo, hi, 512):
                for b in range(a, hi, 512):
                    i, j = np.nonzero(np.bitwise_count(x[a : min(a + 512, hi), None] ^ x[None, b : min(b + 512, hi)]) <= radius)
                    _union(labels, order[a + i], order[b + j])
    return labels


def _bucket_links(radius: int):
    """Streams rows sorted by bucket; a bucket may span batches."""

    def links(fp, cut):
        a, b = [], []
        size = np.diff(cut)
        two = cut[:-1][size == 2]
        close = np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius
        a.append(fp[two[close]])
        b.append(fp[two[close] + 1])
        for lo, n in zip(cut[:-1][size > 2], size[size > 2]):
            labels = forest(fp[lo : lo + n], radius)
            moved = np.flatnonzero(labels != np.arange(n))
            a.append(fp[lo + labels[moved]])
            b.append(fp[lo + moved])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        waiting: list[list[np.ndarray]] = []
        rows = 0

        def flush(last):
            nonlocal held, waiting, rows
            table, key, fp = (np.concatenate([h, *(w[k] for w in waiting)]) for k, h in enumerate(held))
            waiting, rows = [], 0
            new = np.concatenate([[True], (table[1:] != table[:-1]) | (key[1:] != key[:-1])])
            cut = np.flatnonzero(new)
            end = len(table) if last else cut[-1]
            held = [x[end:] for x in (table, key, fp)]
            return links(fp[:end].view(np.uint64), np.append(cut[cut < end], end))

        for batch in batches:
            waiting.append([np.asarray(batch.column(k)) for k in range(3)])
            rows += batch.num_rows
            if rows >= 1 << 16:
                yield flush(False)
        if rows or len(held[0]):
            yield flush(True)

    return run


def _dealt(classes: DataFrame, radius: int) -> DataFrame:
    """(t, key, fp): each fingerprint under every mask."""
    tables = F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for k, m in enumerate(covering_masks(radius))]))
    return classes.select("fp", tables.alias("x")).select("x.t", "x.key", "fp")


def _split_hot(classes: DataFrame, radius: int, hot: int | None = None, sample: int = 64) -> DataFrame:
    """Fingerprints by bucket. Buckets of more than ``hot`` fingerprints, by a sample, are divided by the bits: of
    radius + 1 parts one must agree, so every fingerprint goes to the bucket of each of its parts."""
    hot = hot or HOT
    dealt, some = _dealt(classes, radius), classes.where(F.pmod(F.xxhash64("fp"), F.lit(sample)) == 0)
    large = materialize(_dealt(some, radius).groupBy("t", "key").count().where(F.col("count") * sample > hot).select("t", "key", F.lit(1).alias("large")))
    n = large.limit(HOT_BROADCAST + 1).count()
    if not n:
        return dealt
    known = dealt.join(F.broadcast(large) if n <= HOT_BROADCAST else large, ["t", "key"], "left")
    width = 64 // (radius + 1)
    parts = [F.struct((F.col("t") + 1000 * (k + 1)).alias("t"), F.xxhash64("key", F.shiftrightunsigned("fp", width * k).bitwiseAND(F.lit(2**width - 1).cast("long"))).alias("key")) for k in range(radius + 1)]
    whole = F.array(F.struct("t", "key"))
    return known.select("fp", F.explode(F.when(F.col("large").isNull(), whole).otherwise(F.array(*parts))).alias("x")).select("x.t", "x.key", "fp")


def link_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, first, best): each distinct fingerprint, its least document (doc_id, text_key) and that of its component.

    Fingerprints are the nodes, so that different texts under one doc_id stay apart.
    """
    known = prints.where("doc_id is not null")
    classes = materialize(known.groupBy("fp").agg(F.min(F.struct("doc_id", "text_key")).alias("first")))
    dealt = _split_hot(classes, radius)
    edges = dealt.repartition("t", "key").sortWithinPartitions("t", "key", "fp").mapInArrow(_bucket_links(radius), "a long, b long").distinct()
    roots = components(edges)
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return rooted.join(rooted.groupBy("root").agg(F.min("first").alias("best")), "root").select("fp", "first", "best")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id of every row of documents."""
    prints = materialize(fingerprints(docs, shingle))
    classes = link_classes(prints, radius).select("fp", F.col("best.doc_id").alias("component"))
    return prints.join(classes, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, that of the least doc_id and text_key; rows without doc_id stay.

    Rows that repeat doc_id and text are one document: the one least by the other columns stays. Different
    texts under one doc_id are different documents. Other columns may have any name.
    """
    best = link_classes(materialize(fingerprints(docs, shingle)), radius).select("best.*").distinct()
    own, row, at_id, at_key = private(docs, "own_key", "row", "best_id", "best_key")
    best = best.select(F.col("doc_id").alias(at_id), F.col("text_key").alias(at_key))
    known = docs.where("doc_id is not null").withColumn(own, text_key(F.col("text")))
    known = known.join(best, (F.col("doc_id") == F.col(at_id)) & (F.col(own) == F.col(at_key)), "left_semi")
    order = F.struct(*(quoted(c) for c, kind in docs.dtypes if c != "text" and "map<" not in kind and "variant" not in kind))
    one = known.groupBy("doc_id", own).agg(F.min_by(F.struct(*(quoted(c) for c in docs.columns)), order).alias(row))
    return one.select(f"{row}.*").unionByName(docs.where("doc_id is null"))
