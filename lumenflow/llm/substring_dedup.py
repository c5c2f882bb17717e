"""Removal of word spans that also occur earlier, by compacted de Bruijn paths.

Every run of ``size`` words of a document is an edge of a de Bruijn graph whose nodes
are the overlaps of ``size - 1`` words. Documents are read once:

1. *Edges.* Consecutive windows with the same least inner k-gram (their minimizer) travel
   together, so that equal windows meet in the bucket of their minimizer. Windows that
   repeat within an Arrow batch are resolved on the spot; only the first of them is
   shuffled, so a passage that fills the corpus sends one row per batch, not one per copy.
   Windows of a minimizer that is very frequent, in a sample of the documents, travel alone,
   by their own hash: a short run of words within many different texts fills no bucket.
2. *Paths.* In a bucket every edge that repeats an earlier one gets the coordinates of that
   source. Neighbouring edges with the same source shift form a path without a branch;
   pieces of one path from different buckets are put together by a windowed Spark job.
3. *Verification.* Both ends of each path are read again by coordinate, and the words are
   compared by an independent digest. If any differ (a hash collision), the whole job runs
   again with another seed, so no result ever rests on an unchecked hash.

Defined cases: a null text has no words; documents shorter than ``size`` words lose none;
a null doc_id counts as smaller than every other; different texts under one doc_id are one
document's texts with separate coordinates, and a window at the same doc_id and start is
not earlier than itself, so identical rows get identical results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.llm import _text as tx
from lumenflow.llm._common import materialize, session, text_key

WINDOW = 20
#: Text bytes for each shuffle bucket; the number of buckets follows the input.
BUCKET_BYTES = 6 << 20
#: A minimizer of more windows than this, a quarter of a bucket, is divided by the windows' own hashes.
HOT_WINDOWS = 1 << 18
#: Most minimizers that are so divided; each of the others has less than this part of all windows.
HOT_KEYS = 100_000
#: One document in so many is counted to find them.
SAMPLE_RATE = 64
_KGRAM = 8
_NULL_ID = np.iinfo(np.int64).min
_PIECES = "doc_id long, text_key long, start int, n int, src_id long, src_key long, src_start int"


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column.cast(pa.int64()).fill_null(_NULL_ID))


def _repeats(key, doc, start):
    """Which entries have an earlier equal one, and the index of the earliest. Entries come by (doc, start)."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    source = np.empty(len(k), np.int64)
    source[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return (doc[source] != doc) | (start[source] != start), source


def _paths(flagged, group, row, start, source):
    """Runs of flagged windows that follow each other and whose sources do too: (first, count)."""
    at = np.flatnonzero(flagged)
    if not len(at):
        return at, at
    s = source[at]
    joined = (np.diff(at) == 1) & (np.diff(group[at]) == 0) & (np.diff(row[s]) == 0) & (np.diff(start[s]) == 1)
    head = np.flatnonzero(np.concatenate([[True], ~joined]))
    return at[head], np.diff(np.concatenate([head, [len(at)]]))


def _pack(parts: dict[str, np.ndarray]) -> bytes:
    raw = b"".join(x.tobytes() for x in parts.values())
    head = np.array([len(raw), *(len(x) for x in parts.values())], np.int64).tobytes()
    return head + pa.compress(raw, codec="zstd", asbytes=True)


_FIELDS = {"ids": np.int64, "keys": np.int64, "g_row": np.uint32, "g_start": np.int32, "g_n": np.uint8, "g_min": np.uint64, "tags": np.uint8, "p_row": np.uint32, "p_start": np.int32, "p_n": np.int32, "p_src": np.uint32, "p_from": np.int32}


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    head = np.frombuffer(blob, np.int64, len(_FIELDS) + 1)
    raw = pa.decompress(blob[head.nbytes :], decompressed_size=int(head[0]), codec="zstd", asbytes=True)
    out, at = {}, 0
    for (name, kind), n in zip(_FIELDS.items(), head[1:]):
        out[name] = np.frombuffer(raw, kind, int(n), at)
        at += int(n) * np.dtype(kind).itemsize
    return out


def _windows(batch, size: int, seed: int):
    """All windows of a batch by (doc_id, text): ids and keys of its rows, then row, start, edge and minimizer of
    each window, whether it has an earlier equal one in the batch, and which that is. None without windows."""
    k = min(_KGRAM, size)
    words = tx.words_of(batch.column("text"))
    ids, keys = _ids(batch.column("doc_id")), _ids(batch.column("text_key"))
    n_words = np.diff(words.first)
    by_id = np.lexsort((keys, ids))
    h = tx.hash_words(words, seed)
    edge = tx.window_hash(h, size, seed)
    least = tx.sliding_min(tx.window_hash(h, k, seed + 1), size - k + 1)
    del h
    per_row = np.maximum(n_words - size + 1, 0)[by_id]
    total = int(per_row.sum())
    if not total:
        return None
    row = np.repeat(by_id, per_row)
    start = np.arange(total) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    at = words.first[row] + start
    edge, least = edge[at], least[at]
    return ids, keys, row, start, edge, least, *_repeats(edge, ids[row], start)


def _counted(size: int, seed: int):
    """Windows that a batch would send for each minimizer."""

    def run(batches):
        for batch in batches:
            found = _windows(batch, size, seed)
            if found is not None:
                least, flagged = found[5], found[6]
                minimizers, n = np.unique(least[~flagged], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(minimizers.view(np.int64)), pa.array(n.astype(np.int64))], ["least", "n"])

    return run


def hot_minimizers(keyed: DataFrame, size: int, seed: int, windows: int, rate: int = SAMPLE_RATE) -> np.ndarray:
    """Minimizers of more than ``windows`` windows, sorted, by one document in ``rate``; HOT_KEYS at most, the
    most frequent first. They say which windows travel alone; results don't depend on them."""
    some = keyed.where(F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), F.lit(rate)) == 0)
    counts = some.mapInArrow(_counted(size, seed), "least long, n long").groupBy("least").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") * rate > windows).orderBy(F.desc("n"), "least").limit(HOT_KEYS).collect()
    return np.sort(np.array([r["least"] for r in rows], np.int64).view(np.uint64))


def _edge_batches(size: int, buckets: int, seed: int, hot: np.ndarray):
    def run(batches):
        for batch in batches:
            found = _windows(batch, size, seed)
            if found is None:
                continue
            ids, keys, row, start, edge, least, flagged, source = found
            total = len(row)
            if len(hot):
                # a window of a frequent minimizer goes by its own hash
                least = np.where(hot[np.minimum(np.searchsorted(hot, least), len(hot) - 1)] == least, edge, least)
            turn = np.ones(total, bool)
            turn[1:] = (row[1:] != row[:-1]) | (least[1:] != least[:-1])
            p_at, p_n = _paths(flagged, row, row, start, source)
            live = np.flatnonzero(~flagged)
            cut = np.ones(len(live), bool)
            cut[1:] = (np.diff(live) != 1) | turn[live[1:]]
            head = np.flatnonzero(cut)
            g_at, g_n = live[head], np.diff(np.concatenate([head, [len(live)]]))
            # a group has at most size - k + 1 windows per occurrence of its minimizer; long ties are cut
            while len(g_n) and g_n.max() > 255:
                big = g_n > 255
                g_at = np.concatenate([g_at, g_at[big] + 255])
                g_n = np.concatenate([np.minimum(g_n, 255), g_n[big] - 255])
            bucket = ((tx.mix(least[g_at] + tx.U64(77)) >> tx.U64(11)) % tx.U64(buckets)).astype(np.int64)
            order = np.lexsort((g_at, bucket))
            g_at, g_n, bucket = g_at[order], g_n[order], bucket[order]
            p_bucket = (tx.mix(edge[p_at]) % tx.U64(buckets)).astype(np.int64)
            order = np.argsort(p_bucket, kind="stable")
            p_at, p_n, p_bucket = p_at[order], p_n[order], p_bucket[order]
            edges = np.arange(buckets + 1)
            g_cut, p_cut = np.searchsorted(bucket, edges), np.searchsorted(p_bucket, edges)
            out_b, out = [], []
            for b in np.flatnonzero((np.diff(g_cut) > 0) | (np.diff(p_cut) > 0)):
                g, gn = g_at[g_cut[b] : g_cut[b + 1]], g_n[g_cut[b] : g_cut[b + 1]]
                p, pn = p_at[p_cut[b] : p_cut[b + 1]], p_n[p_cut[b] : p_cut[b + 1]]
                inner = np.repeat(g - (np.cumsum(gn) - gn), gn) + np.arange(int(gn.sum()))
                used, new = np.unique(np.concatenate([row[g], row[p], row[source[p]]]), return_inverse=True)
                tags = edge[inner].view(np.uint8).reshape(-1, 8)[:, :5]
                rows = np.split(new.astype(np.uint32), [len(g), len(g) + len(p)])
                values = [ids[used], keys[used], rows[0], start[g], gn, least[g], np.ascontiguousarray(tags).ravel(), rows[1], start[p], pn, rows[2], start[source[p]]]
                out_b.append(b)
                out.append(_pack({name: v.astype(kind, copy=False) for (name, kind), v in zip(_FIELDS.items(), values)}))
            yield pa.RecordBatch.from_arrays([pa.array(out_b, pa.int32()), pa.array(out, pa.binary())], ["bucket", "blob"])

    return run


def _nullable(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == _NULL_ID)


def _resolve(table: pa.Table) -> pa.Table:
    """All edges of a bucket: what repeats within batches passes through, what repeats across them is found."""
    parts = [_unpack(x) for x in table.column("blob").to_pylist()]
    base = np.cumsum([0, *(len(p["ids"]) for p in parts)])
    both = {name: np.concatenate([p[name] for p in parts]) for name in _FIELDS}
    ids, keys = both["ids"], both["keys"]

    def rows(name):
        return np.concatenate([p[name].astype(np.int64) + b for p, b in zip(parts, base)])

    g_row, n = rows("g_row"), both["g_n"].astype(np.int64)
    first = np.cumsum(n) - n
    order = np.lexsort((both["g_start"], keys[g_row], ids[g_row]))
    n, g_row = n[order], g_row[order]
    at = np.repeat(first[order] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    tag = np.zeros((len(at), 8), np.uint8)
    tag[:, :5] = both["tags"].reshape(-1, 5)[at]
    key = tx.mix(np.repeat(tx.mix(both["g_min"][order]), n) ^ tag.view(np.uint64).ravel())
    row = np.repeat(g_row, n)
    start = np.repeat(both["g_start"][order], n) + (np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n))
    flagged, source = _repeats(key, ids[row], start)
    p_at, p_n = _paths(flagged, np.repeat(np.arange(len(n)), n), row, start, source)
    own = np.concatenate([rows("p_row"), row[p_at]])
    src = np.concatenate([rows("p_src"), row[source[p_at]]])
    columns = [
        _nullable(ids[own]), pa.array(keys[own]), pa.array(np.concatenate([both["p_start"], start[p_at]]).astype(np.int32)), pa.array(np.concatenate([both["p_n"], p_n]).astype(np.int32)),
        _nullable(ids[src]), pa.array(keys[src]), pa.array(np.concatenate([both["p_from"], start[source[p_at]]]).astype(np.int32)),
    ]
    return pa.table(columns, names=[x.split()[0] for x in _PIECES.split(", ")])


def repeated_spans(docs: DataFrame, size: int = WINDOW, seed: int = 0, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """Maximal paths of windows that also start earlier: doc_id, text_key, start, n (windows), src_id, src_key, src_start."""
    session(docs)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    total = docs.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(8, -(-int(total) // BUCKET_BYTES))
    hot = hot_minimizers(keyed, size, seed, hot_windows)
    pieces = keyed.mapInArrow(_edge_batches(size, buckets, seed, hot), "bucket int, blob binary").groupBy("bucket").applyInArrow(_resolve, _PIECES)
    path = ["doc_id", "text_key", "src_id", "src_key", "shift"]
    w = Window.partitionBy(*path).orderBy("start")
    linked = pieces.withColumn("shift", F.col("src_start") - F.col("start")).withColumn("turn", (F.col("start") != F.lag(F.col("start") + F.col("n")).over(w)).cast("int"))
    linked = linked.withColumn("path", F.sum(F.coalesce("turn", F.lit(1))).over(w))
    return linked.groupBy(*path, "path").agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n"), F.min("src_start").alias("src_start")).drop("shift", "path")


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, checks array<struct<at: long, h: long>>"


def _apply(size: int, with_text: bool):
    def run(batches):
        for batch in batches:
            ids, n_words, n_removed, shas, kept_texts, checks = [], [], [], [], [], []
            for doc_id, text, own, asked in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "own", "asked"))):
                words = (text or "").encode().split()
                seen = []
                gone = np.zeros(len(words), bool)
                for at, start, n in [(x["at"], x["start"], x["n"]) for x in own or ()]:
                    gone[start : start + n + size - 1] = True
                    seen.append((at, start, n))
                seen += [(x["at"], x["start"], x["n"]) for x in asked or ()]
                checks.append([{"at": at, "h": xxhash.xxh3_64_intdigest(b" ".join(words[s : s + n + size - 1])) - 2**63} for at, s, n in seen])
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if own else words)
                ids.append(doc_id)
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(shas, pa.string()), pa.array(kept_texts, pa.string()), pa.array(checks, pa.list_(pa.struct([("at", pa.int64()), ("h", pa.int64())])))],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "checks"],
            )

    return run


def remove_repeats(docs: DataFrame, size: int = WINDOW, with_text: bool = True, tries: int = 5) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept: the words left, joined by a space."""
    for seed in range(0, 2 * tries, 2):
        spans = materialize(repeated_spans(docs, size, seed))
        place = F.xxhash64("src_id", "src_key", "src_start", "n")
        own = spans.select("doc_id", "text_key", F.lit(0).alias("role"), F.struct(place.alias("at"), "start", "n").alias("span"))
        # many copies ask one source for the same span: it answers once
        asked = spans.select("src_id", "src_key", "src_start", "n").distinct()
        asked = asked.select(F.col("src_id").alias("doc_id"), F.col("src_key").alias("text_key"), F.lit(1).alias("role"), F.struct(place.alias("at"), F.col("src_start").alias("start"), "n").alias("span"))
        by_doc = own.unionByName(asked).groupBy("doc_id", "text_key").agg(
            F.collect_list(F.when(F.col("role") == 0, F.col("span"))).alias("own"), F.collect_list(F.when(F.col("role") == 1, F.col("span"))).alias("asked"))
        keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text").alias("d")
        joined = keyed.join(by_doc.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_key") == F.col("s.text_key")), "left").select("d.doc_id", "d.text", "s.own", "s.asked")
        result = materialize(joined.mapInArrow(_apply(size, with_text), _RESULT))
        wrong = result.select(F.explode("checks").alias("c")).groupBy("c.at").agg((F.min("c.h") != F.max("c.h")).alias("differs")).where("differs")
        if wrong.isEmpty():
            return result.drop("checks") if with_text else result.drop("checks", "kept")
    raise RuntimeError("window hashes collided under every seed tried")
