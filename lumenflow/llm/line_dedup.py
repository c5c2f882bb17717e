"""Near-duplicate lines by an exact set-similarity join with rarity-ordered prefixes.

A line is the set of its words. Its tokens are ordered by rarity: counts over all lines, held
for 2 ** 20 hash classes of words, so that the table of counts has a fixed size; any fixed order
keeps the join exact, and this one keeps the prefixes rare. Two sets with Jaccard similarity of
at least the threshold share a token of their prefixes, so lines meet in the buckets of their
prefix tokens, where length and position bound the possible overlap, and the parities of hash
classes of their words (64 classes, and in step with the length more for longer lines) bound the
difference from below. Surviving pairs read both lines again by
coordinate and are verified; for that, one scan of the documents writes the lines on a map of
wanted coordinates, whose size is fixed and which only spares work.

A line goes if any earlier line (by doc_id, then line number, on the input) is similar. One
witness is enough, so no group emits all its pairs: equal sets (by 128 bits of their words' hashes;
in an Arrow batch by all of them) reduce to their first line, those of a batch before the shuffle, so that a line in all documents sends one entry per batch to
its tokens' buckets; a token with very many different lines is dealt to cells, one for each pair of
its parts; a line asks its earliest few candidates first, and only lines without a witness ask further ones,
in rounds, until none is left to ask. No candidate is dropped.

Defined cases: lines end at a newline; a line without words never goes; a null text has no
lines; a null doc_id comes before all others; different texts under one doc_id come in the
order of their hash; identical rows get identical decisions; extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm import _text as tx
from lumenflow.llm._common import private, quoted, session, store, text_key

SIMILARITY = 0.8
#: Text bytes for each shuffle bucket.
BUCKET_BYTES = 6 << 20
_CLASS_BITS = 20
_CLASSES = 1 << _CLASS_BITS
_CLASS_SHIFT = np.uint64(64 - _CLASS_BITS)
#: Groups up to the first size are tested pair by pair in whole arrays; larger ones ask in rounds, those up to the second together.
_SMALL, _MIDDLE = 24, 1024
#: Pairs tested at once.
_PAIRS = 1 << 19
#: A line of more than so many words has twice, four times ... the 64 parities; up to 2 ** _DOUBLINGS times.
_NARROW, _DOUBLINGS = 72, 5
#: Candidates that a line gets from a large group by the end of the first round, and the growth of that number.
_FIRST, _GROWTH = 2, 16
#: Bits of the map of wanted lines.
_MAP_BITS = 1 << 26
_NULL_ID = np.iinfo(np.int64).min
_PLACE = ("doc_id", "text_key", "line")
#: A prefix token with more entries than this, by a sample of one document in _SAMPLE, is dealt to cells for pairs of its parts.
_PART, _SAMPLE = 1 << 16, 64


def _lines(column: pa.Array):
    """Words, the row and number of each line, and its range of words."""
    words = tx.words_of(column)
    _, offsets = tx.column_bytes(column)
    breaks = np.flatnonzero(words.buf[: int(offsets[-1])] == 10)
    at = np.searchsorted(breaks, offsets)
    count = np.diff(at) + 1
    row = np.repeat(np.arange(len(count)), count)
    number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][row]
    later = number > 0
    start[later] = breaks[(at[:-1][row] + number - 1)[later]] + 1
    bounds = np.append(np.searchsorted(words.starts, start), len(words.starts))
    return words, row, number, bounds


def _count_batches(batches):
    """Words of each class, and the bytes of all texts as class -1."""
    counts, size = np.zeros(_CLASSES, np.int64), 0
    for batch in batches:
        size += int(tx.column_bytes(batch.column("text"))[1][-1])
        counts += np.bincount((tx.hash_words(tx.words_of(batch.column("text"))) >> _CLASS_SHIFT).astype(np.int64), minlength=_CLASSES)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(counts[at], size))], ["class", "n"])


def rarity(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For each hash class of words its rank, rarest first (2 ** 20 numbers whatever the corpus), and the bytes of all texts."""
    session(docs)
    rows = docs.select("text").mapInArrow(_count_batches, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_CLASSES + 1, np.int64)
    counts[np.asarray(rows.column("class"))] = np.asarray(rows.column("n"))
    rank = np.empty(_CLASSES, np.uint32)
    rank[np.argsort(counts[:-1], kind="stable")] = np.arange(_CLASSES, dtype=np.uint32)
    return rank, int(counts[-1])


def _order(first: np.ndarray, then: np.ndarray, bits: int) -> np.ndarray:
    """Order by ``first`` (of ``bits`` bits), then ``then``: one sort of 64-bit numbers, unless they tie."""
    both = (first.astype(np.uint64) << np.uint64(64 - bits)) | (then >> np.uint64(bits))
    order = np.argsort(both)
    both, key = both[order], then[order]
    return np.lexsort((then, first)) if ((both[1:] == both[:-1]) & (key[1:] != key[:-1])).any() else order


def _sets(words: tx.Words, bounds: np.ndarray, rank: np.ndarray):
    """Distinct tokens of each line, rarest first: keys, line of each, and their ranges."""
    h = tx.hash_words(words)
    key = (rank[(h >> _CLASS_SHIFT).astype(np.int64)] << _CLASS_SHIFT) | (h & ((np.uint64(1) << _CLASS_SHIFT) - np.uint64(1)))
    line = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = _order(line, key, max(1, len(bounds).bit_length()))
    key, line = key[order], line[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
    key, line = key[new], line[new]
    return key, line, np.searchsorted(line, np.arange(len(bounds)))


def _least_overlap(n: np.ndarray, similarity: float) -> np.ndarray:
    return np.ceil(similarity * n - 1e-9).astype(np.int64)


def _slack(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """By how many words two similar sets of these sizes may differ at most."""
    return a + b - 2 * np.ceil(similarity / (1 + similarity) * (a + b) - 1e-9)


def _doublings(n: np.ndarray) -> np.ndarray:
    return np.clip(np.ceil(np.log2(np.maximum(n, 1) / _NARROW)), 0, _DOUBLINGS).astype(np.int64)


class _Wide:
    """The wide parities of lines of more than _NARROW words, one run of 64-bit words for each line."""

    def __init__(self, n: np.ndarray, flat: np.ndarray | None = None):
        self.n, self.level = n.astype(np.int64), _doublings(n)
        self.size = np.where(self.level > 0, 1 << self.level, 0)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.zeros(int(self.size.sum()), np.uint64) if flat is None else flat
        self.folded: list[tuple] | None = None

    def add(self, line: np.ndarray, mixed: np.ndarray) -> None:
        on = np.flatnonzero(self.level[line] > 0)
        line, mixed = line[on], mixed[on]
        word = self.at[line] + ((mixed >> np.uint64(6)) & (self.size[line] - 1).astype(np.uint64)).astype(np.int64)
        np.bitwise_xor.at(self.flat, word, np.uint64(1) << (mixed & np.uint64(63)))

    def of(self, lines: np.ndarray) -> np.ndarray:
        """The runs of these lines, one after the other."""
        size = self.size[lines]
        return self.flat[np.repeat(self.at[lines] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]

    def _fold(self) -> list[tuple]:
        """For each width the lines that have it or a wider one, folded to it: row of each line, and rows."""
        out: list[tuple] = []
        lines, rows = np.zeros(0, np.int64), np.zeros((0, 2 << _DOUBLINGS), np.uint64)
        for k in range(_DOUBLINGS, 0, -1):
            own = np.flatnonzero(self.level == k)
            half = rows.shape[1] // 2
            rows = np.concatenate([rows[:, :half] ^ rows[:, half:], self.flat[self.at[own][:, None] + np.arange(1 << k)]])
            lines = np.concatenate([lines, own])
            row_of = np.zeros(len(self.n), np.int32)
            row_of[lines] = np.arange(len(lines))
            out.append((row_of, rows))
        return out[::-1]

    def near(self, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
        """Whether the lines of each pair may be similar, by the parities that both have."""
        ok = np.ones(len(a), bool)
        level = np.minimum(self.level[a], self.level[b])
        if self.folded is None and level.any():
            self.folded = self._fold()
        for k in range(1, _DOUBLINGS + 1):
            pairs = np.flatnonzero(level == k)
            for p in np.array_split(pairs, -(-len(pairs) << k >> 20) or 1) if len(pairs) else ():
                row_of, rows = self.folded[k - 1]
                gap = np.bitwise_count(rows[row_of[a[p]]] ^ rows[row_of[b[p]]]).sum(axis=1, dtype=np.int64)
                ok[p] = gap <= _slack(self.n[a[p]], self.n[b[p]], similarity)
        return ok


#: Arrays of a packed row: a table of texts, entries (a token of a line's prefix), and lines that repeat one of their batch.
_FIELDS = {"ids": np.int64, "keys": np.int64, "l_row": np.uint32, "l_line": np.int32, "l_n": np.int32, "l_set": np.uint64, "l_more": np.uint64, "l_bits": np.uint64, "e_line": np.uint32, "e_token": np.uint8, "e_at": np.uint32, "l_wide": np.uint64, "r_row": np.uint32, "r_line": np.int32, "r_from_row": np.uint32, "r_from_line": np.int32}


def _pack(values: list[np.ndarray]) -> bytes:
    arrays = [np.ascontiguousarray(v.astype(kind, copy=False)) for v, kind in zip(values, _FIELDS.values())]
    raw = b"".join(a.tobytes() for a in arrays)
    return np.array([len(raw), *map(len, arrays)], np.int64).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    head = np.frombuffer(blob, np.int64, len(_FIELDS) + 1)
    raw, out, at = pa.decompress(blob[head.nbytes :], decompressed_size=int(head[0]), codec="zstd", asbytes=True), {}, 0
    for (name, kind), n in zip(_FIELDS.items(), head[1:]):
        out[name] = np.frombuffer(raw, kind, int(n), at)
        at += int(n) * np.dtype(kind).itemsize
    return out


def _prefixes(batch, rank: np.ndarray, similarity: float):
    """Lines with words in order of place, the first line of each one's set in the batch, and the prefix entries of those
    first lines: line, token and place in the prefix."""
    words, row, number, bounds = _lines(batch.column("text"))
    ids, keys = np.asarray(batch.column("doc_id")), np.asarray(batch.column("text_key"))
    key, line_of, at = _sets(words, bounds, rank)
    n = np.diff(at)
    live = np.flatnonzero(n)
    mixed, spread = tx.mix(key), tx.mix(key ^ np.uint64(5))
    start = at[live] if len(live) else np.zeros(0, np.int64)
    sets = tx.mix(np.add.reduceat(mixed, start) ^ tx.mix(n[live].astype(np.uint64))) if len(live) else np.zeros(0, np.uint64)
    more = tx.mix(np.add.reduceat(spread, start)) if len(live) else np.zeros(0, np.uint64)
    bits = np.bitwise_xor.reduceat(np.uint64(1) << (spread & np.uint64(63)), start) if len(live) else np.zeros(0, np.uint64)
    wide = _Wide(n)
    wide.add(line_of, spread)
    order = np.lexsort((number[live], keys[row[live]], ids[row[live]]))
    live, sets, more, bits = live[order], sets[order], more[order], bits[order]
    _, first, group = np.unique(sets, return_index=True, return_inverse=True)
    head = first[group]
    # a line with the hash of an earlier one must hold the same words
    again = np.flatnonzero((head != np.arange(len(live))) & (n[live] == n[live[head]]))
    size = n[live[again]]
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    differ = key[np.repeat(at[live[again]], size) + step] != key[np.repeat(at[live[head[again]]], size) + step]
    same = np.zeros(len(live), bool)
    same[again] = ~np.logical_or.reduceat(differ, np.cumsum(size) - size) if len(again) else True
    head = np.where(same, head, np.arange(len(live)))
    own = np.flatnonzero(head == np.arange(len(live)))
    prefix = n[live[own]] - _least_overlap(n[live[own]], similarity) + 1
    entry = np.repeat(own, prefix)
    place = np.arange(len(entry)) - np.repeat(np.cumsum(prefix) - prefix, prefix)
    return ids, keys, row, number, n, live, sets, more, bits, wide, head, entry, key[at[live[entry]] + place], place


def _token_batches(rank_of, similarity: float):
    """Entries of each prefix token."""

    def run(batches):
        rank = np.frombuffer(rank_of.value, np.uint32).astype(np.uint64)
        for batch in batches:
            token, n = np.unique(_prefixes(batch, rank, similarity)[-2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])

    return run


def hot_tokens(keyed: DataFrame, rank_of, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Prefix tokens with too many entries for one task, in order, and the number of parts of each. They come from
    a sample: which tokens are split bears on the load of the tasks only."""
    some = keyed.where(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(_SAMPLE)) == 0)
    counts = some.mapInArrow(_token_batches(rank_of, similarity), "token long, n long").groupBy("token").agg((F.sum("n") * _SAMPLE).alias("n"))
    rows = counts.where(F.col("n") > _PART).toArrow()  # at most one for each _PART entries
    token, n = np.asarray(rows.column("token")).view(np.uint64), np.asarray(rows.column("n"))
    order = np.argsort(token)
    return token[order], -(-n[order] // _PART)


def _split(entry: np.ndarray, token: np.ndarray, place: np.ndarray, sets: np.ndarray, hot: np.ndarray, parts: np.ndarray):
    """Entries of hot tokens, once for each cell: a pair of parts, so that any two entries share a cell. Equal sets share a part."""
    at = np.minimum(np.searchsorted(hot, token), len(hot) - 1)
    on = np.flatnonzero(hot[at] == token)
    k = parts[at[on]].astype(np.int64)
    part = (tx.mix(sets[entry[on]] ^ np.uint64(9)) % k.astype(np.uint64)).astype(np.int64)
    again = np.repeat(np.arange(len(on)), k)
    other = np.arange(len(again)) - np.repeat(np.cumsum(k) - k, k)
    part = part[again]
    cell = (np.minimum(part, other) << 32) | np.maximum(part, other)
    rest = np.flatnonzero(hot[at] != token)
    used = np.concatenate([rest, on[again]])
    return entry[used], np.concatenate([token[rest], tx.mix(token[on[again]] ^ tx.mix(cell.astype(np.uint64) + np.uint64(1)))]), place[used]


def _entry_batches(rank_of, buckets: int, similarity: float, hot: np.ndarray, parts: np.ndarray):
    def run(batches):
        rank = np.frombuffer(rank_of.value, np.uint32).astype(np.uint64)
        for batch in batches:
            ids, keys, row, number, n, live, sets, more, bits, wide, head, entry, token, place = _prefixes(batch, rank, similarity)
            if not len(live):
                continue
            if len(hot):
                entry, token, place = _split(entry, token, place, sets, hot, parts)
            # a line whose set the batch has earlier has its witness: it takes no part but goes to a bucket of its own
            r = np.flatnonzero(head != np.arange(len(live)))
            late, early = live[r], live[head[r]]
            r = np.flatnonzero((ids[row[late]] != ids[row[early]]) | (keys[row[late]] != keys[row[early]]) | (number[late] != number[early]))
            late, early = late[r], early[r]
            r_bucket = (tx.mix(tx.mix(ids[row[late]].view(np.uint64) ^ tx.mix(keys[row[late]].view(np.uint64))) + number[late].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            r_order = np.argsort(r_bucket, kind="stable")
            late, early, r_cut = late[r_order], early[r_order], np.searchsorted(r_bucket[r_order], np.arange(buckets + 1))
            bucket = (tx.mix(token) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            out_b, out = [], []
            for b in np.flatnonzero((np.diff(cut) > 0) | (np.diff(r_cut) > 0)):
                e, f, g = order[cut[b] : cut[b + 1]], late[r_cut[b] : r_cut[b + 1]], early[r_cut[b] : r_cut[b + 1]]
                own, at_line = np.unique(entry[e], return_inverse=True)
                lines = live[own]
                used, at_row = np.unique(np.concatenate([row[lines], row[f], row[g]]), return_inverse=True)
                at_row, f_row, g_row = np.split(at_row, [len(lines), len(lines) + len(f)])
                out_b.append(b)
                out.append(_pack([ids[used], keys[used], at_row, number[lines], n[lines], sets[own], more[own], bits[own], at_line, tx.mix(token[e]).view(np.uint8).reshape(-1, 8)[:, 3:].ravel(), place[e], wide.of(lines), f_row, number[f], g_row, number[g]]))
            yield pa.RecordBatch.from_arrays([pa.array(out_b, pa.int32()), pa.array(out, pa.binary())], ["bucket", "blob"])

    return run


def _places(prefix: str) -> str:
    return f"{prefix}_doc_id long, {prefix}_text_key long, {prefix}_line int"


def _possible(n: np.ndarray, at: np.ndarray, bits: np.ndarray, late: np.ndarray, early: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the pairs of entries (arrays of places in the others) may be of similar lines: each pair shares the
    tokens at its places of their prefixes. The parities decide most pairs, so they come first."""
    sums = n[late] + n[early]
    slack = _slack(sums, 0, similarity)
    left = np.flatnonzero(np.bitwise_count(bits[late] ^ bits[early]) <= slack)
    late, early, sums, slack = late[left], early[left], sums[left], slack[left]
    a, b, i, j = n[late], n[early], at[late], at[early]
    need = (sums - slack) / 2
    first = (i + need <= a) & (j + need <= b)  # holds for the first token that a similar pair shares
    return left[first & (np.minimum(i, j) + np.minimum(a - i, b - j) >= need) & (np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9)]


def _ask_together(n, at, bits, own: np.ndarray, wide: _Wide, who: np.ndarray, base: np.ndarray, hi: int, similarity: float):
    """The first ``hi`` candidates of each asking entry among those from ``base`` up to it, and who has more.
    Groups are in order of place; entries of many groups ask at once."""
    late, early, more = [], [], []
    count = who - base
    cuts = np.searchsorted(np.cumsum(count), np.arange(_PAIRS, int(count.sum()) + _PAIRS, _PAIRS))
    for lo, end in zip(np.append(0, cuts + 1), cuts + 1):
        part, m = who[lo:end], count[lo:end]
        asker = np.repeat(np.arange(len(part)), m)
        b = np.arange(len(asker)) - np.repeat(np.cumsum(m) - m - base[lo:end], m)
        ok = _possible(n, at, bits, part[asker], b, similarity)
        ok = ok[wide.near(own[part[asker[ok]]], own[b[ok]], similarity)]
        asker, b = asker[ok], b[ok]
        order = np.arange(len(asker)) - np.searchsorted(asker, asker)
        late.append(part[asker[order < hi]])
        early.append(b[order < hi])
        more.append(part[asker[order == hi]])
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(late), join(early), join(more)


def _ask(members: dict[str, np.ndarray], own: np.ndarray, wide: _Wide, who: np.ndarray, lo: int, hi: int, similarity: float):
    """Candidates number lo to hi of each asking member, and who has more. Members are in order of place,
    ``own`` are their lines in ``wide``."""
    late, early, more = [], [], []
    for k in range(0, len(who), 256):
        part = who[k : k + 256]
        seen = np.zeros(len(part), np.int64)
        for j in range(0, int(part.max()) + 1, 4096):
            others = np.arange(j, min(j + 4096, int(part.max()) + 1))
            a, b = np.nonzero(others[None, :] < part[:, None])
            hit = _possible(members["n"], members["at"], members["bits"], part[a], others[b], similarity)
            a, b = a[hit], b[hit]
            hit = wide.near(own[part[a]], own[others[b]], similarity)
            ok = np.zeros((len(part), len(others)), bool)
            ok[a[hit], b[hit]] = True
            order = np.cumsum(ok, axis=1) + seen[:, None]
            a, b = np.nonzero(ok & (order > lo) & (order <= hi))
            late.append(part[a])
            early.append(others[b])
            seen = order[:, -1]
            if (seen > hi).all():
                break
        more.append(part[seen > hi])
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(late), join(early), join(more)


def _place_columns(ids, keys, line) -> list[pa.Array]:
    return [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(line.astype(np.int32))]


def _meet(similarity: float):
    """One bucket: turn 0 are lines whose set repeats an earlier one; turn 1 are pairs to verify;
    turn 2 are lines with further candidates, and the group to look them up in; turn 3 are lines
    that repeat one of their batch, as they came."""

    def run(table: pa.Table) -> pa.Table:
        parts = [_unpack(x) for x in table.column("blob").to_pylist()]
        row_base = np.cumsum([0, *(len(p["ids"]) for p in parts)])
        line_base = np.cumsum([0, *(len(p["l_n"]) for p in parts)])
        both = {k: np.concatenate([p[k] for p in parts]) for k in _FIELDS}
        l_row = np.concatenate([p["l_row"].astype(np.int64) + b for p, b in zip(parts, row_base)])
        line = np.concatenate([p["e_line"].astype(np.int64) + b for p, b in zip(parts, line_base)])
        short = np.zeros((len(line), 8), np.uint8)  # five bytes of the token's hash; the bucket adds to them
        short[:, :5] = both["e_token"].reshape(-1, 5)
        both["e_token"] = short.view(np.int64).ravel()
        ids, keys, number = both["ids"][l_row], both["keys"][l_row], both["l_line"]
        in_place = np.empty(len(ids), np.int64)  # rank of each line by place; the same place has the same rank
        order = np.lexsort((number, keys, ids))
        moved = np.ones(len(order), bool)
        moved[1:] = (np.diff(ids[order]) != 0) | (np.diff(keys[order]) != 0) | (np.diff(number[order]) != 0)
        in_place[order] = np.cumsum(moved)
        # one member for each set in a token's group, its first line; the others repeat it
        kind, more_of = both["l_set"], both["l_more"]
        top = np.uint64(63 - len(kind).bit_length())
        by_kind = np.empty(len(kind), np.uint64)
        by_kind[np.lexsort((in_place, more_of, kind))] = np.arange(len(kind), dtype=np.uint64)
        order = _order(both["e_token"], by_kind[line] << top, 40)
        line, token, at = line[order], both["e_token"][order], both["e_at"][order]
        same = np.zeros(len(line), bool)
        same[1:] = (token[1:] == token[:-1]) & (kind[line[1:]] == kind[line[:-1]]) & (more_of[line[1:]] == more_of[line[:-1]])
        head = np.flatnonzero(~same)[np.cumsum(~same) - 1]
        repeat = same & (in_place[line] != in_place[line[head]]) & (at == 0)
        found: list[tuple] = [(line[repeat], line[head[repeat]], 0)]
        again: list[tuple] = []
        line, token, at = line[~same], token[~same], at[~same]
        order = _order(token, in_place[line].astype(np.uint64) << top, 40)
        line, token, at = line[order], token[order], at[order]
        cut = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
        size = np.diff(cut)
        wide = _Wide(both["l_n"], both["l_wide"])
        members = {"n": both["l_n"][line].astype(np.int64), "at": at.astype(np.int64), "bits": both["l_bits"][line]}
        room = np.repeat(np.where(size <= _SMALL, cut[1:], 0), size) - np.arange(len(line))
        for step in range(1, _SMALL):
            early = np.flatnonzero(room > step)
            ok = early[_possible(**members, late=early + step, early=early, similarity=similarity)]
            ok = ok[in_place[line[ok + step]] != in_place[line[ok]]]
            ok = ok[wide.near(line[ok + step], line[ok], similarity)]
            found.append((line[ok + step], line[ok], 1))
        middle = (size > _SMALL) & (size <= _MIDDLE)
        who = np.flatnonzero(np.repeat(middle, size))
        late, early, m_more = _ask_together(**members, own=line, wide=wide, who=who, base=np.repeat(cut[:-1], size)[who], hi=_FIRST, similarity=similarity)
        found.append((line[late], line[early], 1))
        for lo, n in zip(cut[:-1][size > _SMALL], size[size > _SMALL]):
            own, group = line[lo : lo + n], {k: v[lo : lo + n] for k, v in members.items()}
            if n > _MIDDLE:
                late, early, more = _ask(group, own, wide, np.arange(1, n), 0, _FIRST, similarity)
                found.append((own[late], own[early], 1))
            else:
                more = m_more[np.searchsorted(m_more, lo) : np.searchsorted(m_more, lo + n)] - lo
            if len(more):
                again.append((own[more], token[lo], _pack([ids[own], keys[own], np.arange(n), number[own], group["n"], np.zeros(0), np.zeros(0), group["bits"], np.zeros(0), np.zeros(0), group["at"], wide.of(own), *[np.zeros(0)] * 4])))
        late = np.concatenate([*(f[0] for f in found), *(a[0] for a in again), np.zeros(0, np.int64)]).astype(np.int64)
        early = np.concatenate([*(f[1] for f in found), *(a[0] for a in again), np.zeros(0, np.int64)]).astype(np.int64)
        turn = np.concatenate([*(np.full(len(f[0]), f[2]) for f in found), *(np.full(len(a[0]), 2) for a in again), np.zeros(0)]).astype(np.int32)
        blobs = [None] * sum(len(f[0]) for f in found)
        for who, _, blob in again:
            blobs += [blob, *[None] * (len(who) - 1)]
        gap = np.bitwise_count(both["l_bits"][late] ^ both["l_bits"][early]).astype(np.int32)
        groups = np.concatenate([np.zeros(sum(len(f[0]) for f in found), np.int64), *(np.full(len(a[0]), int(a[1])) for a in again)])
        names = [*(f"late_{c}" for c in _PLACE), *(f"early_{c}" for c in _PLACE), "turn", "gap", "token", "again"]
        found_rows = pa.table([*_place_columns(ids[late], keys[late], number[late]), *_place_columns(ids[early], keys[early], number[early]), pa.array(turn), pa.array(gap), pa.array(groups, pa.int64()), pa.array(blobs, pa.binary())], names=names)
        f, g = (np.concatenate([p[k].astype(np.int64) + b for p, b in zip(parts, row_base)]) for k in ("r_row", "r_from_row"))
        none = np.zeros(len(f), np.int32)
        passed = pa.table([*_place_columns(both["ids"][f], both["keys"][f], both["r_line"]), *_place_columns(both["ids"][g], both["keys"][g], both["r_from_line"]), pa.array(none + 3), pa.array(none), pa.array(none.astype(np.int64)), pa.nulls(len(f), pa.binary())], names=names)
        return pa.concat_tables([found_rows, passed]).combine_chunks()

    return run


_MET = f"{_places('late')}, {_places('early')}, turn int, gap int, token long, again binary"


def _further(lo: int, hi: int, similarity: float):
    """The next candidates of the lines of one group that still have no witness."""

    def run(batches):
        for batch in batches:
            for token, blob, asking in zip(*(batch.column(c).to_pylist() for c in ("token", "again", "asking"))):
                g = _unpack(blob)
                index = {p: k for k, p in enumerate(zip(g["ids"].tolist(), g["keys"].tolist(), g["l_line"].tolist()))}
                who = np.array(sorted(index[a["doc_id"], a["text_key"], a["line"]] for a in asking), np.int64)
                late, early, more = _ask({"n": g["l_n"].astype(np.int64), "at": g["e_at"].astype(np.int64), "bits": g["l_bits"]}, np.arange(len(g["l_n"])), _Wide(g["l_n"], g["l_wide"]), who, lo, hi, similarity)
                late, early, turn = np.concatenate([late, more]), np.concatenate([early, more]), np.repeat([1, 2], [len(late), len(more)])
                place = lambda x: _place_columns(g["ids"][x], g["keys"][x], g["l_line"][x])
                yield pa.RecordBatch.from_arrays([*place(late), *place(early), pa.array(turn.astype(np.int32)), pa.array(np.bitwise_count(g["l_bits"][late] ^ g["l_bits"][early]).astype(np.int32)), pa.array(np.full(len(late), token), pa.int64()), pa.array([None] * len(late), pa.binary())], [*(f"late_{c}" for c in _PLACE), *(f"early_{c}" for c in _PLACE), "turn", "gap", "token", "again"])

    return run


def _place_hash(ids: np.ndarray, keys: np.ndarray, line: np.ndarray) -> np.ndarray:
    return (tx.mix(tx.mix(ids.astype(np.int64).view(np.uint64) ^ tx.mix(keys.astype(np.int64).view(np.uint64))) + line.astype(np.uint64)) % np.uint64(_MAP_BITS)).astype(np.int64)


def _map_words(batches):
    for batch in batches:
        at = np.unique(_place_hash(*(np.asarray(batch.column(c)) for c in _PLACE)))
        word, first = np.unique(at >> 6, return_index=True)
        bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], ["word", "bits"])


def _wanted_words(map_of):
    """Words of the lines on the map, as text."""

    def run(batches):
        table = np.frombuffer(map_of.value, np.uint64)
        for batch in batches:
            words, row, number, bounds = _lines(batch.column("text"))
            ids, keys = np.asarray(batch.column("doc_id"))[row], np.asarray(batch.column("text_key"))[row]
            at = _place_hash(ids, keys, number)
            on = (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            rows = np.flatnonzero(on.astype(bool) & (np.diff(bounds) > 0))
            raw = words.buf.tobytes()
            text = [raw[a:b] for a, b in zip(words.starts[bounds[rows]].tolist(), words.ends[bounds[rows + 1] - 1].tolist())]
            yield pa.RecordBatch.from_arrays([*_place_columns(ids[rows], keys[rows], number[rows]), pa.array(text, pa.binary())], [*_PLACE, "words"])

    return run


def _verify(similarity: float):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("late_words").to_pylist(), batch.column("early_words").to_pylist()):
                a, b = set(x.split()), set(y.split())
                shared = len(a & b)
                keep.append(shared >= similarity * (len(a) + len(b) - shared) - 1e-9)
            yield batch.drop_columns(["late_words", "early_words"]).filter(pa.array(keep, pa.bool_()))

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """Non-null coordinates: a null doc_id becomes the least number."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")


def _sides() -> dict[str, list[str]]:
    return {s: [f"{s}_{c}" for c in _PLACE] for s in ("late", "early")}


def _words_of_pairs(docs: DataFrame, met: DataFrame) -> DataFrame:
    """The words of the lines of all pairs to verify, from one scan of the documents."""
    sides = [met.where("turn = 1").select(*(F.col(c).alias(p) for c, p in zip(columns, _PLACE))) for columns in _sides().values()]
    wanted = sides[0].unionAll(sides[1]).mapInArrow(_map_words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most _MAP_BITS / 64 rows
    table = np.zeros(_MAP_BITS // 64, np.int64)
    table[np.asarray(wanted.column("word"))] = np.asarray(wanted.column("bits"))
    words = _keyed(docs).mapInArrow(_wanted_words(docs.sparkSession.sparkContext.broadcast(table.tobytes())), "doc_id long, text_key long, line int, words binary")
    return store(words.dropDuplicates(list(_PLACE)))


def _verified(words: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose lines have the similarity."""
    sides = _sides()
    for side, columns in sides.items():
        own = words.select(*(F.col(p).alias(c) for c, p in zip(columns, _PLACE)), F.col("words").alias(f"{side}_words"))
        pairs = pairs.join(own, columns)
    return pairs.select(*sides["late"], *sides["early"], "late_words", "early_words").mapInArrow(_verify(similarity), f"{_places('late')}, {_places('early')}")


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, line (from 0) of every line to remove, and a witness: early_doc_id, early_line."""
    spark = session(docs)
    ranks, total = rarity(docs)
    rank = spark.sparkContext.broadcast(ranks.tobytes())
    buckets = max(8, -(-total // BUCKET_BYTES))
    entries = _keyed(docs).mapInArrow(_entry_batches(rank, buckets, similarity, *hot_tokens(_keyed(docs), rank, similarity)), "bucket int, blob binary")
    met = store(entries.groupBy("bucket").applyInArrow(_meet(similarity), _MET))
    late, early = [f"late_{c}" for c in _PLACE], [f"early_{c}" for c in _PLACE]

    def candidates(rows: DataFrame) -> DataFrame:
        own = F.sort_array(F.collect_set(F.struct("gap", *early))).alias("asked")
        return store(rows.where("turn = 1").groupBy(*late).agg(own))

    gone = met.where("turn = 0").select(*late, *early)
    # the first line in a batch of a set may repeat an earlier batch's: that line is the witness of all
    whole = gone.groupBy(*(F.col(x).alias(y) for x, y in zip(late, early))).agg(F.min(F.struct(*early)).alias("w"))
    repeats = met.where("turn = 3").select(*late, *early).join(whole, early, "left").select(*late, *(F.coalesce(f"w.{c}", c).alias(c) for c in early))
    gone = gone.unionByName(repeats)
    groups = met.where("again is not null").select("token", "again")
    asking, open_, lo, hi, step = met.where("turn = 2").select(*late, "token"), candidates(met), 0, _FIRST, 1
    words = _words_of_pairs(docs, met)
    while True:
        while not open_.isEmpty():
            now = open_.select(*late, F.explode(F.slice("asked", 1, step)).alias("e")).select(*late, *(F.col(f"e.{c}").alias(c) for c in early))
            hit = store(_verified(words, now, similarity))
            gone = gone.unionByName(hit)
            seen = hit.select(*late).distinct()
            open_ = store(open_.withColumn("asked", F.slice("asked", F.lit(step + 1), F.size("asked"))).where(F.size("asked") > 0).join(seen, late, "left_anti"))
            asking = store(asking.join(seen, late, "left_anti"))
            step *= _GROWTH
        if asking.isEmpty():
            break
        lo, hi = hi, hi * _GROWTH
        who = asking.groupBy("token").agg(F.collect_list(F.struct(*(F.col(f"late_{c}").alias(c) for c in _PLACE))).alias("asking"))
        more = store(who.join(groups, "token").select("token", "again", "asking").mapInArrow(_further(lo, hi, similarity), _MET))
        words = _words_of_pairs(docs, more)
        open_, asking = candidates(more), more.where("turn = 2").select(*late, "token")
    out = gone.groupBy(*late).agg(F.min(F.struct(*early)).alias("w"))
    number = lambda c: F.nullif(F.col(c), F.lit(_NULL_ID))
    return out.select(number("late_doc_id").alias("doc_id"), F.col("late_text_key").alias("text_key"), F.col("late_line").alias("line"), number("w.early_doc_id").alias("early_doc_id"), F.col("w.early_line").alias("early_line"))


def remove_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents with such lines taken out of ``text``; ``n_chars``, if there, is counted anew. All other
    columns stay as they are, whatever their names."""
    own, at_id, at_key, gone = private(docs, "own_key", "gone_id", "gone_key", "gone_lines")
    lines = repeated_lines(docs, similarity).groupBy(F.col("doc_id").alias(at_id), F.col("text_key").alias(at_key)).agg(F.collect_set("line").alias(gone))
    # a null doc_id matches the null of its own lines
    joined = docs.withColumn(own, text_key(F.col("text"))).join(lines, F.col("doc_id").eqNullSafe(F.col(at_id)) & (F.col(own) == F.col(at_key)), "left")
    none = F.col(gone).isNull()
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(gone, i)), "\n")
    new = {"text": kept, "n_chars": F.length(kept).cast("long")}
    return joined.select(*(F.when(none, quoted(c)).otherwise(new[c]).alias(c) if c in new else quoted(c) for c in docs.columns))
