"""Alignment of two tokenizers' tokens over the same text, and counts of the token pairs that align.

Tokens of both are nodes; two that share bytes of the text are joined by an edge. A union-find over
these edges gives connected components, which are the smallest groups that cover the same bytes on
both sides, as tokens of either side follow each other without a gap. Within a component the links
are the pairs of tokens that end at the same byte.

A task works on texts of about ``CHARS_AT_ONCE`` characters at a time, all their tokens in one
union-find. Links leave it as different pairs with their number for each document, written once to
the shared folder. Counting pairs is a grouped sum. To give every document its pairs' counts, the
``FREQUENT`` most frequent pairs are broadcast, a table of fixed size; any other pair is rarer
than a ``FREQUENT``-th of all links, so those are joined by key without a hot one.

Defined cases: a document whose text is null or empty, or whose tokens don't spell a space and the
text (a tokenizer that changes texts), has no tokens: zeros, and an empty text for its groups;
repeated rows and null doc_ids are rows of their own and count each; an empty table gives no rows;
texts of any length are encoded as a whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm._common import session, store
from lumenflow.llm.bpe import byte_characters, slices
from lumenflow.llm.packing import _ranked

FREQUENT = 262_144
CHARS_AT_ONCE = 500_000
#: Below this code point the two libraries that can encode with the first tokenizer agree on letters, numbers and spaces.
PLAIN_BELOW = 0x250
#: Characters of parts of texts whose ids a task keeps before it starts its table anew.
HELD_CHARS = 8_000_000
_SPACED = re.compile(" +[^ ]*")
_SCHEMA = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, a array<int>, b array<int>, n array<int>"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteTokens:
    """Side A: a byte-level tokenizer file. Strings of special tokens in texts are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        byte = {c: b for b, c in enumerate(byte_characters())}
        vocab = spec["model"]["vocab"]
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))]))
        for word, i in vocab.items():
            self.bytes_of[i] = word.encode() if word in special else bytes(byte[c] for c in word)
        self.ranked = _ranked(spec, special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self.ranked is not None and (t.isascii() or ord(max(t)) < PLAIN_BELOW) for t in texts]
        return [self.ranked.__self__.encode_to_numpy(" " + t, disallowed_special=()) if p else np.array(self.library.encode(" " + t, add_special_tokens=False).ids, np.uint32) for t, p in zip(texts, plain)]


class PieceTokens:
    """Side B: a model of pieces, which puts a space in front itself.

    If no piece goes on behind a space that follows something else, no merge does, so runs of spaces with what follows them are
    encoded by themselves, and looked up when they come again (``HELD_CHARS`` characters of them). Otherwise whole texts are encoded.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self.changed: set[str] = set()
        self.chars = 0
        # the model puts no space in front of an empty text, so a space at a text's end is seen behind a letter
        self.ends = array("I", self.model.encode("a ")[len(self.model.encode("a")) :]).tobytes()
        self.held: dict[str, bytes] = {" ": self.ends}

    def _spelled(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where they don't spell a space and the text."""
        if not self.apart:
            found = self.model.encode(texts, num_threads=1) if texts else []
            return [np.array(x, np.uint32) if self._spelled(x) == b" " + t.encode() else None for x, t in zip(found, texts)]
        parts = [_SPACED.findall(" " + t) for t in texts]
        if new := list(set().union(*parts).difference(self.held)):
            found = self.model.encode([p[1:] for p in new], num_threads=1)  # the model's own space is the first
            self.held.update((p, array("I", x).tobytes()) for p, x in zip(new, found))
            self.changed.update(p for p, x in zip(new, found) if self._spelled(x) != p.encode())
            self.chars += sum(map(len, new))
        out = [np.frombuffer(b"".join(map(self.held.__getitem__, part)), np.uint32) if not self.changed or self.changed.isdisjoint(part) else None for part in parts]
        if self.chars > HELD_CHARS:
            self.held, self.changed, self.chars = {" ": self.ends}, set(), 0
        return out


@lru_cache(maxsize=2)
def _sides(a: str, b: str):
    one, two = ByteTokens(a), PieceTokens(b)
    # what follows a token in the text of groups: the next of its side, or the other side, or the next group
    first = [str(i).encode() + s for i in range(len(one.bytes_of)) for s in (b",", b"|")]
    second = [str(i).encode() + s for i in range(len(two.bytes_of)) for s in (b",", b";")]
    written = first + second
    size = np.array([len(w) for w in written], np.int64)
    return one, two, (np.frombuffer(b"".join(written), np.uint8), np.cumsum(size) - size, size), *(np.array([len(x) for x in t.bytes_of], np.int64) for t in (one, two))


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node of each node's component, by hooking roots to lesser ones and halving paths."""
    parent = np.arange(n)
    while len(u):
        a, b = parent[u], parent[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    return parent


def overlaps(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens that share bytes, by place, for two sides that cover the same bytes."""
    ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # two sorted runs
    ends = ends[np.append(True, ends[1:] != ends[:-1])[: len(ends)]]
    return np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)


def _align(texts: list[str | None], sides) -> dict[str, list]:
    one, two, written, size_a, size_b = sides
    rows = [i for i, t in enumerate(texts) if t]
    known = [texts[i] for i in rows]
    ids_a, ids_b = one.encode(known), two.encode(known)
    # side A's tokens are bytes of the text in their order, so only missing ones could differ
    whole = [b is not None and int(size_a[a].sum()) == 1 + len(t.encode()) for t, a, b in zip(known, ids_a, ids_b)]
    rows, ids_a, ids_b = ([x for x, ok in zip(y, whole) if ok] for y in (rows, ids_a, ids_b))
    counts_a, counts_b = (np.array([len(x) for x in y], np.int64) for y in (ids_a, ids_b))
    a, b = (np.concatenate([np.zeros(0, np.uint32), *y]).astype(np.int64) for y in (ids_a, ids_b))
    # documents follow each other on both sides, and end together
    end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    u, v = overlaps(end_a, end_b)
    group = components(len(a) + len(b), u, v + len(a))
    linked = end_a[u] == end_b[v]
    link_a, link_b = u[linked], v[linked]
    # tokens in the order in which they are written: by group, side, place
    order = np.argsort(group * 2 + (np.arange(len(group)) >= len(a)), kind="stable")
    of, side = group[order], order >= len(a)
    last = np.append((of[1:] != of[:-1]) | (side[1:] != side[:-1]), True) if len(of) else np.zeros(0, bool)
    key = np.where(side, 2 * len(size_a) + 2 * np.append(a, b)[order], 2 * np.append(a, b)[order]) + last
    # all texts of groups as one run of bytes, put together from those of the tokens
    letters, at, size = written
    ends = np.append(0, np.cumsum(size[key]))
    texts_of_groups = letters[np.arange(ends[-1]) + np.repeat(at[key] - ends[:-1], size[key])].tobytes().decode()
    cut_text = ends[np.append(0, np.cumsum(counts_a + counts_b))].tolist()
    doc_a = np.repeat(np.arange(len(rows)), counts_a)
    n_groups = np.bincount(doc_a[group[: len(a)] == np.arange(len(a))], minlength=len(rows))
    n_links = np.bincount(doc_a[link_a], minlength=len(rows))
    pair = np.sort((doc_a[link_a] * len(size_a) + a[link_a]) * len(size_b) + b[link_b])
    begins = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    pair, n = pair[begins], np.diff(np.append(begins, len(pair)))
    pair_doc, pair_a, pair_b = pair // len(size_b) // len(size_a), pair // len(size_b) % len(size_a), pair % len(size_b)
    cut = np.searchsorted(pair_doc, np.arange(len(rows) + 1)).tolist()
    out = {"n_a": [0] * len(texts), "n_b": [0] * len(texts), "n_groups": [0] * len(texts), "n_links": [0] * len(texts), "groups": [""] * len(texts), "a": [[]] * len(texts), "b": [[]] * len(texts), "n": [[]] * len(texts)}
    for k, i in enumerate(rows):
        lo, hi = cut[k], cut[k + 1]
        whole_text = texts_of_groups[cut_text[k] : cut_text[k + 1] - 1]
        for name, value in (("n_a", counts_a[k]), ("n_b", counts_b[k]), ("n_groups", n_groups[k]), ("n_links", n_links[k]), ("groups", whole_text), ("a", pair_a[lo:hi]), ("b", pair_b[lo:hi]), ("n", n[lo:hi])):
            out[name][i] = value
    return out


def align(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """One row for each document: row (a number of its own), doc_id, n_a and n_b (tokens of both sides), n_groups, n_links, groups
    (``a1,a2|b1;a3|b2,b3``) and its different linked pairs: ids a and b, and how many links n each has."""
    session(docs)
    paths = [given or known for given, known in zip((a, b), default_tokenizers())]

    def run(batches):
        sides = _sides(*paths)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text"), CHARS_AT_ONCE):
                made = _align(texts, sides)
                kinds = {"groups": pa.string(), **dict.fromkeys("abn", pa.list_(pa.int32()))}
                columns = {"row": batch.column("row").slice(at, len(texts)), "doc_id": batch.column("doc_id").slice(at, len(texts))}
                columns |= {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in made.items()}
                yield pa.RecordBatch.from_pydict(columns)
                at += len(texts)

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


def _pairs(aligned: DataFrame) -> DataFrame:
    return aligned.select("row", F.inline(F.arrays_zip("a", "b", "n")))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, links: how many links of all documents join two ids, and whether no other id is linked to b more often (best)."""
    counts = _pairs(aligned).groupBy("a", "b").agg(F.sum("n").alias("links"))
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(most, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))


def scored(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The rows with n_best (links that are the best of their b) and count_sum (the sum of their pairs' counts). ``aligned`` is
    read several times, so it should be a written table."""
    counts = store(pair_counts(aligned))
    order = (F.desc("links"), "a", "b")
    top = store(counts.orderBy(*order).limit(frequent))
    sums = (F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))
    # a row's pairs are in one task, so their sums leave it as one number each
    often = _pairs(aligned).join(F.broadcast(top), ["a", "b"]).groupBy("row").agg(*sums)
    keys = F.broadcast(top.select("a", "b"))
    rare = _pairs(aligned).join(keys, ["a", "b"], "left_anti").join(counts.join(keys, ["a", "b"], "left_anti").hint("shuffle_merge"), ["a", "b"]).groupBy("row").agg(*sums)
    both = often.unionAll(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("a", "b", "n").join(both, "row", "left").withColumn("n_best", F.coalesce("n_best", zero)).withColumn("count_sum", F.coalesce("count_sum", zero))
