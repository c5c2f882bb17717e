"""Harmonic packing of tokenized documents into sequences of fixed capacity.

Piece lengths fall into reciprocal-capacity classes: class j holds lengths in
(capacity / (j + 1), capacity / j], and a bin of class j takes exactly j pieces. Documents
may be cut freely, so they are cut at lengths that are whole fractions of the capacity
(2048, 1024, ... 64), whose bins fill without waste; only the last piece of under 64 tokens
goes to a class by its own length, where a full bin wastes less than one piece.

Every task fills its own bins, so there is no shuffle, and a lost task is redone with the
same outcome from the same input split. What is left at the end of a task is packed into
sequences whose length is a power of two (these need no padding) and, for the short ends,
into shared bins of which one at most is padded by much.

Defined cases: a null text is empty and gives the end token alone; a null doc_id stays null on its
pieces; repeated rows are packed each; an empty table gives no pieces; a text of any length is cut
like others; row order within a document's pieces is by ``start``; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm._common import session

CAPACITY = 2048
#: Cuts stop at this length; the rest of a document, shorter than this, is its last piece.
LEAST_CUT = 64
END_ID = 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Below this code point the two tokenizer libraries' notions of letter, number and space agree.
_PLAIN_BELOW = 0x250


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from texts to lists of ids, those of the ``tokenizers`` file at ``path``.

    A plain byte-level BPE file is also loaded as merge ranks, which encode the same ids
    several times faster; texts with special tokens or rarer scripts take the first way.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [x["content"] for x in spec.get("added_tokens", [])]
    fast = _ranked(spec, special)

    def plain(text: str) -> bool:
        return fast is not None and (text.isascii() or ord(max(text)) < _PLAIN_BELOW) and not any(s in text for s in special)

    def encode(texts: list[str]) -> list[list[int]]:
        return [fast(t) if plain(t) else whole.encode(t, add_special_tokens=False).ids for t in texts]

    return encode


def _ranked(spec: dict, special: list[str]):
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type", "BPE") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer") or model.get("ignore_merges"):
        return None
    import tiktoken

    # byte-level files write each byte as a printable character: itself, or 256 onwards in order
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    ranks = {bytes(byte[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
    # ranks stand for the merges only if these come in the order of the ids that they make
    made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model.get("merges", [])]
    if None in made or any(a >= b for a, b in zip(made, made[1:])):
        return None
    split = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("ranked", pat_str=split, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def cuts(total: int, capacity: int = CAPACITY, least: int = LEAST_CUT) -> list[int]:
    """Piece lengths of a document: whole bins, halves of what is left down to ``least``, then the rest."""
    out, size = [capacity] * (total // capacity), capacity // 2
    rest = total % capacity
    while size >= least:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


class Bins:
    """Open bins of one task, by class. ``place`` yields (piece, sequence, offset) as bins fill."""

    def __init__(self, base: int, capacity: int = CAPACITY, least: int = LEAST_CUT):
        self.base, self.capacity, self.least, self.made, self.open = base, capacity, least, 0, {}

    def _close(self, pieces):
        at, name = 0, self.base + self.made
        self.made += 1
        for piece in pieces:
            yield piece, name, at
            at += piece[2]

    def place(self, piece):
        length = piece[2]
        count = self.capacity // length
        held = self.open.setdefault(count, [])
        held.append(piece)
        if len(held) == count:
            del self.open[count]
            yield from self._close(held)

    def rest(self):
        """The open bins: exact classes as runs of a power of two, the others together, longest first."""
        ends = []
        for count, held in sorted(self.open.items()):
            if count > self.capacity // self.least:
                ends += held
                continue
            while held:
                take = 1 << (len(held).bit_length() - 1)
                yield from self._close(held[:take])
                held = held[take:]
        run, used = [], 0
        for piece in sorted(ends, key=lambda p: -p[2]):
            if used + piece[2] > self.capacity:
                yield from self._close(run)
                run, used = [], 0
            run.append(piece)
            used += piece[2]
        if run:
            yield from self._close(run)
        self.open = {}


def _batch(placed) -> pa.RecordBatch:
    columns = list(zip(*((*piece, name, at) for piece, name, at in placed)))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in SCHEMA.split(", ")])


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    session(docs)
    path = tokenizer or default_tokenizer()

    def run(batches):
        encode = encoder(path)
        bins = Bins(TaskContext.get().partitionId() << 40, capacity)
        for batch in batches:
            out = []
            texts = batch.column("text")
            for lo in range(0, batch.num_rows, 100):
                part = texts.slice(lo, 100).to_pylist()
                for doc_id, ids in zip(batch.column("doc_id").slice(lo, 100).to_pylist(), encode([t or "" for t in part])):
                    tokens = np.array([*ids, end_id], "<u4")
                    start = 0
                    for n in cuts(len(tokens), capacity):
                        out += bins.place((doc_id, start, n, zlib.crc32(tokens[start : start + n]), len(tokens)))
                        start += n
            if out:
                yield _batch(out)
        if bins.open:
            yield _batch(bins.rest())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
