"""Word splitting and hashing over whole Arrow string columns with numpy.

A column is handled as one byte buffer, so the cost per word is a few array
operations and no Python object is made per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

#: Bytes that separate words (space, tab to carriage return).
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Low bytes kept of an 8-byte load, by the number of bytes that belong to the word.
_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)


@dataclass
class Words:
    """Words of a column: byte ranges in ``buf`` and, per row, the range of its words."""

    buf: np.ndarray  # padded by 40 bytes, so that 8-byte loads stay inside
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # row i has the words first[i] to first[i + 1]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A copy of the column's bytes, padded, and row offsets from 0. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    buf = np.zeros(hi - lo + 40, np.uint8)
    if hi > lo:
        buf[: hi - lo] = np.frombuffer(column.buffers()[2], np.uint8)[lo:hi]
    return buf, offsets - lo


def words_of(column: pa.Array, separators: np.ndarray = SPACES, lower: bool = False) -> Words:
    """Runs of bytes other than separators, row by row."""
    buf, offsets = column_bytes(column)
    size = int(offsets[-1])
    buf = _LOWER[buf] if lower else buf
    inside = ~separators[buf[:size]]
    begins = np.zeros(size + 1, bool)
    begins[offsets] = True
    before = np.zeros(size, bool)
    before[1:] = inside[:-1]
    after = np.zeros(size, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | begins[:size]))
    ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
    return Words(buf, starts, ends, np.searchsorted(starts, offsets))


def lowered(words: Words) -> Words:
    """A-Z in lower case and exactly one space between the words of a row."""
    lengths = words.ends - words.starts + 1
    at = np.concatenate([[0], np.cumsum(lengths)])
    out = np.full(int(at[-1]) + 40, 32, np.uint8)
    shift = np.repeat(words.starts - at[:-1], lengths)
    source = np.arange(int(at[-1])) + shift
    source[at[1:] - 1] = 0
    out[: int(at[-1])] = _LOWER[words.buf[source]]
    out[at[1:] - 1] = 32
    return Words(out, at[:-1], at[1:] - 1, words.first)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> U64(30))) * _M1
    h = (h ^ (h >> U64(27))) * _M2
    return h ^ (h >> U64(31))


def bytes_at(buf: np.ndarray, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """The ``size`` bytes (8 at most) from each place of a padded buffer, as a number."""
    return _load8(buf, at) & _KEEP[size]


def _load8(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))[at]


def hash_words(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word."""
    length = words.ends - words.starts
    h = mix(length.astype(U64) + U64((seed * 0x9E3779B97F4A7C15) % 2**64))
    at, left, rows = words.starts, length, None
    while len(at):
        part = _load8(words.buf, at) & _KEEP[np.minimum(left, 8)]
        if rows is None:
            h = mix(h ^ part)
        else:
            h[rows] = mix(h[rows] ^ part)
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def window_hash(h: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of each run of ``size`` consecutive word hashes (fewer than that: none)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    base = U64((0x9E3779B97F4A7C15 + 2 * seed * 0xD1B54A32D192ED03) % 2**64 | 1)
    out = np.zeros(n, U64)
    for j in range(size):
        out *= base
        out += h[j : j + n]
    return mix(out)


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """The least of each run of ``size`` values."""
    n, have = len(x) - size + 1, 1
    if n <= 0:
        return x[:0]
    while have < size:
        step = min(have, size - have)
        x = np.minimum(x[: len(x) - step], x[step:])
        have += step
    return x[:n]


# The five primes of XXH64.
_P1, _P2, _P3 = U64(0x9E3779B185EBCA87), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)
_P4, _P5 = U64(0x85EBCA77C2B2AE63), U64(0x27D4EB2F165667C5)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def xxh64(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many byte ranges of a padded buffer."""
    at, left, seed64 = starts.astype(np.int64), ends - starts, U64(seed)
    h = np.full(len(at), seed64 + _P5, U64)
    long = np.flatnonzero(left >= 32)
    if len(long):
        pos, todo = at[long].copy(), left[long].copy()
        with np.errstate(over="ignore"):
            lanes = [np.full(len(long), x, U64) for x in (seed64 + _P1 + _P2, seed64 + _P2, seed64, seed64 - _P1)]
        live = np.arange(len(long))
        while len(live):
            for j in range(4):
                lanes[j][live] = _rotl(lanes[j][live] + _load8(buf, pos[live] + 8 * j) * _P2, 31) * _P1
            pos[live] += 32
            todo[live] -= 32
            live = live[todo[live] >= 32]
        acc = _rotl(lanes[0], 1) + _rotl(lanes[1], 7) + _rotl(lanes[2], 12) + _rotl(lanes[3], 18)
        for lane in lanes:
            acc = (acc ^ (_rotl(lane * _P2, 31) * _P1)) * _P1 + _P4
        h[long] = acc
        at = at.copy()
        at[long] = pos
    h += left.astype(U64)
    rest = left & 31
    for lane in range(3):
        rows = np.flatnonzero(rest >= 8 * lane + 8)
        if len(rows):
            k = _rotl(_load8(buf, at[rows] + 8 * lane) * _P2, 31) * _P1
            h[rows] = _rotl(h[rows] ^ k, 27) * _P1 + _P4
    at = at + (rest & ~7)
    rows = np.flatnonzero(rest & 4)
    if len(rows):
        k = (_load8(buf, at[rows]) & U64(0xFFFFFFFF)) * _P1
        h[rows] = _rotl(h[rows] ^ k, 23) * _P2 + _P3
        at[rows] += 4
    rest = rest & 3
    for byte in range(3):
        rows = np.flatnonzero(rest > byte)
        if len(rows):
            h[rows] = _rotl(h[rows] ^ (buf[at[rows] + byte].astype(U64) * _P5), 11) * _P1
    h = (h ^ (h >> U64(33))) * _P2
    h = (h ^ (h >> U64(29))) * _P3
    return h ^ (h >> U64(32))
