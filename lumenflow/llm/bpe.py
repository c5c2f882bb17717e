"""Byte-pair encoding of words, by a guess that is then verified, and decoding.

The guess is greedy: at each place of a word the longest token that fits. A sequence of tokens is
the result of merging exactly if every two neighbours are what merging their own symbols gives:
the first merge across a border would have been seen by the two tokens beside it alone. So all
neighbours of all words are tested at once, by undoing the later of the two tokens' merges step by
step and looking whether a merge across the border came before it. Only words that fail are merged
one by one in the order of the merges.

Words are looked up before they are encoded, so a task works on a word once for as long as its
table of words (``HELD_CHARS``) isn't emptied. Splitting and normalising follow the tokenizer
file; texts of rarer scripts are normalised and split by the ``tokenizers`` library itself, as
its tables of letters are of another Unicode version than Python's.

Defined cases: a null or empty text has no ids, and decodes to an empty text; a text of any length
is encoded as a whole, its words in parts of ``WORDS_AT_ONCE``; the strings of special tokens in
a text are these tokens; repeated rows and null doc_ids stay, each with its ids; an empty table
stays empty; other columns stay, but ``ids`` and ``decoded`` take the place of columns of these
names.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lumenflow.llm._common import quoted, session

#: Characters of words whose ids a task keeps before it starts its table anew.
HELD_CHARS = 4_000_000
#: Symbols of a word up to which words are merged together, a step of each at a time; longer ones are merged by themselves.
MERGED_TOGETHER = 64
#: Characters of texts that are looked at together (one text at least).
CHARS_AT_ONCE = 1_000_000
#: Words of one text that are looked at together.
WORDS_AT_ONCE = 65_536
#: Below this code point all texts are in composed form, and libraries agree on letters, numbers, spaces and lower case.
PLAIN_BELOW = 0x250


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself, or from 256 on in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}
    return [chr(hidden.get(b, b)) for b in range(256)]


class Merges:
    """The merges of a vocabulary over symbols, which are tokens that no merge makes."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int], size: int):
        self.size = size
        left, right, out = (np.array(x, np.int64) for x in (*zip(*pairs), made)) if pairs else (np.zeros(0, np.int64),) * 3
        key = left * size + right
        order = np.argsort(key)
        self.keys, self.ranks, self.ids = key[order], order.astype(np.int64), out[order]
        # how a token was made: its two halves and the rank of that merge, -1 for symbols
        self.left, self.right, self.rank = np.full(size, -1), np.full(size, -1), np.full(size, -1)
        self.left[out], self.right[out], self.rank[out] = left, right, np.arange(len(out))
        self.table = {(a, b): (r, t) for r, (a, b, t) in enumerate(zip(left.tolist(), right.tolist(), made))}
        # a token is sound if merging its symbols gives it: its halves are, and nothing across their border came before
        self.sound = np.ones(size, bool)
        merged = np.flatnonzero(self.rank >= 0)
        alone = self.compatible(self.left[merged], self.right[merged], self.rank[merged])
        for t, ok in zip(merged[np.argsort(self.rank[merged])].tolist(), alone[np.argsort(self.rank[merged])].tolist()):
            self.sound[t] = ok and self.sound[self.left[t]] and self.sound[self.right[t]]

    def _across(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; a number beyond all ranks where there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        none = np.iinfo(np.int64).max
        return np.where(self.keys[at] == key, self.ranks[at], none) if len(self.keys) else np.full(len(a), none)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair of tokens, whether merging their symbols leaves the border between them.

        The state in front of the border's later merge is that with the merge undone. It lasted until that merge was
        due, so a merge across the border of lower rank (at equal rank: one further left) would have come first.
        """
        out = np.ones(len(a), bool)
        rows = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        due = np.full(len(a), np.iinfo(np.int64).max) if before is None else before.astype(np.int64)
        while len(rows):
            hit = self._across(a, b) < due
            out[rows[hit]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~hit & ((ra >= 0) | (rb >= 0))
            rows, a, b, ra, rb = rows[go], a[go], b[go], ra[go], rb[go]
            undo_a = ra > rb
            # a merge on the right of the border gives way to one across it at equal rank, as that is further left
            due = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return out

    def symbols(self, token: int) -> list[int]:
        out, todo = [], [token]
        while todo:
            t = todo.pop()
            if self.rank[t] < 0:
                out.append(t)
            else:
                todo += [int(self.right[t]), int(self.left[t])]
        return out

    def merge(self, word: list[int]) -> list[int]:
        """The tokens of a word's symbols, by merging in order of rank, then from the left."""
        now, after, ahead = list(word), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        due: list[tuple[int, int, int, int, int]] = []

        def see(i: int, j: int) -> None:
            if i >= 0 and j < len(now) and (found := self.table.get((now[i], now[j]))):
                heapq.heappush(due, (found[0], i, now[i], now[j], found[1]))

        for i in range(len(word) - 1):
            see(i, i + 1)
        while due:
            _, i, a, b, made = heapq.heappop(due)
            j = after[i]
            if now[i] != a or j >= len(now) or now[j] != b:
                continue
            now[i], now[j] = made, -1
            after[i] = after[j]
            if after[j] < len(now):
                ahead[after[j]] = i
            see(ahead[i], i)
            see(i, after[i])
        return [t for t in now if t >= 0]

    def merge_all(self, words: list[np.ndarray]) -> list[np.ndarray]:
        """``merge`` of many short words, one merge of each word in every step."""
        out: list[np.ndarray] = [None] * len(words)
        token, word = np.concatenate(words), np.repeat(np.arange(len(words)), [len(w) for w in words])
        none = np.iinfo(np.int64).max
        while len(token):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            rank = np.full(len(token), none)
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside] = self._across(token[inside], token[inside + 1])
            least = np.minimum.reduceat(rank, starts)
            ends = np.append(starts[1:], len(token))
            over = np.flatnonzero(least == none)
            for k in over.tolist():
                out[word[starts[k]]] = token[starts[k] : ends[k]]
            size = ends - starts
            least = np.repeat(least, size)
            due = np.flatnonzero((rank == least) & (least < none))
            due = due[np.concatenate([[True], word[due][1:] != word[due][:-1]])] if len(due) else due
            token[due] = self.ids[np.searchsorted(self.keys, token[due] * self.size + token[due + 1])]
            keep = least < none
            keep[due + 1] = False
            token, word = token[keep], word[keep]
        return out


class LongestMatch:
    """All tokens as a tree of symbols, as sorted edges (state, symbol) to state; a symbol's own state is its number."""

    def __init__(self, merges: Merges, tokens: np.ndarray):
        self.size = merges.size
        states: dict[tuple[int, int], int] = {}
        token = {}
        for t in tokens.tolist():
            first, *rest = merges.symbols(t)
            state = first
            for s in rest:
                state = states.setdefault((state, s), self.size + len(states))
            token[state] = t
        edges = sorted((a * self.size + b, c) for (a, b), c in states.items())
        self.keys, self.to = (np.array(x, np.int64) for x in zip(*edges)) if edges else (np.zeros(0, np.int64),) * 2
        self.token = np.full(self.size + len(states), -1)
        self.token[list(token)] = list(token.values())

    def at(self, symbols: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every place, the longest token that fits into the ``room`` up to its word's end, and that token's length."""
        best, length = symbols.copy(), np.ones(len(symbols), np.int64)
        rows, state, depth = np.arange(len(symbols)), symbols, 1
        while len(self.keys):
            go = room[rows] > depth
            rows, state = rows[go], state[go]
            if not len(rows):
                break
            key = state * self.size + symbols[rows + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            rows, state = rows[found], self.to[at[found]]
            depth += 1
            known = self.token[state]
            best[rows[known >= 0]], length[rows[known >= 0]] = known[known >= 0], depth
        return best, length


class WordEncoder:
    """The encoder and decoder of a tokenizer file with byte-level words that end in a mark."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self._accept(spec)
        end = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.merges = Merges([(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs], size)
        letters = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.inner, self.last = (np.array([vocab[c + e] for c in letters], np.int64) for e in ("", end))
        usable = np.flatnonzero((self.merges.rank >= 0) & self.merges.sound)
        self.longest = LongestMatch(self.merges, usable)
        self.text_of = {i: word for word, i in (vocab | self.special).items()}
        (split,) = (p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split)
        self.marks = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.held: dict[str, bytes] = {}
        self.chars = self.guessed = self.failed = 0

    @staticmethod
    def _accept(spec: dict) -> None:
        """Refuse files whose rules are not those that are followed here."""
        model, norm, pre = spec["model"], spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        names = [n["type"] for n in norm.get("normalizers", [])]
        parts = pre.get("pretokenizers", [])
        split = [p for p in parts if p["type"] == "Split"]
        levels = [p for p in parts if p["type"] == "ByteLevel"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if not (plain and names == ["NFC", "Replace", "Lowercase"] and len(parts) == 2 and split and levels and split[0]["behavior"] == "Removed" and split[0]["invert"] and not levels[0]["use_regex"] and not levels[0]["add_prefix_space"] and not spec.get("decoder") and not any(t[k] for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))):
            raise ValueError("this tokenizer file has rules that are not supported")

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text without special tokens, in lower case, in parts."""
        if text.isascii() or ord(max(text)) < PLAIN_BELOW:
            text = text.lower()
            if len(text) <= WORDS_AT_ONCE * 4:
                yield self.pattern.findall(text)
                return
            found = (m.group() for m in self.pattern.finditer(text))
        else:
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            found = (bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in pieces)
        while part := list(islice(found, WORDS_AT_ONCE)):
            yield part

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of different words, as little-endian 32-bit numbers."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw])
        ends = np.cumsum(sizes)
        letters = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[letters]
        symbols[ends - 1] = self.last[letters[ends - 1]]
        best, length = self.longest.at(symbols, np.repeat(ends, sizes) - np.arange(len(symbols)))
        # tokens never pass a word's end, so one walk goes through all words
        step, at, p = length.tolist(), [], 0
        while p < len(step):
            at.append(p)
            p += step[p]
        at = np.array(at)
        ids = best[at]
        word = np.searchsorted(ends, at, "right")
        inside = np.flatnonzero(word[1:] == word[:-1])
        wrong = np.unique(word[inside[~self.merges.compatible(ids[inside], ids[inside + 1])]])
        first = np.searchsorted(word, np.arange(len(words) + 1))
        packed = ids.astype("<u4").tobytes()
        out = [packed[4 * a : 4 * b] for a, b in zip(first.tolist(), first[1:].tolist())]
        own = [symbols[ends[w] - sizes[w] : ends[w]] for w in wrong.tolist()]
        short = [k for k, x in enumerate(own) if len(x) <= MERGED_TOGETHER]
        merged = dict(zip(short, self.merges.merge_all([own[k] for k in short]))) if short else {}
        for k, w in enumerate(wrong.tolist()):
            out[w] = np.array(merged[k] if k in merged else self.merges.merge(own[k].tolist()), "<u4").tobytes()
        self.guessed, self.failed = self.guessed + len(words), self.failed + len(wrong)
        return out

    def _parts(self, text: str | None) -> Iterator[bytes | list[str]]:
        """A text as ids of special tokens and lists of words."""
        at = 0
        for mark in self.marks.finditer(text or ""):
            yield from self.words(text[at : mark.start()]) if mark.start() > at else ()
            yield np.array([self.special[mark.group()]], "<u4").tobytes()
            at = mark.end()
        if text and at < len(text):
            yield from self.words(text[at:])

    def _look_up(self, parts: list[bytes | list[str]]) -> bytes:
        return b"".join(p if isinstance(p, bytes) else b"".join(map(self.held.__getitem__, p)) for p in parts)

    def _learn(self, words: set[str]) -> None:
        if new := [w for w in words if w not in self.held]:
            self.held.update(zip(new, self._encode(new)))
            self.chars += sum(map(len, new))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of texts, each as little-endian 32-bit numbers. New words of all texts are encoded together; of a text beyond
        ``CHARS_AT_ONCE`` it is those of a part."""
        if sum(len(t or "") for t in texts) > CHARS_AT_ONCE:
            out = []
            for text in texts:
                done = []
                for part in self._parts(text):
                    self._learn(set() if isinstance(part, bytes) else set(part))
                    done.append(self._look_up([part]))
                    self._forget()
                out.append(b"".join(done))
            return out
        parts = [list(self._parts(t)) for t in texts]
        self._learn({w for p in parts for x in p if not isinstance(x, bytes) for w in x})
        out = [self._look_up(p) for p in parts]
        self._forget()
        return out

    def _forget(self) -> None:
        if self.chars > HELD_CHARS:
            self.held, self.chars = {}, 0

    def decode(self, rows: list[bytes | None]) -> list[str]:
        """The tokens' texts with spaces between; numbers that are no token's are left out."""
        return [" ".join([self.text_of[i] for i in np.frombuffer(ids or b"", "<u4").tolist() if i in self.text_of]) for ids in rows]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each file and Python worker."""
    return WordEncoder(path)


def slices(column: pa.Array, chars: int = CHARS_AT_ONCE) -> Iterator[list]:
    """The values of a column of texts or bytes, in lists of about ``chars`` (a longer value by itself)."""
    held, size = [], 0
    for v in column:
        value = v.as_py()
        if held and size + len(value or "") > chars:
            yield held
            held, size = [], 0
        held.append(value)
        size += len(value or "")
    if held:
        yield held


def _with(df: DataFrame, source: str, name: str, kind: T.DataType, arrow: pa.DataType, path: str, method: str) -> DataFrame:
    """The table with one more column, made by a method of the encoder from another."""
    session(df)
    kept = [c for c in df.columns if c.lower() != name]
    at = [c.lower() for c in kept].index(source)

    def run(batches):
        work = getattr(encoder(path), method)
        for batch in batches:
            made = [pa.array(work(part), arrow) for part in slices(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.concat_arrays(made) if made else pa.array([], arrow)], [*batch.schema.names, name])

    chosen = df.select(*map(quoted, kept))
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields, T.StructField(name, kind)]))


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The table with ``ids``: the ids of each ``text`` as little-endian unsigned 32-bit numbers."""
    return _with(docs, "text", "ids", T.BinaryType(), pa.binary(), tokenizer or default_tokenizer(), "encode")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The table with ``decoded``: the text of each row's ``ids``, special tokens included."""
    return _with(encoded, "ids", "decoded", T.StringType(), pa.string(), tokenizer or default_tokenizer(), "decode")
