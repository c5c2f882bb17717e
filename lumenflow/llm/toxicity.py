"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as two learnt vectors: its own, from a bounded vocabulary (words outside share one), and the
sum of those of its character runs (four bytes in a row, the first three to eight and the last three) over
the root of their number. All vectors begin with the word's log-odds of toxic against clean labelled documents, drawn to zero where few
documents back them; vectors and network are then trained together. A two-way GRU reads windows of
32 words that overlap by 8; attention pools its states to a probability, and a document's score is that of
its highest window. Every word of every window of the whole text is read by the network.

The network is trained in one task from a bounded sample of labelled rows (``SAMPLE``, taken by a
hash of doc_id); a toxic document teaches through its currently highest window. Everything else runs
over all documents in tasks, with the model as a broadcast of bounded size. The driver sees only the model.

Defined cases: null and empty texts get the score of an empty window; without any usable label, or
with one class only, the network stays as it began; null labels don't teach; a null doc_id isn't held out;
repeated rows get the same score; extra columns are ignored, and kept by ``drop_toxic``.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.llm import _text as tx
from lumenflow.llm._common import session, text_key

#: Bound of the labelled sample, and the probability from which a document counts as toxic.
SAMPLE, THRESHOLD = 4000, 0.7
WINDOW, STRIDE = 32, 24
#: Words and character runs with a vector of their own: those in the most labelled documents, in so many at least.
VOCABULARY, LEAST_DOCUMENTS = 1 << 15, 5
#: Deviations (squared) from chance at which a key's log-odds count half.
BACKING = 12
#: The score below which a toxic row may be left out of a round, and the share of them that may.
DOUBT, DOUBTED = 0.2, 0.1
#: Spread of the vectors' first values.
NOISE = 0.03
#: Pull of the vectors back to where they began, and their rate of learning as a share of the network's.
DECAY, VECTOR_RATE = 1e-2, 0.05
#: Bytes at the start of a word that are runs too, and at its end (negative).
_ENDS = (3, 4, 5, 6, 7, 8, -3)
#: Sizes of a word's vector, of its characters' and of the state of each direction.
_WORD, _CHARS, _HIDDEN = 8, 8, 6
_INPUTS = _WORD + _CHARS
#: Windows whose words are looked up at once, and windows that the network reads at once.
_SPAN, _BLOCK = 8192, 2048

#: Separators: all ASCII but letters and digits.
_BREAKS = np.ones(256, bool)
_BREAKS[128:] = False
_BREAKS[[c for c in range(128) if chr(c).isalnum()]] = False


def window_counts(n: np.ndarray) -> np.ndarray:
    return np.where(n <= WINDOW, 1, -(-(n - WINDOW) // STRIDE) + 1)


def windows(first: np.ndarray):
    """Row, first word and length of each window; a row without words has one of length zero."""
    n = np.diff(first)
    count = window_counts(n)
    row = np.repeat(np.arange(len(n)), count)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return row, first[row] + start, np.minimum(n[row] - start, WINDOW)


def _runs(words: tx.Words):
    """Keys of the character runs of each word, and how many it has."""
    size = words.ends - words.starts
    fours = np.maximum(size - 3, 0)
    count = fours + len(_ENDS)
    cut = np.cumsum(count) - count
    at = np.repeat(words.starts - cut, count) + np.arange(int(count.sum()))
    key = tx.bytes_at(words.buf, at, 4)
    for k, length in enumerate(_ENDS):
        part = np.minimum(size, abs(length))
        start = words.starts if length > 0 else words.ends - part
        key[cut + fours + k] = tx.mix(tx.bytes_at(words.buf, start, part) ^ tx.mix(np.array([64 + length], np.uint64)))
    return key, count


class Vocabulary:
    """Known keys, sorted, and for each its share of toxic documents as log-odds; index 0 is any other key."""

    def __init__(self, keys: np.ndarray, row: np.ndarray, toxic: np.ndarray):
        order = np.lexsort((row, keys))
        k, r = keys[order], row[order]
        once = np.ones(len(k), bool)
        once[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
        k, r = k[once], r[once]
        cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        n = np.diff(np.append(cut, len(k)))
        bad = np.add.reduceat(toxic[r].astype(int), cut) if len(k) else n
        often = np.flatnonzero(n >= LEAST_DOCUMENTS)
        often = np.sort(often[np.argsort(-n[often], kind="stable")[:VOCABULARY]])
        self.keys, n, bad = k[cut[often]], n[often], bad[often]
        share = np.clip(toxic.mean() if len(toxic) else 0.5, 1e-3, 1 - 1e-3)
        odds = np.log((bad + share) / (n - bad + 1 - share) * (1 - share) / share)
        backing = (bad - n * share) ** 2 / (n * share * (1 - share))
        self.odds = np.append(0.0, odds * backing / (backing + BACKING))

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at + 1, 0)


def _sigmoid(a):
    return 0.5 * (np.tanh(0.5 * a) + 1)


class Network:
    """Two GRUs, attention and a logistic output. Parameters are float64 while training."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        d, h = _INPUTS, _HIDDEN
        self.p = {}
        for way in "fb":
            self.p[f"W{way}"], self.p[f"U{way}"], self.p[f"b{way}"] = rng.normal(0, 0.3, (d, 3 * h)), rng.normal(0, 0.3, (h, 3 * h)), np.zeros(3 * h)
        self.p |= {"A": rng.normal(0, 0.4, (2 * h, h)), "a": np.zeros(h), "v": rng.normal(0, 0.4, h), "w": rng.normal(0, 0.4, 2 * h), "c": np.zeros(1)}

    def gates(self, x: np.ndarray, way: str) -> np.ndarray:
        """What inputs give the gates of a direction."""
        return x @ self.p[f"W{way}"].astype(x.dtype) + self.p[f"b{way}"].astype(x.dtype)

    def _gru(self, gates, live, way, keep):
        """States of all steps; ``gates`` gives those of the windows at a step."""
        h, steps = _HIDDEN, []
        U = self.p["U" + way]
        n, size = live.shape
        U = U.astype(gates(0).dtype)
        state = np.zeros((n, h), U.dtype)
        out = np.zeros((size, n, h), U.dtype)
        for t in range(size) if way == "f" else range(size - 1, -1, -1):
            g, s = gates(t), state @ U
            zr = _sigmoid(g[:, : 2 * h] + s[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(g[:, 2 * h :] + r * s[:, 2 * h :])
            if keep:
                steps.append((t, state, s, z, r, new))
            state = np.where(live[:, t, None], new + z * (state - new), state)
            out[t] = state
        return out, steps

    def forward(self, gates, length, size: int, keep: bool = False):
        """Probability of each window; with keep also what the gradient needs. ``gates``: step and direction to gates."""
        live = np.arange(size)[None, :] < length[:, None]
        f, fs = self._gru(lambda t: gates(t, "f"), live, "f", keep)
        b, bs = self._gru(lambda t: gates(t, "b"), live, "b", keep)
        states = np.concatenate([f, b], axis=2)  # step, window, state
        kind = states.dtype
        u = np.tanh(states @ self.p["A"].astype(kind) + self.p["a"].astype(kind))
        e = np.where(live.T, u @ self.p["v"].astype(kind), -1e9)
        e = np.exp(e - e.max(0)) * live.T
        alpha = e / np.maximum(e.sum(0), 1e-9)
        pooled = (alpha[:, :, None] * states).sum(0)
        prob = _sigmoid(pooled @ self.p["w"].astype(kind) + self.p["c"].astype(kind))
        return (prob, (live, fs, bs, states, u, alpha, pooled)) if keep else prob

    def gradient(self, prob, target, x, saved):
        """Of the mean log loss: of the parameters, and of the inputs ``x`` (step, window, input)."""
        live, fs, bs, states, u, alpha, pooled = saved
        p, h = self.p, _HIDDEN
        d = (prob - target) / len(prob)
        g = {"w": pooled.T @ d, "c": np.array([d.sum()])}
        d_pooled = d[:, None] * p["w"]
        d_alpha = (states * d_pooled).sum(2)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(0))
        g["v"] = (u * d_e[:, :, None]).sum((0, 1))
        d_u = d_e[:, :, None] * p["v"] * (1 - u**2)
        g["A"], g["a"] = np.einsum("tbk,tbj->kj", states, d_u), d_u.sum((0, 1))
        d_states = alpha[:, :, None] * d_pooled + d_u @ p["A"].T
        d_x = np.zeros_like(x)
        for way, steps, part in (("f", fs, slice(0, h)), ("b", bs, slice(h, 2 * h))):
            W, U = p[f"W{way}"], p[f"U{way}"]
            gW, gU, gb, carry = np.zeros_like(W), np.zeros_like(U), np.zeros(3 * h), np.zeros((x.shape[1], h))
            for t, state, s, z, r, new in reversed(steps):
                total = carry + d_states[t, :, part]
                on = live[:, t, None]
                d_new = np.where(on, total, 0)
                d_n = d_new * (1 - z) * (1 - new**2)
                d_z = d_new * (state - new) * z * (1 - z)
                d_r = d_n * s[:, 2 * h :] * r * (1 - r)
                d_gates = np.concatenate([d_z, d_r, d_n], axis=1)
                d_s = np.concatenate([d_z, d_r, d_n * r], axis=1)
                gW += x[t].T @ d_gates
                gb += d_gates.sum(0)
                gU += state.T @ d_s
                d_x[t] += d_gates @ W.T
                carry = np.where(on, d_new * z, total) + d_s @ U.T
            g |= {f"W{way}": gW, f"U{way}": gU, f"b{way}": gb}
        return g, d_x


class Model:
    """Vocabularies, vectors and network; fitted to texts with labels."""

    def __init__(self, texts: pa.Array, toxic: np.ndarray, rounds: int = 6, steps: int = 25, batch: int = 256, rate: float = 0.02, seed: int = 1):
        words = tx.words_of(texts, _BREAKS, lower=True)
        row = np.repeat(np.arange(len(toxic)), np.diff(words.first))
        hashes = tx.hash_words(words, 3)
        kinds, first, self_of = np.unique(hashes, return_index=True, return_inverse=True)
        self.words = Vocabulary(hashes, row, toxic)
        runs, count = _runs(tx.Words(words.buf, words.starts[first], words.ends[first], words.first))
        self.chars = self._run_vocabulary(runs, count, self_of, row, toxic)
        self.network = Network()
        rng = np.random.default_rng(seed)
        for name, vocabulary, size in (("words", self.words, _WORD), ("chars", self.chars, _CHARS)):
            vectors = rng.normal(0, NOISE, (len(vocabulary.odds), size))
            vectors[:, 0] += vocabulary.odds
            self.network.p[name] = vectors
        if 0 < toxic.sum() < len(toxic):
            self._fit(words, self.words.of(kinds), self.chars.of(runs), count, self_of, toxic, rng, rounds, steps, batch, rate)
        self.network.p = {k: v.astype(np.float32) for k, v in self.network.p.items()}

    @staticmethod
    def _run_vocabulary(runs, count, self_of, row, toxic):
        """Of the character runs of all words, each counted once for a row."""
        pair = np.unique(self_of.astype(np.uint64) << np.uint64(32) | row.astype(np.uint64))
        kind, at = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = np.cumsum(count) - count
        n = count[kind]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return Vocabulary(runs[np.repeat(start[kind], n) + step], np.repeat(at, n), toxic)

    def _char_sums(self, run, count):
        """The sum of each word's runs over the root of their number, a bounded number of runs at a time."""
        table, out = self.network.p["chars"], np.zeros((len(count), _CHARS), self.network.p["chars"].dtype)
        owner = np.repeat(np.arange(len(count)), count)
        for lo in range(0, len(run), 1 << 18):
            o = owner[lo : lo + (1 << 18)]
            cut = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
            out[o[cut]] += np.add.reduceat(table[run[lo : lo + (1 << 18)]], cut, axis=0)
        return out / np.sqrt(count)[:, None].astype(out.dtype)

    def _vectors(self, word, run, count):
        return np.concatenate([self.network.p["words"][word], self._char_sums(run, count)], axis=1)

    def _read(self, vectors, at, length):
        """Probability of windows whose words have these numbers in ``vectors``."""
        tables = {way: self.network.gates(vectors, way) for way in "fb"}
        out = [np.zeros(0, vectors.dtype)]
        for lo in range(0, len(length), _BLOCK):
            grid = at[lo : lo + _BLOCK]
            out.append(self.network.forward(lambda t, way: tables[way][grid[:, t]], length[lo : lo + _BLOCK], WINDOW))
        return np.concatenate(out)

    def _fit(self, words, word, run, count, self_of, toxic, rng, rounds, steps, batch, rate):
        """A toxic row's highest window is its example; of clean rows all windows are, half of them by chance and
        half from their highest."""
        p = self.network.p
        row, start, length = windows(words.first)
        grid = np.append(self_of, 0)[np.minimum(start[:, None] + np.arange(WINDOW)[None, :], len(self_of))]
        own = np.cumsum(count) - count
        clean = np.flatnonzero(~toxic[row])
        begun = {name: p[name] for name in ("words", "chars")}
        m, v, k = {}, {}, 0
        for turn in range(rounds):
            vectors = self._vectors(word, run, count)
            live = np.arange(WINDOW)[None, :] < length[:, None]
            score = (vectors[:, 0][grid] * live).max(1) if not turn else self._read(vectors.astype(np.float32), grid, length)
            order = np.lexsort((-score, row))
            top = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])]
            bad, hard = top[toxic[row[top]]], top[~toxic[row[top]]]
            if turn:  # rows without any sign of their label teach nothing but themselves
                bad = bad[score[bad] >= min(DOUBT, np.quantile(score[bad], DOUBTED))]
            for _ in range(steps):
                pick = np.concatenate([rng.choice(bad, batch * 3 // 8), rng.choice(clean, batch // 4), rng.choice(hard, batch * 3 // 8)])
                kinds, at = np.unique(grid[pick], return_inverse=True)
                n = count[kinds]
                runs = run[np.repeat(own[kinds] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
                x = self._vectors(word[kinds], runs, n)[at.reshape(len(pick), WINDOW)].transpose(1, 0, 2)
                gates = {way: self.network.gates(x, way) for way in "fb"}
                prob, saved = self.network.forward(lambda t, way: gates[way][t], length[pick], WINDOW, keep=True)
                g, d_x = self.network.gradient(prob, toxic[row[pick]].astype(float), x, saved)
                place = at.reshape(len(pick), WINDOW).T.ravel()
                order = np.argsort(place, kind="stable")
                d_kind = np.add.reduceat(d_x.reshape(-1, _INPUTS)[order], np.searchsorted(place[order], np.arange(len(kinds))), axis=0)
                for name, vectors in begun.items():
                    g[name] = DECAY * (p[name] - vectors)
                np.add.at(g["words"], word[kinds], d_kind[:, :_WORD])
                np.add.at(g["chars"], runs, np.repeat(d_kind[:, _WORD:] / np.sqrt(n)[:, None], n, axis=0))
                k += 1
                for name, x_g in g.items():
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * x_g
                    v[name] = 0.99 * v.get(name, 0) + 0.01 * x_g**2
                    p[name] = p[name] - (VECTOR_RATE if name in begun else 1) * rate * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.99**k)) + 1e-8)

    def scores(self, column: pa.Array) -> np.ndarray:
        """Of each text: its highest window's. Words are looked up for a bounded number of windows at a time."""
        words = tx.words_of(column, _BREAKS, lower=True)
        row, start, length = windows(words.first)
        out = np.zeros(len(words.first) - 1, np.float32)
        for lo in range(0, len(row), _SPAN):
            part = slice(lo, lo + _SPAN)
            a, b = int(start[part][0]), int((start[part] + length[part]).max())
            span = tx.Words(words.buf, words.starts[a:b], words.ends[a:b], words.first)
            kinds, first, at = np.unique(tx.hash_words(span, 3), return_index=True, return_inverse=True)
            runs, count = _runs(tx.Words(words.buf, span.starts[first], span.ends[first], words.first))
            vectors = np.concatenate([self._vectors(self.words.of(kinds), self.chars.of(runs), count), np.zeros((1, _INPUTS), np.float32)])
            grid = np.append(at, len(kinds))[np.minimum(start[part][:, None] - a + np.arange(WINDOW)[None, :], b - a)]
            np.maximum.at(out, row[part], self._read(vectors, grid, length[part]))
        return np.clip(out, 0, 1)


def held_out(doc_id: Column) -> Column:
    """The third of the documents that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _trained(batches):
    """The pickled model of the rows of one partition, which holds the bounded sample."""
    parts = [(b.column("text"), b.column("toxic")) for b in batches]
    text, toxic = (pa.chunked_array([p[k] for p in parts], kind).combine_chunks() for k, kind in ((0, pa.string()), (1, pa.int32())))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Model(text, np.asarray(toxic).astype(bool)))], pa.binary())], ["model"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # the documents of at most ``sample`` ids
    one = rows.repartition(1).sortWithinPartitions("doc_id", text_key(F.col("text"))).select("text", "toxic")
    row = one.mapInArrow(_trained, "model binary").first()
    return pickle.loads(row[0]) if row else Model(pa.array([], pa.string()), np.zeros(0, bool))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text_key, held_out, score, predicted of every row."""
    spark = session(docs)
    model = spark.sparkContext.broadcast(train(docs, labels, sample))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(model.value.scores(batch.column("text")).astype(float))], ["doc_id", "text_key", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text").mapInArrow(run, "doc_id long, text_key long, score double")
    return out.select("doc_id", "text_key", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows scored below the threshold, in one pass over the documents."""
    spark = session(docs)
    model = spark.sparkContext.broadcast(train(docs, labels, sample))

    at, plain = docs.columns.index("text"), docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # names may hold dots

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.value.scores(batch.column(at)) < THRESHOLD))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
