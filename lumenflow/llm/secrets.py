"""Secret scans: fixed patterns, and random strings told from identifiers by character Markov models.

Two order-1 character models are estimated from labelled samples, one of random strings and one of
ordinary identifiers; a token is flagged if the mean log-likelihood ratio per transition is above a
threshold. Samples are a documented, bounded parameter: random strings are drawn from the alphabets
of keys with a fixed seed, identifiers are joined from given syllables and common code words.

Defined cases: a null text is empty; repeated rows give repeated results; texts of any length are
scanned whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm._common import session

#: Labelled strings of each kind in the default training sample.
SAMPLE = 4000
#: Least length of a token and least mean log-likelihood ratio (nats per character pair) of a flagged one.
LENGTH, THRESHOLD = 20, 0.6

#: The base patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")

_TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LENGTH},}}")
#: Characters that the models know; all others are one class.
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_CODE = np.full(128, len(_ALPHABET), np.int64)
_CODE[[ord(c) for c in _ALPHABET]] = np.arange(len(_ALPHABET))
_STATES = len(_ALPHABET) + 2  # and the start

#: Parts of ordinary identifiers.
_PARTS = "get set is has make load save read write user name file path data list item index count size type value key map node tree graph table row column text line word page html http request response client server error handler config option default buffer stream parse format print string number integer float result status message session token manager factory service model view control test check find search sort order group merge split join filter update delete create insert select query batch thread lock queue cache memory time date start stop begin end first last next previous left right top bottom width height color image video audio input output source target version release build deploy tion ing ment able ther and the for with that from this have are was not but ander erest onti heat entre quement ación mente keit lich schen ungen".split()


def labelled_samples(n: int = SAMPLE, seed: int = 11) -> tuple[list[str], list[str]]:
    """Random strings and ordinary identifiers."""
    rng = random.Random(seed)
    alphabets = (_ALPHABET[:62], _ALPHABET[:36 - 10] + "0123456789", "0123456789abcdef", "0123456789ABCDEF", _ALPHABET[:64], "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    secrets = ["".join(rng.choices(rng.choice(alphabets), k=rng.randrange(16, 48))) for _ in range(n)]
    plain = []
    for _ in range(n):
        parts = rng.choices(_PARTS, k=rng.randrange(3, 8))
        style = rng.randrange(6)
        joined = ("_".join(parts), "-".join(parts), parts[0] + "".join(p.title() for p in parts[1:]), "".join(parts), "/".join(parts), "_".join(parts).upper())[style]
        plain.append(joined + (str(rng.randrange(1000)) if rng.random() < 0.2 else ""))
    return secrets, plain


def _transitions(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Source and target states of all strings' character pairs, and where each string ends."""
    raw = np.frombuffer("".join(strings).encode("ascii", "replace"), np.uint8).astype(np.int64)
    to = _CODE[np.minimum(raw, 127)]
    ends = np.cumsum([len(s) for s in strings])
    source = np.empty(len(to), np.int64)
    source[1:] = to[:-1]
    source[np.concatenate([[0], ends[:-1]]).astype(np.int64)] = _STATES - 1
    return source * _STATES + to, ends


def train(secrets: list[str], plain: list[str], smooth: float = 0.5) -> np.ndarray:
    """Log-likelihood ratio of each transition."""
    logs = []
    for strings in (secrets, plain):
        at, _ = _transitions(strings)
        counts = np.bincount(at, minlength=_STATES * _STATES).reshape(_STATES, _STATES) + smooth
        logs.append(np.log(counts / counts.sum(1, keepdims=True)))
    return (logs[0] - logs[1]).ravel()


def ratios(model: np.ndarray, tokens: list[str]) -> np.ndarray:
    """Mean log-likelihood ratio per character of each token."""
    if not tokens:
        return np.zeros(0)
    at, ends = _transitions(tokens)
    sums = np.diff(np.concatenate([[0.0], np.cumsum(model[at])])[np.concatenate([[0], ends])])
    return sums / np.diff(np.concatenate([[0], ends]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6] if ":" in text or "=" in text else []
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _listed(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, samples: tuple[list[str], list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256 and spans (kind:start:end, in code points)."""
    session(docs)
    model = train(*(samples or labelled_samples()))

    def run(batches):
        for batch in batches:
            found = [base_spans(t or "") for t in batch.column("text").to_pylist()]
            base = [_listed(s) for s in found]
            owner, tokens, places = [], [], []
            for k, t in enumerate(batch.column("text").to_pylist()):
                taken, at, reach = found[k], 0, 0
                for m in _TOKEN.finditer(t or ""):
                    # both lists ascend by start: the furthest end of all spans that begin before the token's end
                    while at < len(taken) and taken[at][0] < m.end():
                        reach = max(reach, taken[at][2])
                        at += 1
                    if reach <= m.start():
                        owner.append(k)
                        tokens.append(m.group())
                        places.append((m.start(), 3, m.end()))
            for k, place, ratio in zip(owner, places, ratios(model, tokens).tolist()):
                if ratio > threshold:
                    found[k].append(place)
            count = lambda kind: pa.array([sum(s[1] == kind for s in f) for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), count(0), count(1), count(2), count(3), pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]), pa.array([_listed(sorted(f)) for f in found], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string")
