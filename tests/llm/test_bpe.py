"""Guess-and-verify BPE against the tokenizers library and against merging step by step."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lumenflow.llm import bpe


@pytest.fixture(scope="module")
def coder():
    return bpe.encoder(bpe.default_tokenizer())


def _texts():
    rng = random.Random(1)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randint(1, n)))
    out = [None, "", " ", "\n\t", "a\x1cb \x1d", "İstanbul ΑΣ ΣΑΣ. Ǆ ẞ", "<|endoftext|>x<|startoftext|> Y<|endo", "<|endoftext|><|endoftext|>", "naïve café é 한국어 日本語 🙂🙂 ﬁ ½ ² ٣"]
    out += ["don't we'll I'M 'S 12345 a1b2", "\x85\xa0x", "!?-=" * 50, "a" * 5000, "​﻿zero", "ſ K Å", "é ̈́", "x1!" * 90_000]
    out += [some("abcdefghijklmnopqrstuvwxyz", 40) for _ in range(800)] + [some("aeinst'!?.01", 60) for _ in range(300)]
    return out + ["".join(chr(rng.choice([rng.randint(32, 0x3000), rng.randint(0, 300)])) for _ in range(rng.randint(1, 60))) for _ in range(400)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", "clash", 1.5) for i, t in enumerate(_texts())]
    return spark.createDataFrame([*rows, rows[9], (None, "no id", None, None, None)], "doc_id long, text string, decoded string, Ids string, n_b double").repartition(3)


def test_ids_and_texts_are_the_library_s(spark, docs):
    got = bpe.decode(bpe.encode(docs))
    assert got.columns == ["doc_id", "text", "n_b", "ids", "decoded"]
    got = got.collect()
    library = Tokenizer.from_file(bpe.default_tokenizer())
    assert len(got) == len(_texts()) + 2
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want, r.text
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none)).count() == 0


def test_guesses_are_verified_and_some_fail(coder):
    before = coder.guessed, coder.failed
    coder.encode([w + " zq" for w in _texts()[20:600]])
    assert 0 < coder.failed - before[1] < coder.guessed - before[0]


def test_all_neighbours_against_merging(coder):
    """The test of neighbours says what merging the two tokens' symbols says."""
    m, rng = coder.merges, np.random.default_rng(5)
    inner = [t for t, w in coder.text_of.items() if not w.endswith("</w>") and t not in coder.special.values()]
    a, b = rng.choice(inner[512:20_000], 4000), rng.choice([t for t in coder.text_of if t not in coder.special.values()], 4000)
    got = m.compatible(a, b)
    want = [m.merge([*m.symbols(x), *m.symbols(y)]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert got.tolist() == want and 100 < sum(want) < 3900


def test_merging_together_and_alone(coder):
    m, rng = coder.merges, np.random.default_rng(6)
    words = [coder.inner[rng.integers(97, 101, rng.integers(1, 30))] for _ in range(500)] + [coder.inner[[97] * 9]]
    assert [w.tolist() for w in m.merge_all(words)] == [m.merge(w.tolist()) for w in words]


def test_small_merge_tables():
    """All words over two letters, with merges whose ranks interact: equal runs, tokens that merging never makes."""
    rng = np.random.default_rng(7)
    for _ in range(60):
        spell, pairs, made = {0: "a", 1: "b"}, [], []
        known = {"a": 0, "b": 1}
        for _ in range(8):
            x, y = rng.choice(list(spell), 2).tolist()
            if spell[x] + spell[y] in known or len(spell[x] + spell[y]) > 6:
                continue
            t = len(spell)
            spell[t] = spell[x] + spell[y]
            known[spell[t]] = t
            pairs.append((x, y))
            made.append(t)
        m = bpe.Merges(pairs, made, len(spell))
        for t in spell:
            assert m.sound[t] == (m.merge(m.symbols(t)) == [t])
        usable = np.array([t for t in made if m.sound[t]], int)
        longest = bpe.LongestMatch(m, usable)
        for n in range(1, 10):
            for k in range(2**n):
                word = np.array([k >> i & 1 for i in range(n)])
                best, length = longest.at(word, n - np.arange(n))
                ids, p = [], 0
                while p < n:
                    ids.append(int(best[p]))
                    p += int(length[p])
                ids = np.array(ids)
                if m.compatible(ids[:-1], ids[1:]).all():
                    assert ids.tolist() == m.merge(word.tolist())


def test_small_tables_of_words(coder, monkeypatch):
    want = coder.encode(_texts()[17:300])
    monkeypatch.setattr(bpe, "HELD_CHARS", 50)
    monkeypatch.setattr(bpe, "CHARS_AT_ONCE", 100)
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 2)
    assert coder.encode(_texts()[17:300]) == want
    assert [x for part in bpe.slices(pa.array(["ab", None, "c" * 300, ""])) for x in part] == ["ab", None, "c" * 300, ""]


def test_other_rules_are_refused(tmp_path):
    import json

    with open(bpe.default_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["normalizer"] = None
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.WordEncoder(str(tmp_path / "t.json"))
