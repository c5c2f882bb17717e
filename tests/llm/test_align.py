"""Token alignment against a plain walk over byte offsets."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lumenflow.llm import align, bpe


def _texts():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    out = [None, "", " ", "two  spaces", "tab\tand\nline", "the <|endoftext|> mark </s> <s> <unk>", "한국어 日本語 🙂", "½ ﬁ Å", "ＡＢＣ full width", "a" * 3000, "x " * 20_000, "​ zero", "The quick brown fox", "The quick brown fox", "unbelievably internationalization"]
    return out + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(40)]


def _plain(texts):
    path_a, path_b = align.default_tokenizers()
    one, two = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
    one.encode_special_tokens = True
    byte = {c: b for b, c in enumerate(bpe.byte_characters())}
    docs, counts = [], Counter()
    for t in texts:
        a = one.encode(" " + t, add_special_tokens=False).ids if t else []
        b = two.encode(t) if t else []
        size_a = [bytes(byte[c] for c in one.id_to_token(i)) for i in a]
        size_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or not b"".join(size_a) == b"".join(size_b) == b" " + t.encode():
            docs.append(([], [], [], []))
            continue
        end_a, end_b = (np.cumsum([len(x) for x in s]).tolist() for s in (size_a, size_b))
        links = [(i, end_b.index(e)) for i, e in enumerate(end_a) if e in set(end_b)]
        groups, pa, pb = [], 0, 0
        for i, j in links:
            groups.append((a[pa : i + 1], b[pb : j + 1]))
            pa, pb = i + 1, j + 1
        links = [(a[i], b[j]) for i, j in links]
        counts.update(links)
        docs.append((a, b, groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(len(a), len(b), len(g), len(li), sum(counts[p] == best[p[1]] for p in li), sum(counts[p] for p in li), ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)) for a, b, g, li in docs]


@pytest.mark.parametrize("frequent", [align.FREQUENT, 5])
def test_alignment_against_a_plain_walk(spark, frequent, monkeypatch):
    texts = [*_texts(), "The quick brown fox", "no id"]
    rows = [(i if t != "no id" else None, t, "clash", 1) for i, t in enumerate(texts[:-2])] + [(12, texts[-2], None, None), (None, texts[-1], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` string, n_a int").repartition(3)
    got = align.scored(align.align(docs).cache(), frequent).collect()
    key = lambda r: str(r)
    plain = [((i if k < len(texts) - 2 else (12, None)[k - len(texts) + 2]), *p) for k, (i, p) in enumerate(zip(range(len(texts)), _plain(texts)))]
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got), key=key) == sorted(plain, key=key)
    assert sum(p[1] > 0 for p in plain) > 40


def test_nothing_to_align(spark):
    none = align.align(spark.createDataFrame([], "doc_id long, text string"))
    assert align.scored(none).count() == 0
    only = align.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"))
    assert {(r.doc_id, r.n_a, r.n_links, r.n_best, r.count_sum, r.groups) for r in align.scored(only).collect()} == {(1, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, "")}


def test_components():
    rng = np.random.default_rng(3)
    u, v = rng.integers(0, 200, 120), rng.integers(0, 200, 120)
    got = align.components(200, u, v)
    want = list(range(200))
    for _ in range(200):
        for a, b in zip(u, v):
            want[a] = want[b] = min(want[a], want[b])
    assert got.tolist() == want
    chain = align.components(5000, np.arange(4999), np.arange(1, 5000))
    assert not chain.any()


def test_parts_of_a_batch(spark, monkeypatch):
    sides = align._sides(*align.default_tokenizers())
    whole = align._align(_texts(), sides)
    parts = [align._align([t], sides) for t in _texts()]
    for name, values in whole.items():
        assert [list(x) if name in "abn" else x for x in values] == [list(p[name][0]) if name in "abn" else p[name][0] for p in parts]


def test_parts_between_spaces_are_encoded_alone(monkeypatch):
    pieces = align.PieceTokens(align.default_tokenizers()[1])
    assert pieces.apart
    texts = [t for t in _texts() if t] + ["  lead", "trail  ", "a   b", "\n \n", "▁ x▁y", "\u3000wide", "é ̈", "<0x41> <s>"]
    want = [x if pieces._spelled(x) == b" " + t.encode() else None for x, t in zip(pieces.model.encode(texts), texts)]
    got = lambda: [x if x is None else x.tolist() for x in pieces.encode(texts)]
    assert got() == want and None in want
    monkeypatch.setattr(align, "HELD_CHARS", 10)
    assert got() == want and list(pieces.held) == [" "]
    monkeypatch.setattr(pieces, "apart", False)
    assert got() == want
