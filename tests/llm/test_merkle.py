"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lumenflow.llm import merkle

ROW = "doc_id long, text string, lang string, source string, n_chars long, leaf string, k string, path string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _plain(rows):
    """rows: (doc_id, text, lang, source, n_chars) -> root and, by row, (leaf, subroot, siblings, path)."""
    leaf = lambda r: H(*(_enc(v) for v in (r[0], r[3], r[2], r[4], r[1])))

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def path(levels, i):
        for level in levels[:-1]:
            run = level[i // 3 * 3 : i // 3 * 3 + 3]
            yield run, i % 3
            i //= 3

    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        trees[s] = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    levels = {s: tree([leaf(r) for r in trees[s]]) for s in sources}
    top = tree([levels[s][-1][0] for s in sources])
    out = []
    for j, s in enumerate(sources):
        for i, r in enumerate(trees[s]):
            steps = [*path(levels[s], i), *path(top, j)]
            out.append((r, leaf(r), levels[s][-1][0], "".join(x for run, at in steps for y, x in enumerate(run) if y != at), steps))
    return top[-1][0], out


def _fold(digest, steps):
    for run, at in steps:
        digest = H(*run[:at], digest, *run[at + 1 :])
    return digest


def _rows():
    rows = [(i, f"a\nb{i}" if i % 3 else f"é{i}", "en" if i % 5 else None, "big", i) for i in range(300)]
    rows += [(i, "x\ny" * 3, "de", f"s{i % 7}", None) for i in range(25)]
    rows += [(7, None, None, None, 1), (None, "a\nb", None, None, None), (None, "", "en", "big", 0), (3, "a\nb", "en", "big", 1), (3, "a\nb", "en", "big", 1), (5, "t" * 300_000 + "\n", "en", "lone", 9), (6, "z", "en", "", 1), (-4, "neg\n", "fr", "é", 2)]
    return rows


@pytest.mark.parametrize("rows", [_rows(), [(1, "only\n", None, None, None)], [(1, "a", "x", "s", 1), (2, "b\n", "x", "s", 1)]])
def test_merkle_against_a_plain_tree(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], ROW).repartition(3)
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    got = merkle.report(docs, F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    got = got.withColumn("siblings", merkle.siblings(F.col("path"))).drop("path").collect()
    root, plain = _plain(rows)
    want = []
    for (doc_id, text, lang, source, n), leaf, subroot, beside, steps in plain:
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            text = text.replace("\n", "")
        changed = H(*(_enc(v) for v in (doc_id, source, lang, n, text)))
        folded = _fold(changed, steps)
        want.append((doc_id, leaf, subroot, root, beside, folded, folded == root))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.siblings, r.folded_root, r.verified) for r in got), key=key) == sorted(want, key=key)


def test_merkle_of_nothing(spark):
    assert merkle.report(spark.createDataFrame([], ROW), F.col("text")).count() == 0
    assert merkle.documents_manifest(spark.createDataFrame([], ROW)).root is None


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError):
        merkle.manifest(spark.createDataFrame([("0", "x", 1)], "tree string, leaf string, K int"), [])


def test_leaves_are_ranked_over_tasks(spark):
    """Places of one large tree come from several tasks, not from a window over the tree."""
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    made = merkle.documents_manifest(docs)
    assert [r.k for r in made.leaves.orderBy("doc_id").collect()] == list(range(2000))
    assert made.leaves.groupBy(F.expr("spark_partition_id()")).count().count() > 1
