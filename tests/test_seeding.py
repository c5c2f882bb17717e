"""Seeds against going through them one by one."""

import math

import numpy as np
import pytest

from lumenflow.operators import seeding


def _image(seed=0, rows=23, columns=31, ties=False):
    v = np.random.default_rng(seed).random((rows, columns))
    return np.round(v, 1) if ties else v


def _pixels(spark, image):
    r, c = np.mgrid[: image.shape[0], : image.shape[1]]
    return spark.createDataFrame(list(zip(r.ravel().tolist(), c.ravel().tolist(), image.ravel().tolist())), "r int, c int, v double").repartition(3)


def _order(image, block, keep):
    if block is None:
        seeds = [(r, c) for r in range(image.shape[0]) for c in range(image.shape[1])]
    else:
        seeds = []
        for r in range(0, image.shape[0], block):
            for c in range(0, image.shape[1], block):
                part = image[r : r + block, c : c + block]
                i, j = np.unravel_index(part.argmax(), part.shape)
                seeds.append((r + int(i), c + int(j)))
    seeds.sort(key=lambda p: (-image[p], p))
    n = math.floor(keep * len(seeds))
    return seeds[:n], seeds[n:]


def _batches(left, samples, distance, barred=(), grow=None, buffer=1):
    """All batches, and the seeds passed over, one candidate after another."""
    left, barred, out, passed = list(left), set(barred), [], []
    while left:
        taken, i = [], 0
        while len(taken) < samples and i < len(left):
            if left[i] in barred:
                passed.append(left.pop(i))
            elif all(math.dist(left[i], t) >= distance for t in taken):
                taken.append(left.pop(i))
            else:
                i += 1
        out.append(taken)
        if grow:
            barred |= {(r + i, c + j) for r, c in grow(taken) for i in range(-buffer, buffer + 1) for j in range(-buffer, buffer + 1)}
    return out, passed


@pytest.mark.parametrize("samples,distance,ties", [(5, 9.0, False), (1, 0.0, True), (4, 3.5, True)])
def test_batches_are_those_of_the_sequential_rule(spark, samples, distance, ties):
    image = _image(3, ties=ties)
    kept, late = _order(image, 4, 0.7)
    candidates = seeding.image_candidates(_pixels(spark, image), 0.7, 4)
    seeds = seeding.Seeds(candidates, samples, distance)
    got = []
    for _ in range(4):
        batch = seeds.next()
        got.append([(x.r, x.c) for x in batch.orderBy("k").collect()])
    want, _ = _batches(kept, samples, distance)
    assert got == want[:4]
    log = {(x.r, x.c): (x.status, x.batch) for x in seeds.log().collect()}
    given = {p: (seeding.PROVIDED, b) for b, batch in enumerate(got) for p in batch}
    assert log == {p: given.get(p, (seeding.NEVER, None)) for p in kept} | {p: (seeding.BY_SHARE, None) for p in late}


def test_regions_bar_seeds_between_batches(spark):
    image = _image(4)
    kept, _ = _order(image, 3, 0.3)
    star = lambda batch: [(r + i, c) for r, c in batch for i in (-1, 0, 1)]
    want, passed = _batches(kept, 3, 4.0, grow=star, buffer=2)

    def grow(batch):
        return batch.selectExpr("explode(array(r - 1, r, r + 1)) as r", "c")

    seeds = seeding.Seeds(seeding.image_candidates(_pixels(spark, image), 0.3, 3), 3, 4.0, buffer=2)
    log = seeding.grown(seeds, grow).collect()
    got = {}
    for x in log:
        if x.status == seeding.PROVIDED:
            got.setdefault(x.batch, set()).add((x.r, x.c))
    assert [got.get(b, set()) for b in range(len(want))] == [set(w) for w in want] and passed
    assert {(x.r, x.c) for x in log if x.status == seeding.BY_REGION} == set(passed)


def test_choice_takes_several_tasks_and_all_places(spark):
    rng = np.random.default_rng(5)
    at = {(int(r), int(c)) for r, c in rng.integers(0, 60, (500, 2))}
    ranked = spark.createDataFrame([(*p, k) for k, p in enumerate(sorted(at, key=lambda p: (p[0] * 7919 + p[1] * 104729) % 997))], "r int, c int, rank long").repartition(4)
    near = seeding.near_pairs(ranked, 6.5)
    rows = sorted((x["rank"], (x.r, x.c)) for x in ranked.collect())
    want = {(a, b) for a, p in rows for b, q in rows if a < b and math.dist(p, q) < 6.5}
    assert {(x.a, x.b) for x in near.collect()} == want
    taken = []
    for k, p in rows:
        if all(math.dist(p, q) >= 6.5 for _, q in taken):
            taken.append((k, p))
    assert [x["rank"] for x in seeding.chosen_apart(ranked, near, 10_000).collect()] == [k for k, _ in taken]
    assert [x["rank"] for x in seeding.chosen_apart(ranked, near, 7).collect()] == [k for k, _ in taken[:7]]
    assert near.rdd.getNumPartitions() > 1


def test_every_pixel_and_no_pixel(spark):
    image = np.array([[0.0, 1, 2, 3], [1, 2, 3, 4], [2, 3, 4, 5], [3, 4, 5, 6]])
    first = seeding.image_candidates(_pixels(spark, image), 0.2).where("kept").orderBy("v").collect()
    assert {(x.r, x.c) for x in first} == {(3, 3), (2, 3), (3, 2)}
    none = seeding.Seeds(_pixels(spark, image).where("v > 9"), 3, 2.0)
    assert none.next() is None and none.log().count() == 0


@pytest.mark.parametrize("block", [16_384, 7])
def test_all_batches_are_those_handed_out_one_by_one(spark, monkeypatch, block):
    monkeypatch.setattr(seeding, "BLOCK", block)
    image = _image(6)
    for samples, distance in ((3, 4.0), (2, 0.0), (5, 9.5), (1, 2.0)):
        kept, _ = _order(image, 3, 0.9)
        want, _ = _batches(kept, samples, distance)
        candidates = seeding.image_candidates(_pixels(spark, image), 0.9, 3).where("kept")
        got = {}
        for x in sorted(seeding.seed_batches(candidates, candidates.select("r", "c").where("false"), samples, distance).collect(), key=lambda x: (x.batch, x.k)):
            got.setdefault(x.batch, []).append((x.r, x.c))
        assert [got[b] for b in range(len(got))] == want
