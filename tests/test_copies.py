"""Regions that are copies of each other are worked out once, and spread to all pairs or rows that the results are made of."""

import itertools

import numpy as np
import pytest

from lumenflow.operators import checks, rois


def _boxes(spark, corners, size=2):
    """Squares of ``size`` pixels at the corners, one region each."""
    rows = [(k, r + i, c + j) for k, (r, c) in enumerate(corners) for i in range(size) for j in range(size)]
    return spark.createDataFrame(rows, "roi int, r int, c int"), {k: {(r, c) for n, r, c in rows if n == k} for k in range(len(corners))}


#: Nine places, some of which overlap, touch or lie apart, with one to seven copies.
CORNERS = [p for k, p in enumerate([(0, 0), (1, 1), (2, 2), (0, 4), (5, 5), (7, 5), (6, 4), (20, 20), (3, 0)]) for _ in range(1 + k % 7)]


@pytest.mark.parametrize("block", [1024, 2])
def test_groups_of_copies(spark, monkeypatch, block):
    monkeypatch.setattr(rois, "BLOCK", block)
    pixels, boxes = _boxes(spark, CORNERS)
    near = {(a, b) for a, b in itertools.product(boxes, boxes) if boxes[a] & boxes[b]}
    want = sorted({(a, d) for a, b in near for c, d in near if b == c})
    assert sorted((x.roi, x.other) for x in rois.overlap_groups(pixels.union(pixels.limit(3))).collect()) == want


def test_many_copies_are_one_mask(spark):
    """Through pairs of regions this would take 27 billion steps."""
    pixels = spark.range(3000).selectExpr("cast(id as int) as roi", "explode(array(1, 2)) as r", "3 as c")
    assert rois.same_masks(pixels)[1].count() == 2
    assert rois.overlap_groups(pixels).count() == 9_000_000


@pytest.mark.parametrize("block", [1024, 2])
def test_abutting_copies(spark, monkeypatch, block):
    monkeypatch.setattr(rois, "BLOCK", block)
    pixels, boxes = _boxes(spark, CORNERS)
    for distance in (0, 2**0.5, 2):
        near = lambda a, b: any((r - y) ** 2 + (c - x) ** 2 <= distance**2 + 1e-9 for r, c in boxes[a] for y, x in boxes[b])  # noqa: B023, E731
        want = [(a, b) for a, b in itertools.combinations(boxes, 2) if near(a, b)]
        assert sorted(map(tuple, rois.abutting(pixels, distance).collect())) == want


def test_many_abutting_copies(spark):
    """Through pairs of pixels this would take 324 million rows to remove the repeats from."""
    pixels = spark.range(3000).selectExpr("cast(id as int) as roi", "explode(sequence(1, 4)) as r").selectExpr("roi", "r", "explode(array(3, 4)) as c")
    assert rois.abutting(pixels).count() == 3000 * 2999 // 2


@pytest.mark.parametrize("block", [1024, 2])
def test_overlaps_of_copies(spark, monkeypatch, block):
    monkeypatch.setattr(rois, "BLOCK", block)
    pixels, boxes = _boxes(spark, CORNERS)
    double = pixels.where("roi = 4 and r = 1")  # a pixel that is listed twice counts twice
    listed = {k: sorted(b) + (sorted(p for p in b if p[0] == 1) if k == 4 else []) for k, b in boxes.items()}
    pixels = pixels.union(double)
    got = sorted(map(tuple, rois.overlaps(pixels.where("roi % 2 = 0"), pixels.where("roi % 2 = 1")).collect()))
    want = []
    for a, b in itertools.product(list(boxes)[::2], list(boxes)[1::2]):
        n = sum(p == q for p in listed[a] for q in listed[b])
        if n:
            want.append((a, b, n, n / len(listed[a]), n / len(listed[b])))
    assert got == sorted(want)


def test_regions_around_chosen_ones(spark):
    pixels, boxes = _boxes(spark, CORNERS)
    near = {(a, b) for a, b in itertools.product(boxes, boxes) if boxes[a] & boxes[b]}
    for chosen in ([0], [9, 22], list(boxes), []):
        want = sorted({d for a, b in near for c, d in near if a in chosen and b == c})
        assert sorted(x.roi for x in rois.overlapping(pixels, spark.createDataFrame([(k,) for k in chosen], "roi int")).collect()) == want


def test_demixing_copies(spark):
    """The system of masks gives the least solution of that of all regions."""
    pixels, boxes = _boxes(spark, CORNERS)
    frames = np.random.default_rng(3).uniform(1, 2, (3, 24, 24))
    frames[1, 20:22, 20:22] = 0  # a frame in which a region has no light
    solve = np.linalg.lstsq
    table = spark.createDataFrame([(r, c, t, float(frames[t, r, c])) for t in range(3) for r in range(24) for c in range(24)], "r int, c int, t int, v double")
    got = {(x.roi, x.t): (x.f, x.dropped) for x in checks.demix(table, pixels).collect()}
    masks = np.zeros((len(boxes), 24, 24))
    for k, box in boxes.items():
        for p in box:
            masks[k][p] = 1
    for t, frame in enumerate(frames):
        mean = (masks * frame).sum(axis=(1, 2)) / 4
        if t != 1:
            shared = np.einsum("aij,bij->ab", masks, masks * frame) / mean
            x = solve(shared, 4 * mean, rcond=None)[0]
        for k in boxes:
            assert got[k, t] == ((0.0, True) if t == 1 else (pytest.approx(x[k], abs=1e-9), False))
    assert len(got) == 3 * len(boxes)


def test_many_copies_are_one_unknown(spark):
    """As many unknowns would take a system of 3.2 GB a frame."""
    pixels = spark.range(20_000).selectExpr("cast(id as int) as roi", "explode(array(1, 2)) as r", "3 as c")
    movie = spark.range(8).selectExpr("cast(id % 4 as int) as r", "3 as c", "cast(id div 4 as int) as t", "1.0D + id as v")
    rows = checks.demix(movie, pixels).groupBy("t").agg({"roi": "count", "f": "max"}).orderBy("t").collect()
    # all light of a frame, 2 pixels of mean m, goes in equal shares to the copies
    assert [(x.t, x["count(roi)"]) for x in rows] == [(0, 20_000), (1, 20_000)] and rows[0]["max(f)"] == pytest.approx(2.5 / 20_000)
