"""TIFF files built here, byte by byte, read and split by Spark."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenflow.operators import splitting
from lumenflow.sources import tiff

REGIONS = [{"zs": [30.0, 22.5]}, {"zs": 17.25}]


def _header(volumes=9, slices=3, depths="[30 0 22.5 0;17.25 0]", channels="1", regions=REGIONS):
    settings = f"SI.hStackManager.actualNumVolumes = {volumes}\nSI.hStackManager.actualNumSlices = {slices}\nSI.hChannels.channelSave = {channels}\nSI.hStackManager.zsAllActuators = {depths}\nSI.name = 'a b'\nSI.on = true\n\0".encode()
    groups = json.dumps({"RoiGroups": {"imagingRoiGroup": {"rois": regions}}}).encode() + b"\0"
    return settings, groups


def _tiff(path, pages, big=True, order="<", rows_per_strip=5, header=None):
    """Pages as uncompressed strips, directories between them."""
    out = bytearray()
    mark = b"II" if order == "<" else b"MM"
    wide, entry = ("Q", "Q") if big else ("I", "I")
    out += mark + (struct.pack(f"{order}HHHQ", 43, 8, 0, 0) if big else struct.pack(f"{order}HI", 42, 0))
    link = 8 if big else 4
    if header:
        out += struct.pack(f"{order}4I", 117637889, 3, len(header[0]), len(header[1])) + header[0] + header[1]
    for page in pages:
        strips = [page[i : i + rows_per_strip].astype(page.dtype.newbyteorder(order)).tobytes() for i in range(0, len(page), rows_per_strip)]
        at = []
        for s in strips:
            at.append(len(out))
            out += s
        lists = {}
        if len(strips) > 1:
            for tag, values in ((273, at), (279, [len(s) for s in strips])):
                lists[tag] = len(out)
                out += struct.pack(f"{order}{len(values)}{wide}", *values)
        kind = {"u": 1, "i": 2, "f": 3}[page.dtype.kind]
        tags = [(256, 3, [page.shape[1]]), (257, 4, [page.shape[0]]), (258, 3, [page.dtype.itemsize * 8]), (259, 3, [1]), (273, 16 if big else 4, at), (277, 3, [1]), (279, 16 if big else 4, [len(s) for s in strips]), (339, 3, [kind])]
        struct.pack_into(f"{order}{wide}", out, link, len(out))
        out += struct.pack(f"{order}{'Q' if big else 'H'}", len(tags))
        for tag, form, values in tags:
            size = 8 if big else 4
            if tag in lists:
                value = struct.pack(f"{order}{wide}", lists[tag])
            else:
                value = struct.pack(f"{order}{'H' if form == 3 else ('Q' if form == 16 else 'I')}", values[0]).ljust(size, b"\0")
            out += struct.pack(f"{order}HH{entry}", tag, form, len(values)) + value
        link = len(out)
        out += struct.pack(f"{order}{wide}", 0)
    with open(path, "wb") as f:
        f.write(out)
    return str(path)


def _pages(n, rows=12, columns=7, kind="int16", seed=0):
    return [p.astype(kind) for p in np.random.default_rng(seed).integers(-300 if kind[0] == "i" else 0, 300, (n, rows, columns))]


@pytest.mark.parametrize("big,order,kind", [(True, "<", "int16"), (False, ">", "uint16"), (False, "<", "float32"), (True, ">", "uint8")])
def test_pages_are_read_in_ranges(spark, tmp_path, big, order, kind):
    pages = _pages(11, kind=kind) if kind != "uint8" else [p % 200 for p in _pages(11, kind=kind)]
    path = _tiff(tmp_path / "a.tif", pages, big, order)
    read = tiff.read_pages(spark, [path], 4)
    assert read.rdd.getNumPartitions() == 3
    rows = read.orderBy("page").collect()
    assert [r.page for r in rows] == list(range(11))
    for r, page in zip(rows, pages):
        assert (np.frombuffer(bytes(r.pixels), r.kind).reshape(r.rows, r.columns) == page).all()
    cells = {(r.page, r.r, r.c): r.v for r in tiff.pixels(read.where("page < 2").select("page", "rows", "columns", "kind", "pixels")).collect()}
    assert cells == {(k, i, j): float(pages[k][i, j]) for k in range(2) for i in range(12) for j in range(7)}


def test_the_scanner_header(spark, tmp_path):
    path = _tiff(tmp_path / "a.tif", _pages(3), header=_header())
    settings, groups = tiff.scanner_header(path)
    assert settings["SI.name"] == "a b" and settings["SI.on"] is True and settings["SI.hStackManager.zsAllActuators"] == [[30, 0, 22.5, 0], [17.25, 0]]
    row = tiff.headers(spark, [path]).first()
    assert (row.volumes, row.slices) == (9, 3) and json.loads(row.regions) == REGIONS and groups["RoiGroups"]
    assert tiff.read_pages(spark, [path]).count() == 3
    for bad in (_tiff(tmp_path / "b.tif", _pages(1)), _tiff(tmp_path / "c.tif", _pages(1), big=False)):
        with pytest.raises(ValueError):
            tiff.scanner_header(bad)
    (tmp_path / "d.tif").write_bytes(b"PNG" + bytes(30))
    with pytest.raises(ValueError):
        tiff.scanner_header(str(tmp_path / "d.tif"))


def test_planes_in_page_order():
    row = lambda depths, channels="1", regions=REGIONS: {"depths": json.dumps(depths), "channels": channels, "regions": json.dumps(regions)}
    assert [(p.place, p.region, p.z) for p in splitting.planes_of(row([[30, 0, 22.5, 0], [17.25, 0]]))] == [(0, 0, 30.0), (1, 0, 22.5), (2, 1, 17.25)]
    assert [p.region for p in splitting.planes_of(row([17.25, 30, 22.5], "[1, 2]"))] == [1, 0, 0]
    for bad in (row(5), row([30, 1, 22.5, 0, 17.25, 0]), row([30, 0], "3"), row([99, 0]), row([30, 0], regions=[{"zs": [30.0, 30.0]}]), row([30, 0], regions=[{"zs": 30.0}, {"zs": 30.0}])):
        with pytest.raises(ValueError):
            splitting.planes_of(bad)


def test_a_recording_is_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(splitting, "BLOCK", 5)
    pages = _pages(26)  # the last plane lacks a frame
    path = _tiff(tmp_path / "a.tif", pages, header=_header())
    split = splitting.split_movies(spark, path, str(tmp_path / "out"), {0: 100, 1: 101, 2: 102}, at_once=4)
    planes = {r.place: (r.experiment, r.region, r.z, r.frames, r.rows, r.columns) for r in split.planes.collect()}
    assert planes == {0: (100, 0, 30.0, 9, 12, 7), 1: (101, 0, 22.5, 9, 12, 7), 2: (102, 1, 17.25, 8, 12, 7)}
    for place in range(3):
        own = pages[place::3]
        cells = {(r.t, r.r, r.c): r.v for r in splitting.plane_movie(split.frames, place).collect()}
        assert cells == {(t, i, j): float(own[t][i, j]) for t in range(len(own)) for i in range(12) for j in range(7)}
    blocks = spark.read.parquet(str(tmp_path / "out" / "movies")).select("place", "block").distinct().count()
    assert blocks == 6
    with pytest.raises(ValueError):
        splitting.split_movies(spark, path, str(tmp_path / "no"), {0: 1})
    odd = _tiff(tmp_path / "b.tif", [*_pages(3), *_pages(3, rows=11)], header=_header())
    with pytest.raises(ValueError):
        splitting.split_movies(spark, odd, str(tmp_path / "no"))


def test_the_whole_job(spark, tmp_path):
    recording = _tiff(tmp_path / "a.tif", _pages(9), header=_header(3))
    scans = _pages(12, seed=3)
    depths = _tiff(tmp_path / "d.tif", scans, header=_header(4))
    rows = splitting.split_job(spark, recording, depths, str(tmp_path / "out")).orderBy("place").collect()
    assert [(r.place, r.region, r.frames) for r in rows] == [(0, 0, 3), (1, 0, 3), (2, 1, 3)]
    for r in rows:
        image = np.zeros((12, 7))
        for x in spark.read.parquet(r.depth_path).collect():
            image[x.r, x.c] = x.v
        assert np.allclose(image, np.mean(scans[r.place :: 3], axis=0))
    other = _tiff(tmp_path / "e.tif", scans, header=_header(4, depths="[30 0 22.5 0;18 0]", regions=[{"zs": [30.0, 22.5]}, {"zs": 18.0}]))
    with pytest.raises(ValueError):
        splitting.split_job(spark, recording, other, str(tmp_path / "no"))
    field = splitting.full_field_image(spark, depths)
    assert field.where("r = 2 and c = 3").first().v == pytest.approx(np.mean(scans, axis=0)[2, 3])
    short = _tiff(tmp_path / "f.tif", scans[:-1], header=_header(4))
    with pytest.raises(ValueError):
        splitting.full_field_image(spark, short)
