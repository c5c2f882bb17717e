"""Uncompressed TIFF files of a scanner as tables: pages as a Spark data source, and the scanner's own header.

The places of pages are found by following the file's chain of directories once, a few hundred bytes for each page; tasks then
read ranges of ``PAGES_AT_ONCE`` pages. Files are opened through pyarrow's file systems, so a path may be a URI of any store that these know.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGES_AT_ONCE = 500
#: Tags of the format, its number kinds and the mark of the scanner's header.
_ROWS, _COLUMNS, _BITS, _PACKING, _OFFSETS, _SAMPLES, _COUNTS, _FORMAT = 257, 256, 258, 259, 273, 277, 279, 339
_KINDS = {1: "B", 2: "c", 3: "H", 4: "I", 8: "h", 9: "i", 13: "I", 16: "Q", 17: "q", 18: "Q"}
_SCANNER = 117637889
SCHEMA = "path string, page long, rows int, columns int, kind string, pixels binary"


@dataclass(frozen=True)
class Page:
    """Where a page lies: shape, numpy's name of its numbers, and its strips."""

    rows: int
    columns: int
    kind: str
    strips: tuple[tuple[int, int], ...]


def opened(path: str) -> pa.NativeFile:
    system, place = fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    return system.open_input_file(place)


class _File:
    def __init__(self, file: pa.NativeFile, path: str):
        self.file, self.path = file, path
        head = self.at(0, 16)
        self.order = {b"II": "<", b"MM": ">"}.get(head[:2])
        version = struct.unpack(f"{self.order}H", head[2:4])[0] if self.order else 0
        if version not in (42, 43):
            raise ValueError(f"{path} is no TIFF file")
        self.big = version == 43
        (self.first,) = struct.unpack(f"{self.order}Q", head[8:16]) if self.big else struct.unpack(f"{self.order}I", head[4:8])

    def at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def numbers(self, kind: int, count: int, inline: bytes) -> tuple:
        form = f"{self.order}{count}{_KINDS[kind]}"
        size = struct.calcsize(form)
        if size > len(inline):
            (offset,) = struct.unpack(f"{self.order}{'Q' if self.big else 'I'}", inline)
            return struct.unpack(form, self.at(offset, size))
        return struct.unpack(form, inline[:size])

    def pages(self) -> Iterator[Page]:
        entry, wide = (20, 8) if self.big else (12, 4)
        count_form = f"{self.order}{'Q' if self.big else 'H'}"
        offset, seen = self.first, set()
        while offset:
            if offset in seen:
                raise ValueError(f"the directories of {self.path} form a ring")
            seen.add(offset)
            head = struct.calcsize(count_form)
            (n,) = struct.unpack(count_form, self.at(offset, head))
            body = self.at(offset + head, n * entry + wide)
            tags = {}
            for k in range(n):
                part = body[k * entry : (k + 1) * entry]
                tag, kind = struct.unpack(f"{self.order}HH", part[:4])
                (count,) = struct.unpack(f"{self.order}{'Q' if self.big else 'I'}", part[4 : 4 + wide])
                if tag in (_ROWS, _COLUMNS, _BITS, _PACKING, _OFFSETS, _SAMPLES, _COUNTS, _FORMAT):
                    tags[tag] = self.numbers(kind, count, part[4 + wide :])
            if tags.get(_PACKING, (1,))[0] != 1 or tags.get(_SAMPLES, (1,))[0] != 1:
                raise ValueError(f"{self.path} has a page that is packed or has several samples for a pixel")
            letter = {1: "u", 2: "i", 3: "f"}[tags.get(_FORMAT, (1,))[0]]
            yield Page(tags[_ROWS][0], tags[_COLUMNS][0], f"{self.order}{letter}{tags[_BITS][0] // 8}", tuple(zip(tags[_OFFSETS], tags[_COUNTS])))
            (offset,) = struct.unpack(f"{self.order}{'Q' if self.big else 'I'}", body[n * entry :])


def _value(text: str):
    """A value of the scanner's header: a number, a truth, a text in quotes, or a list of these in brackets."""
    text = text.strip()
    if text[:1] in "[{" and text[-1:] in "]}":
        rows = [r for r in text[1:-1].split(";") if r.strip()]
        lists = [[_value(x) for x in re.findall(r"'[^']*'|[^\s,]+", r)] for r in rows]
        return lists if len(lists) > 1 else (lists[0] if lists else [])
    if text[:1] == text[-1:] == "'" and len(text) > 1:
        return text[1:-1]
    if text in ("true", "false"):
        return text == "true"
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def scanner_header(path: str) -> tuple[dict, dict]:
    """The settings and the region groups that the scanner wrote behind the file's first bytes."""
    with opened(path) as file:
        head = _File(file, path)
        if not head.big:
            raise ValueError(f"{path} has no scanner header")
        mark, _, n_settings, n_groups = struct.unpack(f"{head.order}4I", head.at(16, 16))
        if mark != _SCANNER:
            raise ValueError(f"{path} has no scanner header")
        text = head.at(32, n_settings + n_groups)
    lines = text[:n_settings].rstrip(b"\0").decode().splitlines()
    settings = {k.strip(): _value(v) for k, v in (line.split("=", 1) for line in lines if "=" in line)}
    groups = text[n_settings:].rstrip(b"\0").decode()
    return settings, json.loads(groups) if groups else {}


class _Range(InputPartition):
    def __init__(self, path: str, first: int, pages: list[Page]):
        self.path, self.first, self.pages = path, first, pages


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths = json.loads(options["paths"])
        self.step = int(options.get("pages", PAGES_AT_ONCE))

    def partitions(self):
        out = []
        for path in self.paths:
            with opened(path) as file:
                pages = list(_File(file, path).pages())
            out += [_Range(path, lo, pages[lo : lo + self.step]) for lo in range(0, len(pages), self.step)]
        return out or [_Range("", 0, [])]

    def read(self, partition):
        if not partition.pages:
            return
        with opened(partition.path) as file:
            for k, page in enumerate(partition.pages):
                parts = []
                for offset, size in page.strips:
                    file.seek(offset)
                    parts.append(file.read(size))
                yield pa.RecordBatch.from_pydict({"path": [partition.path], "page": pa.array([partition.first + k], pa.int64()), "rows": pa.array([page.rows], pa.int32()), "columns": pa.array([page.columns], pa.int32()), "kind": [page.kind], "pixels": [b"".join(parts)]})


class TiffPages(DataSource):
    """``spark.read.format("tiff_pages")`` with option ``paths``, a JSON list."""

    @classmethod
    def name(cls):
        return "tiff_pages"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def read_pages(spark: SparkSession, paths: list[str], at_once: int = PAGES_AT_ONCE) -> DataFrame:
    """path, page, rows, columns, kind, pixels of all pages, in ranges of pages."""
    spark.dataSource.register(TiffPages)
    return spark.read.format("tiff_pages").option("paths", json.dumps(paths)).option("pages", at_once).load()


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, volumes, slices, channels, depths and regions (JSON) of the files' scanner headers, one row each."""
    rows = []
    for path in paths:
        settings, groups = scanner_header(path)
        depths = settings.get("SI.hStackManager.zsAllActuators", settings.get("SI.hStackManager.zs"))
        regions = groups.get("RoiGroups", {}).get("imagingRoiGroup", {}).get("rois", [])
        whole = {k: settings.get(f"SI.hStackManager.{k}") for k in ("actualNumVolumes", "actualNumSlices")}
        if not all(type(v) is int for v in whole.values()) or depths is None:
            raise ValueError(f"{path} lacks its number of volumes or slices, or its depths")
        rows.append((path, *whole.values(), json.dumps(settings.get("SI.hChannels.channelSave")), json.dumps(depths), json.dumps([regions] if isinstance(regions, dict) else regions)))
    return spark.createDataFrame(rows, "path string, volumes long, slices long, channels string, depths string, regions string")


def pixels(pages: DataFrame) -> DataFrame:
    """The pages with a row for each pixel: r, c, v instead of the packed ones."""
    import numpy as np

    kept = [c for c in pages.columns if c not in ("rows", "columns", "kind", "pixels")]
    fields = ", ".join(f"`{c}` {dict(pages.dtypes)[c]}" for c in kept)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in (*kept, "rows", "columns", "kind", "pixels")}
                image = np.frombuffer(row["pixels"], row["kind"]).astype(float)
                r, c = np.divmod(np.arange(len(image)), row["columns"])
                same = {k: pa.array([row[k]] * len(image), batch.column(k).type) for k in kept}
                yield pa.RecordBatch.from_pydict({**same, "r": pa.array(r, pa.int32()), "c": pa.array(c, pa.int32()), "v": image})

    return pages.mapInArrow(run, f"{fields}, r int, c int, v double")


def write_page_averages(averages: DataFrame, path: str) -> None:
    """Average images (key, r, c, v) as a table with one directory for each key."""
    averages.repartition(F.col("key")).sortWithinPartitions("key", "r", "c").write.partitionBy("key").parquet(path)
