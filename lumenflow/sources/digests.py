"""Digests of input files, worked out in tasks over blocks of the files."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a block.
BLOCK = 64 * 2**20


def _system(path: str) -> tuple[fs.FileSystem, str, str]:
    uri = path if "://" in path else f"file://{path.removeprefix('file:')}"
    system, place = fs.FileSystem.from_uri(uri)
    return system, place, uri.removesuffix(place)


def listed(path: str) -> list[tuple[str, str, int]]:
    """name, path and size of a file (its name is empty) or of all files below a folder, hidden ones left out, by name."""
    system, place, head = _system(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.File:
        return [("", path, info.size)]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    below = system.get_file_info(fs.FileSelector(place, recursive=True))
    names = [(i.path.removeprefix(place).lstrip("/"), head + i.path, i.size) for i in below if i.type == fs.FileType.File]
    return sorted(x for x in names if not any(part.startswith((".", "_")) for part in x[0].split("/")))


def digests(spark: SparkSession, paths: dict[str, str], block: int = BLOCK) -> DataFrame:
    """input, path, size and digest of each named input. A file of one block has its MD5; a longer one the MD5 of its blocks' MD5s
    in order, with their number behind it; a folder that of its files' names and digests. Blocks are read in tasks of their own."""
    parts, folders = [], []
    for name, path in paths.items():
        files = listed(path)
        folders.append((name, path, len(files) != 1 or files[0][0] != ""))
        parts += [(name, inner, at, k, offset, min(block, size - offset)) for inner, at, size in files for k, offset in enumerate(range(0, max(size, 1), block))]
    todo = spark.createDataFrame(parts, "input string, file string, at string, k int, offset long, size long").repartition(max(1, min(len(parts), 1000)))

    def run(frames):
        for rows in frames:
            out = []
            for at, offset, size in zip(rows["at"], rows["offset"], rows["size"]):
                system, place, _ = _system(at)
                with system.open_input_file(place) as f:
                    f.seek(offset)
                    out.append(hashlib.md5(f.read(size)).hexdigest())
            yield rows[["input", "file", "k", "size"]].assign(digest=pd.Series(out, index=rows.index))

    blocks = todo.mapInPandas(run, "input string, file string, k int, size long, digest string")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("k", "digest"))), lambda b: b["digest"])
    n = F.count("*")
    files = blocks.groupBy("input", "file").agg(F.sum("size").alias("size"), F.when(n == 1, F.min("digest")).otherwise(F.concat(F.md5(F.array_join(ordered, "")), F.lit("-"), n.cast("string"))).alias("digest"))
    names = spark.createDataFrame(folders, "input string, path string, folder boolean")
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("file", "digest"))), lambda x: F.concat_ws(" ", x["digest"], x["file"])), "\n")
    whole = files.groupBy("input").agg(F.sum("size").alias("size"), lines.alias("lines"), F.min("digest").alias("one"))
    digest = F.when(F.col("folder"), F.md5(F.coalesce("lines", F.lit("")))).otherwise(F.col("one"))
    return names.join(whole, "input", "left").select("input", "path", F.coalesce("size", F.lit(0)).alias("size"), digest.alias("digest"))
