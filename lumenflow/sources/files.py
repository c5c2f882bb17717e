"""Files of a session as relations, and results as files: JSON, CSV and Parquet through Spark's own readers and writers."""

from __future__ import annotations

import time
import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenflow.operators import rois as rois_
from lumenflow.sources import digests

#: A region record of the extraction and classification steps.
ROI = "id long, x int, y int, width int, height int, valid boolean, mask array<array<boolean>>, mask_page int, exclusion_labels array<string>"
#: Names that a model may not have: they stand for the environments.
PROTECTED = ("dev", "stage", "prod")
REGISTRY = "model_name string, ts long, artifact_location string, run_id string"


def rois(spark: SparkSession, path: str) -> DataFrame:
    """Region records of a JSON file that holds an array of them."""
    return spark.read.schema(ROI).json(path, multiLine=True)


def sparse_rois(spark: SparkSession, path: str) -> DataFrame:
    """Segmentation masks as JSON records of pixel lists: roi, ypix, xpix, lam."""
    return spark.read.schema("roi long, ypix array<int>, xpix array<int>, lam array<double>").json(path, multiLine=True)


def motion(spark: SparkSession, path: str) -> DataFrame:
    """t, x, y of a registration CSV with a header; other columns are left out. Frames are the column ``framenumber``, or
    ``index`` where that is missing."""
    table = spark.read.csv(path, header=True)
    at = "framenumber" if "framenumber" in table.columns else "index"
    return table.select(F.col(at).cast("int").alias("t"), F.col("x").cast("double"), F.col("y").cast("double"))


def traces(spark: SparkSession, path: str) -> DataFrame:
    """roi, t, f of a written trace table."""
    return spark.read.parquet(path)


def first_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """experiment and the first path, by name, of each experiment under a folder that matches the pattern."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path")
    number = F.nullif(F.regexp_extract("path", r"ophys_experiment_(\d+)", 1), F.lit("")).cast("long")
    return found.groupBy(number.alias("experiment")).agg(F.min("path").alias("path"))


def sane(value: Column, kind: T.DataType) -> Column:
    """The column without numbers that JSON lacks: they become _NaN_, _Inf_ and _-Inf_ as text, at any depth."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.when(F.isnan(value), "_NaN_").when(value == float("inf"), "_Inf_").when(value == float("-inf"), "_-Inf_")
        return F.coalesce(text, value.cast("string"))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: sane(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*(sane(value[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: sane(v, kind.valueType))
    return value


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines in which numbers that JSON lacks are text; all numbers of such columns are."""
    df.select(*(sane(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields)).write.json(path)


def write_traces(trace: DataFrame, path: str, buckets: int = 16) -> None:
    """A trace, dF/F, neuropil, demixing or event table: one directory per bucket of regions, frames in order, so that a reader
    of few regions opens few files."""
    bucket = F.pmod(F.xxhash64("roi"), F.lit(buckets)).cast("int")
    trace.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("roi", "t").write.partitionBy("bucket").parquet(path)


def write_events(events: DataFrame, valid: DataFrame, path: str) -> str | None:
    """The event table of valid regions; a warning instead of rows where there is none."""
    write_traces(events.join(valid.select("roi"), "roi", "left_semi"), path)
    return "No valid ROIs in this experiment" if valid.isEmpty() else None


def activated(registry: DataFrame, model: str, environment: str, artifact: str, run_id: str, now: int | None = None) -> DataFrame:
    """The registry's log with a version of the model and the environment pointing at it: rows are only ever added."""
    if model in PROTECTED or environment not in PROTECTED:
        raise ValueError("a model can't be named like an environment, and environments are " + ", ".join(PROTECTED))
    ts = int(time.time()) if now is None else now
    rows = [(model, ts, artifact, run_id), (environment, ts, artifact, run_id)]
    return registry.unionByName(registry.sparkSession.createDataFrame(rows, REGISTRY))


def active_model(registry: DataFrame, environment: str) -> DataFrame:
    """The last row that was activated in an environment."""
    order = Window.partitionBy("model_name").orderBy(F.desc("ts"))
    return registry.where(F.col("model_name") == environment).withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")


def write_masks(pixels: DataFrame, path: str) -> None:
    """Masks of surroundings (roi, r, c) as JSON records: id, box, and mask as rows of flags, cropped to the box."""
    rois_.to_dense(pixels).select(F.col("roi").alias("id"), "x", "y", "width", "height", F.lit(True).alias("valid"), "mask").write.json(path)


def encoded(df: DataFrame, name: str = "json") -> DataFrame:
    """The rows as JSON text in one column, numbers that JSON lacks as text."""
    return df.select(F.to_json(F.struct(*(sane(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields))).alias(name))


def _as_text(kind: T.DataType) -> T.DataType:
    """The type with text in place of fractional numbers, at any depth."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _as_text(kind.valueType))
    return kind


def _as_numbers(value: Column, kind: T.DataType) -> Column:
    """What ``sane`` made text as numbers again."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        named = F.when(value == "_NaN_", "NaN").when(value == "_Inf_", "Infinity").when(value == "_-Inf_", "-Infinity")
        return F.coalesce(named, value).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _as_numbers(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*(_as_numbers(value[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: _as_numbers(v, kind.valueType))
    return value


def decoded(df: DataFrame, schema: str, name: str = "json") -> DataFrame:
    """The rows behind JSON text; numbers may be text there, and those that JSON lacks are named as ``sane`` does."""
    kind = T.StructType.fromDDL(schema)
    read = df.select(F.from_json(F.col(name), _as_text(kind)).alias("row"))
    return read.select(*(_as_numbers(F.col("row")[f.name], f.dataType).alias(f.name) for f in kind.fields))


def segmentation_masks(spark: SparkSession, path: str) -> DataFrame:
    """roi, r, c, w of a segmentation's ``stat.npy``: a pickled list of masks with ypix, xpix and lam, numbered in order. Pickles run code
    as they are read, so the file must be one's own."""
    import io

    import numpy as np
    import pandas as pd

    def run(frames):
        for files in frames:
            for content in files["content"]:
                for k, mask in enumerate(np.load(io.BytesIO(content), allow_pickle=True)):
                    yield pd.DataFrame({"roi": k, "r": mask["ypix"], "c": mask["xpix"], "w": np.asarray(mask["lam"], float)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "roi int, r int, c int, w double")


def image(spark: SparkSession, path: str) -> DataFrame:
    """r, c, v of an image file: the mean of its colours, from Spark's image reader."""
    found = spark.read.format("image").load(path).select("image.*").where("height > 0")
    at = F.posexplode(F.expr("transform(sequence(0, height * width - 1), k -> aggregate(sequence(0, least(nChannels, 3) - 1), 0D, (s, j) -> s + conv(hex(substring(data, k * nChannels + j + 1, 1)), 16, 10)) / least(nChannels, 3))")).alias("k", "v")
    return found.select("width", at).select(F.floor(F.col("k") / F.col("width")).cast("int").alias("r"), (F.col("k") % F.col("width")).cast("int").alias("c"), "v")


def first_existing(folders: list[str], name: str) -> str | None:
    """The path of a file in the first of the folders that has it; None with a warning if none does."""
    for folder in folders:
        path = f"{folder.rstrip('/')}/{name}"
        try:
            digests.listed(path)
            return path
        except FileNotFoundError:
            pass
    warnings.warn(f"{name} is in none of {folders}", stacklevel=2)
    return None
