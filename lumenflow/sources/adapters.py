"""The driver's tables seen as the relations of an imaging session.

Each adapter is one projection of one table, so filters and column choice reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Width of the frame that vectors are laid out on.
WIDTH = 32


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels r, c with a value v for each frame t: one vector per pixel, one component per frame."""
    cells = _table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("t", "v"))
    return cells.select((F.floor(F.col("vec_id") / WIDTH)).cast("int").alias("r"), (F.col("vec_id") % WIDTH).cast("int").alias("c"), "t", F.col("v").cast("double").alias("v"))


def roi_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted rectangles of 3 by 4 pixels, one per supplier."""
    k = F.col("s_suppkey")
    out = _table(spark, sf_dir, "supplier").select(k.cast("int").alias("roi"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("dr"))
    out = out.select("roi", "dr", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("dc"))
    w = 1 + (3 * F.col("dr") + 5 * F.col("dc") + F.col("roi")) % 7
    return out.select("roi", ((7 * F.col("roi")) % 12 + F.col("dr")).alias("r"), ((11 * F.col("roi")) % 26 + F.col("dc")).alias("c"), w.cast("double").alias("w"))


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trace per user: values in order of event."""
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("roi"), at.alias("t"), F.col("value").cast("double").alias("f"))


def shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Motion offsets from -35 to 35, one per order."""
    k = F.col("o_orderkey")
    return _table(spark, sf_dir, "orders").select(k.alias("t"), ((k * 37) % 71 - 35).cast("double").alias("x"), ((k * 53) % 71 - 35).cast("double").alias("y"))


#: The same views for DuckDB.
SQL = f"""
movie AS (SELECT CAST(vec_id // {WIDTH} AS INT) AS r, CAST(vec_id % {WIDTH} AS INT) AS c, CAST(t AS INT) AS t, CAST(embedding[t + 1] AS DOUBLE) AS v
  FROM embeddings, range(64) x(t) WHERE t < len(embedding)),
roi_pixels AS (SELECT CAST(s_suppkey AS INT) AS roi, (7 * s_suppkey) % 12 + dr AS r, (11 * s_suppkey) % 26 + dc AS c, CAST(1 + (3 * dr + 5 * dc + s_suppkey) % 7 AS DOUBLE) AS w
  FROM supplier, range(3) a(dr), range(4) b(dc)),
trace AS (SELECT user_id AS roi, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS t, CAST(value AS DOUBLE) AS f FROM events),
shift AS (SELECT o_orderkey AS t, CAST((o_orderkey * 37) % 71 - 35 AS DOUBLE) AS x, CAST((o_orderkey * 53) % 71 - 35 AS DOUBLE) AS y FROM orders)"""
