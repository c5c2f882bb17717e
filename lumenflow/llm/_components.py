"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm._common import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large: larger neighbours go to the least of the neighbourhood. Small: smaller ones and the node itself do."""
    pairs = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    if large:
        pairs = pairs.unionAll(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = pairs.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        out = joined.select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionAll(least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return out.where("hi <> lo").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge that isn't itself the least of its component."""
    now = materialize(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct())
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = state
        now = materialize(_stars(_stars(now, True), False))
