"""Per-frame aggregates over a stream of pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def masked_mean_stream(pixels: DataFrame, rois: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """Mean of each region per second of a pixel stream with event time ``ts``; late rows wait ``delay``."""
    return pixels.withWatermark("ts", delay).join(rois, ["r", "c"]).groupBy(F.window("ts", "1 second"), "roi").agg(F.avg("v").alias("f"))
