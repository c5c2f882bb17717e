"""Traces at a lower rate, through a low-pass filter."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The shape of the filter's window, and its half length in periods of the slower rate.
BETA, PERIODS = 5.0, 10


def low_pass(up: int, down: int) -> np.ndarray:
    """A windowed sinc that lets the lower of both rates pass, with gain ``up``."""
    slow = max(up, down)
    half = PERIODS * slow
    x = np.arange(-half, half + 1)
    h = np.sinc(x / slow) / slow * np.kaiser(2 * half + 1, BETA)
    return h / h.sum() * up


def ratio(input_hz: int, output_hz: int) -> tuple[int, int]:
    """Steps up and down in lowest terms."""
    if output_hz > input_hz:
        raise ValueError("the output rate can't exceed the input rate")
    whole = math.gcd(input_hz, output_hz)
    return output_hz // whole, input_hz // whole


def resampled(trace: DataFrame, input_hz: int, output_hz: int) -> DataFrame:
    """roi, t, f at the output rate. Frame k is the sum of the filter's every ``up``-th value times the frames around k * down / up;
    beyond its ends a trace has its median. A trace with gaps has nulls. Frames are in order of t, whatever its numbers.

    A trace is one row of packed frames, so that an output frame finds its input frames without a join.
    """
    up, down = ratio(input_hz, output_hz)
    if up == down:
        return trace.select("roi", "t", F.col("f").cast("double").alias("f"))
    half = PERIODS * max(up, down)
    gap = F.col("f").isNull() | F.isnan("f")
    at = F.struct("t", F.col("f").cast("double").alias("f"))
    packed = trace.groupBy("roi").agg(F.transform(F.sort_array(F.collect_list(at)), lambda s: s["f"]).alias("x"), F.percentile("f", F.lit(0.5)).alias("m"), F.max(gap).alias("gap"))
    table = trace.sparkSession.createDataFrame([(low_pass(up, down).tolist(),)], "h array<double>")  # one row
    wide = packed.join(F.broadcast(table)).withColumn("n", F.size("x"))
    first, last = f"cast(greatest(ceil((k * {down} - {half}) / {up}), 0) as int)", f"cast(least(floor((k * {down} + {half}) / {up}), n - 1) as int)"
    value = f"m + aggregate(sequence({first}, {last}), 0D, (s, i) -> s + h[cast(k * {down} - i * {up} + {half} as int)] * (x[i] - m))"
    frames = F.expr(f"sequence(0, cast(ceil(n * {up} / {down}) as int) - 1)")
    out = wide.select("roi", "x", "m", "gap", "n", "h", F.explode(frames).alias("k"))
    return out.select("roi", F.col("k").cast("long").alias("t"), F.when(~F.col("gap"), F.expr(value)).alias("f"))
