"""Scalar rules shared by operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def frames_per_bin(input_hz: float, output_hz: float) -> int:
    """Frames merged into one when a recording is slowed down; at least one, halves to even."""
    if output_hz > input_hz:
        raise ValueError("the output rate can't exceed the input rate")
    return max(1, round(input_hz / output_hz))


def odd_frames(rate_hz: float, seconds: float) -> int:
    """The window length in frames, made odd."""
    n = round(rate_hz * seconds)
    return n + 1 - n % 2


def decay_gamma(halflife_s: float, rate_hz: float) -> float:
    """Share of a signal left after one frame."""
    return math.exp(-math.log(2) / (halflife_s * rate_hz))


def noise_multiplier(rate_hz: float) -> float:
    """Event threshold in noise units; known for recordings near 11 and 31 Hz."""
    if round(rate_hz / 11) == 1:
        return 2.6
    if round(rate_hz / 31) == 1:
        return 2.0
    raise ValueError(f"no multiplier is known at {rate_hz} Hz")


def to_range(value: Column, lo: Column, hi: Column, top: int = 255) -> Column:
    """Clipped to lo..hi and scaled to whole numbers up to ``top``; null where lo equals hi."""
    return F.rint((F.least(F.greatest(value, lo), hi) - lo) / F.nullif(hi - lo, F.lit(0.0)) * top)


def unmix(m00: Column, m01: Column, m10: Column, m11: Column, signal: Column, other: Column) -> tuple[Column, Column]:
    """The two sources behind a mixed pair, by the inverse of the mixing matrix."""
    det = F.nullif(m00 * m11 - m01 * m10, F.lit(0.0))
    return (m11 * signal - m01 * other) / det, (m00 * other - m10 * signal) / det
