"""Taking the sine warp out of a resonant scan: outer columns are mixed from columns further inside.

Each output column is a weighted sum of at most three input columns, so the warp is a small table that is broadcast to the
movie; the only shuffle of the movie is that of the sums.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.operators.traces import if_small
from lumenflow.sources import movies as files

#: The circle's half as the warp was calibrated with, and the brightest value.
HALF_TURN, BRIGHTEST = 3.14159265, 65_535
#: Every so many frames count for the deviation.
EVERY = 8
_WARP = "c int, out int, weight double, scale double, noise double, level double, mixed boolean"


def places(reach: float, strength: float, size: int = 256) -> tuple[list[int], list[float]]:
    """For each column from the edge the column further out that its light came from, and the same for the border behind it; 0
    beyond ``reach`` columns."""
    bend = lambda j: strength * (1.0 - math.sin((j / (reach * 3.0) + 1.0 / 6.0) * HALF_TURN))
    inside = range(min(int(reach), size))
    blank = [0] * (size - len(inside))
    return [j - int(bend(j) + 0.5) for j in inside] + blank, [j + 0.5 - bend(j + 0.5) for j in inside] + [float(b) for b in blank]


def _first_seen(column: list[int], border: list[float]) -> int:
    return next(j for j, (x, b) in enumerate(zip(column, border)) if x >= 0 and b >= 0)


def margins(left: tuple[float, float], right: tuple[float, float], width: int = 512) -> tuple[int, int]:
    """Columns at both sides that no light came from."""
    return tuple(_first_seen(*places(*side, width // 2)) for side in (left, right))


def warp_table(left: tuple[float, float], right: tuple[float, float], noise: int = 0, width: int = 512) -> list[tuple]:
    """Rows c, out, weight, scale, noise, level, mixed: column ``out`` is the sum of weight times column c, times scale, less
    ``noise`` times the row's deviation, plus ``level`` times the row's mean level; if mixed, it is kept within 0 and the
    brightest value.

    ``left`` and ``right`` are reach and strength of the warp. Noise modes: 1 takes off two deviations for each column more than
    one that was mixed, 2 one of them and divides by the number mixed, 3 only divides, others do nothing; without one the
    columns before the first mixed ones are brightened like these.
    """
    out = [(c, c, 1.0, 1.0, 0.0, 0.0, False) for c in range(int(left[0]), width - int(right[0]))]
    for (reach, strength), at in ((left, lambda j: j), (right, lambda j: width - 1 - j)):
        column, border = places(reach, strength, width // 2)
        seen = _first_seen(column, border)
        gain = 1.0 if noise else border[seen + 1] - border[seen]
        for j in range(int(reach)):
            # the border in front of the first column is the table's last entry
            lo, hi = border[j - 1], border[j]
            if column[j] < 0:
                out.append((at(j), at(j), 0.0, 1.0, 0.0, gain, False))
            elif lo < 0:
                out.append((at(column[j]), at(j), gain, 1.0, 0.0, 0.0, False))
            else:
                s, e, n = math.floor(lo), math.floor(hi), hi - lo
                scale = 1 / n if noise in (2, 3) else 1.0
                less = (n - 1) * {1: 2.0, 2: 1.0}.get(noise, 0.0)
                parts = [(s, s + 1 - lo), (e, hi - e)] + ([(s + 1, 1.0)] if e - s > 1 else [])
                out += [(at(c), at(j), weight, scale, less, 0.0, True) for c, weight in parts]
    return out


def row_levels(movie: DataFrame) -> DataFrame:
    """r, level, deviation: the commonest whole mean and deviation (over every 8th frame) of a column of pixels, for the row of the
    column's number; rows beyond the last column start over. Frames are square as a rule."""
    figures = movie.groupBy("r", "c").agg(F.avg("v").cast("long").alias("level"), F.stddev_pop(F.when(F.col("t") % EVERY == 0, F.col("v"))).cast("long").alias("deviation"))
    columns = figures.groupBy("c").agg(F.mode("level", True).alias("level"), F.mode("deviation", True).alias("deviation"))
    width = figures.agg((F.max("c") + 1).alias("columns"))
    rows = figures.select("r").distinct().join(F.broadcast(width)).withColumn("c", F.col("r") % F.col("columns"))
    return rows.join(columns, "c").select("r", "level", "deviation")


def dewarped(movie: DataFrame, left: tuple[float, float], right: tuple[float, float], noise: int = 0, width: int = 512, full: bool = False) -> DataFrame:
    """r, c, t, v of the movie without the warp, whole numbers, without the columns that no light came from unless ``full``. Missing
    pixels count as 0, but a pixel is made only if one that it comes from is there."""
    table = F.broadcast(movie.sparkSession.createDataFrame(warp_table(left, right, noise, width), _WARP))
    same = lambda name: F.first(name).alias(name)
    mixed = movie.select("r", "c", "t", "v").join(table, "c").groupBy("t", "r", "out").agg(F.sum(F.col("weight") * F.col("v")).alias("v"), *map(same, ("scale", "noise", "level", "mixed")))
    levels = row_levels(movie).withColumnRenamed("level", "mean_level")
    value = F.col("v") * F.col("scale") - F.col("noise") * F.col("deviation") + F.col("level") * F.col("mean_level")
    held = F.when(F.col("mixed"), F.least(F.greatest(value, F.lit(0.0)), F.lit(float(BRIGHTEST)))).otherwise(value)
    # sums depend on their order in the last digits, which the cut to whole numbers must not see
    whole = F.floor(F.round(held, 9)).cast("int")
    low, high = (0, 0) if full else margins(left, right, width)
    inside = (F.col("out") >= low) & (F.col("out") < width - high)
    return mixed.where(inside).join(if_small(levels), "r").select("r", (F.col("out") - low).cast("int").alias("c"), "t", whole.alias("v"))


def write_dewarped(movie: DataFrame, path: str, left: tuple[float, float], right: tuple[float, float], noise: int = 0, width: int = 512, full: bool = False) -> None:
    """A dewarped movie as a table of blocks and tiles, with its width and how it was made."""
    low, high = (0, 0) if full else margins(left, right, width)
    out = dewarped(movie, left, right, noise, width, full).withColumn("v", F.col("v").cast("double"))
    files.write_movie(out, path, width=width - low - high, left=list(left), right=list(right), noise=noise)
