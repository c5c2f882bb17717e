"""Going through traces region by region in one pass.

Rows are sorted by region and frame within tasks, and a task works on all whole regions of an Arrow batch together; only the last region
of a batch waits for the next one. So many short traces cost no call each, and a long one is held as the recording that it is.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _starts(table: pa.Table) -> np.ndarray:
    """First rows of the runs of equal regions."""
    runs = pc.run_end_encode(table.column("roi").combine_chunks())
    ends = runs.run_ends.to_numpy() if isinstance(runs, pa.RunEndEncodedArray) else np.concatenate([c.run_ends.to_numpy() for c in runs.chunks])
    return np.concatenate([[0], ends[:-1]])


def through_regions(trace: DataFrame, rule: Callable[[pa.Table, np.ndarray], pa.Table], schema: str, value: str = "f", more: tuple[str, ...] = (), rows_at_once: int = 1) -> DataFrame:
    """``rule`` gets rows roi, t, f (a double) and ``more`` of whole regions in order and the first row of each, and gives rows of the
    schema. A call gets the regions of so many rows, or of an Arrow batch if that is more."""

    def run(batches):
        held = None
        waiting: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(pa.Table.from_batches([batch]))
            if sum(x.num_rows for x in waiting) < rows_at_once:
                continue
            held = pa.concat_tables([*([] if held is None else [held]), *waiting])
            waiting = []
            last = held.column("roi")[-1]
            # rows are sorted, so it is enough to look where the last region begins if the batch isn't all of it
            if held.column("roi")[0].equals(last):
                continue
            starts = _starts(held)
            yield from rule(held.slice(0, starts[-1]).combine_chunks(), starts[:-1]).to_batches()
            held = held.slice(starts[-1])
        if held is not None or waiting:
            held = pa.concat_tables([*([] if held is None else [held]), *waiting]).combine_chunks()
            yield from rule(held, _starts(held)).to_batches()

    rows = trace.select("roi", "t", F.col(value).cast("double").alias("f"), *more)
    return rows.repartition("roi").sortWithinPartitions("roi", "t").mapInArrow(run, schema)


def values(table: pa.Table) -> np.ndarray:
    """The column f, null as NaN."""
    return table.column("f").to_numpy().astype(float)


def with_columns(table: pa.Table, **columns: np.ndarray) -> pa.Table:
    """Columns roi and t with others; NaN of a float column is null."""
    out = {"roi": table.column("roi"), "t": table.column("t")}
    for name, x in columns.items():
        out[name] = pa.array(x, from_pandas=x.dtype.kind == "f")
    return pa.table(out)
