"""Space-filling curves as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hilbert(x: Column, y: Column, order: int) -> Column:
    """Position of a cell on the Hilbert curve over 2 ** order by 2 ** order cells, from (0, 0) to (2 ** order - 1, 0)."""
    last = F.lit((1 << order) - 1).cast("long")
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))
    sides = F.array(*(F.lit(1 << k).cast("long") for k in reversed(range(order))))

    def turn(at: Column, s: Column) -> Column:
        right, up = at["x"].bitwiseAND(s) > 0, at["y"].bitwiseAND(s) > 0
        quarter = F.when(right, F.when(up, 2).otherwise(3)).otherwise(F.when(up, 1).otherwise(0))
        flip = lambda v: F.when(right, last - v).otherwise(v)
        return F.struct(F.when(up, at["x"]).otherwise(flip(at["y"])).alias("x"), F.when(up, at["y"]).otherwise(flip(at["x"])).alias("y"), (at["d"] + s * s * quarter).alias("d"))

    return F.aggregate(sides, start, turn, lambda at: at["d"])


def cell_of(v: Column, low: Column, span: Column, order: int) -> Column:
    """Which of 2 ** order cells of a span a coordinate lies in; those outside are put at its ends."""
    n = 1 << order
    return F.least(F.greatest(F.floor((v - low) / span * n), F.lit(0)), F.lit(n - 1)).cast("long")
