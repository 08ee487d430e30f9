"""Zoom levels: ground resolution and the level from which an area is drawn."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Circumference of the Web Mercator plane in metres.
AROUND = 40075016.6855785
TILE = 256


def zres(z: float) -> float:
    """Metres per pixel at zoom z."""
    return AROUND / (TILE * 2**z)


def zres_of(z: Column) -> Column:
    return F.lit(AROUND) / (F.lit(TILE) * F.pow(F.lit(2.0), z))


def bucket(area: Column, levels: list[tuple[int, float]], other: int) -> Column:
    """The first level (level, zoom) whose squared resolution the area reaches."""
    arms = reduce(lambda w, x: (F if w is None else w).when(area >= zres(x[1]) ** 2, x[0]), levels, None)
    return arms.otherwise(other)
