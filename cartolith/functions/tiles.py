"""Tile and bundle arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tiles along a side of a bundle.
SIDE = 128


def tile_x(lon: Column, z: Column | int) -> Column:
    n = F.pow(F.lit(2.0), F.lit(z) if isinstance(z, int) else z)
    return F.least(F.greatest(F.floor((lon + 180.0) / 360.0 * n), F.lit(0)), (n - 1).cast("long")).cast("long")


def tile_y(lat: Column, z: Column | int) -> Column:
    n = F.pow(F.lit(2.0), F.lit(z) if isinstance(z, int) else z)
    r = F.radians(lat)
    return F.least(F.greatest(F.floor((1.0 - F.log(F.tan(r) + 1.0 / F.cos(r)) / math.pi) / 2.0 * n), F.lit(0)), (n - 1).cast("long")).cast("long")


def flip(y: Column, z: Column | int) -> Column:
    """TMS row of an XYZ row and back."""
    return F.pow(F.lit(2.0), F.lit(z) if isinstance(z, int) else z).cast("long") - 1 - y


def bundle_of(c: Column) -> Column:
    return F.floor(c / SIDE).cast("long")


def bundle_slot(row: Column, col: Column) -> Column:
    return (row % SIDE) * SIDE + col % SIDE


def index_entry(offset: Column, size: Column) -> Column:
    """Size above bit 40, offset below."""
    return offset + F.shiftleft(size, 40)
