"""Geometry in plain expressions: points as two doubles, rings and lines as arrays of (x, y) structs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Radius of the Web Mercator sphere and of the mean earth, metres.
R, EARTH = 6378137.0, 6371008.8


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * R


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * R


def mercator_scale(lat: Column) -> Column:
    """How much longer a length is on the plane than on the ground."""
    return 1.0 / F.cos(F.radians(lat))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH * F.asin(F.least(F.sqrt(a), F.lit(1.0)))


def _sides(points: Column, f) -> Column:
    later = F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))), later, f)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, v: acc + v)


def line_length(points: Column) -> Column:
    return _sides(points, lambda p, q: F.hypot(q["x"] - p["x"], q["y"] - p["y"]))


def ring_area(points: Column) -> Column:
    """Shoelace area of a ring, closed here if its ends differ."""
    closed = F.concat(points, F.slice(points, 1, 1))
    return F.abs(_sides(closed, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])) / 2


def cell(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("int")


def cell_shard(x: Column, y: Column, n: int) -> Column:
    """A cell's shard: neighbours fall apart."""
    return F.abs(x.cast("long") * 92821 + y) % n


def boxes_touch(a: str, b: str) -> Column:
    """Overlap of the boxes xmin, ymin, xmax, ymax of two aliases."""
    c = lambda t, k: F.col(f"{t}.{k}")
    return (c(a, "xmin") <= c(b, "xmax")) & (c(a, "xmax") >= c(b, "xmin")) & (c(a, "ymin") <= c(b, "ymax")) & (c(a, "ymax") >= c(b, "ymin"))
