"""Unions of many geometries, in bounded tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jts
from ..functions.curves import cell_of, hilbert
from .graph import cut
from .relational import numbered
from .spatial import index

#: Geometries that one union takes.
FANOUT = 32
#: Order of the curve along which neighbours are united first.
ORDER = 16

c = F.col


def _union(grid: float | None) -> Column:
    parts = F.collect_list("geometry")
    return jts.union_all(parts) if grid is None else jts.union_grid(parts, grid)


def union_tree(df: DataFrame, keys: list[str], grid: float | None = None, fanout: int = FANOUT) -> DataFrame:
    """(keys, geometry) -> one row per distinct keys, null ones included, with the union of its geometries.

    A tree along the Hilbert curve: all rows are numbered by keys and curve, each run of ``fanout`` is united, borders inside
    it vanish, and the results are the next round's rows.  So a task never holds more than ``fanout`` geometries of
    a group, however many it has and however crowded they lie, and only outlines move up.  Groups with one result
    left leave; rounds grow with the logarithm of the largest group and are written.  ``grid`` snaps to a grid.
    """
    x = jts.with_box(df.select(*keys, "geometry").where(c("geometry").isNotNull() & ~jts.is_empty("geometry")))
    x = x.select(*keys, "geometry", ((c("xmin") + c("xmax")) / 2).alias("__x"), ((c("ymin") + c("ymax")) / 2).alias("__y"))
    x = cut(x, "parts")
    x0, y0, x1, y1 = x.agg(F.min("__x"), F.min("__y"), F.max("__x"), F.max("__y")).first()
    if x0 is None:
        return x.select(*keys, "geometry")
    span = F.lit(max(x1 - x0, y1 - y0) or 1.0)
    at = hilbert(cell_of(c("__x"), F.lit(x0), span, ORDER), cell_of(c("__y"), F.lit(y0), span, ORDER), ORDER)
    x = numbered(x.withColumn("__d", at), [*map(c, keys), c("__d")], "__rn").drop("__x", "__y", "__d")
    ends = x.groupBy(*keys).agg(F.min("__rn").alias("__first"), F.max("__rn").alias("__last"))
    same = reduce(lambda p, q: p & q, (c(f"p.{k}").eqNullSafe(c(f"q.{k}")) for k in keys), F.lit(True))
    x = x.alias("p").join(ends.alias("q"), same).select(*(f"p.{k}" for k in keys), "geometry", "__rn", "__first", "__last")
    done, more = [], True
    while more:
        x = x.withColumns({k: F.floor(c(k) / fanout) for k in ("__rn", "__first", "__last")})
        x = cut(x.groupBy(*keys, "__rn", "__first", "__last").agg(_union(grid).alias("geometry")), "united")
        done.append(x.where("__first = __last").select(*keys, "geometry"))
        x = x.where("__first < __last")
        more = x.limit(1).count() > 0
    return reduce(DataFrame.unionByName, done)


def in_cells(df: DataFrame, size: float, vertices: int = 1024) -> DataFrame:
    """The geometries cut along the lines of a grid: a row for each cell (cx, cy) that one reaches into, with what lies in it.
    Large ones are halved first, so that no cut sees more than ``vertices`` points."""
    x = df.withColumn("geometry", F.explode(F.when(jts.npoints("geometry") > vertices, jts.subdivide("geometry", vertices)).otherwise(F.array("geometry"))))
    level = F.lit(0)
    cells = lambda lo, hi: F.sequence(index(c(lo) / size, level), index(c(hi) / size, level))
    x = jts.with_box(x).withColumn("cx", F.explode(cells("xmin", "xmax"))).withColumn("cy", F.explode(cells("ymin", "ymax")))
    box = F.array(c("cx") * size, c("cy") * size, (c("cx") + 1) * size, (c("cy") + 1) * size)
    part = F.filter(F.array(jts.clip("geometry", box)), lambda g: g.isNotNull() & ~jts.is_empty(g))  # exploded, else each later filter would cut again
    return x.withColumn("geometry", F.explode(part)).drop("xmin", "ymin", "xmax", "ymax")
