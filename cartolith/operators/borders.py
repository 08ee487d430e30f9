"""Simplification of polygons that share borders, without gaps or overlaps between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jts
from .graph import cut

c = F.col


def with_junctions(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Adds __junctions: x and y, in turn, of the vertices of each geometry at which its borders part ways.

    A vertex is a junction if not all rings that pass it, of any row, have the same two neighbours there.  Vertices meet in
    one exchange, of which only the least and greatest pair of neighbours is kept, so a pole of many rings is one row;
    junctions go back to their rows.  Borders are taken as shared where they have the same vertices.
    """
    x = cut(df.withColumn("__id", F.monotonically_increasing_id()), "borders")
    v = x.select("__id", F.explode(jts.ring_vertices(geometry)).alias("v"))
    at = lambda i: F.get("v", F.lit(i))
    end = lambda i: F.struct(at(i).alias("x"), at(i + 1).alias("y"))
    v = v.select("__id", at(0).alias("x"), at(1).alias("y"), F.struct(F.least(end(2), end(4)).alias("p"), F.greatest(end(2), end(4)).alias("q")).alias("beside"))
    parting = v.groupBy("x", "y").agg(F.min("beside").alias("lo"), F.max("beside").alias("hi")).where("lo <> hi").select("x", "y")
    own = v.select("__id", "x", "y").distinct().join(parting, ["x", "y"]).groupBy("__id").agg(F.flatten(F.collect_list(F.array("x", "y"))).alias("__junctions"))
    none = F.array().cast("array<double>")
    return x.join(own, "__id", "left").withColumn("__junctions", F.coalesce("__junctions", none)).drop("__id")


def simplify_shared(df: DataFrame, tolerance: Column | float, geometry: str = "geometry") -> DataFrame:
    """The rows with their polygons simplified: rings are cut into arcs at junctions, and each arc is simplified from its ends in
    a direction of its own, so all polygons along it get the same line.  Rings without junctions start at their least
    vertex.  Parts that vanish leave an empty geometry; points and lines pass."""
    x = with_junctions(df, geometry)
    return x.withColumn(geometry, jts.simplify_arcs(geometry, "__junctions", tolerance)).drop("__junctions")
