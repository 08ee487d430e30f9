"""The geometry functions over shapes built from all events, each with its closed form in SQL.

Every event has a box ``a`` of w by h degrees, the same box ``b`` moved by sx and sy, a point ``p`` on or in ``a``, a line
``l`` along its diagonal, and a bow tie ``t`` on its corners; so the value of each function is known by arithmetic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jts
from .catalogue import LAT, LON, query

c = F.col
SHAPES = f"""
with s as (select event_id as id, {LON} as x, {LAT} as y, (event_id % 13)::double / 10.0 + 0.3 as w, (event_id % 7)::double / 5.0 + 0.2 as h,
  (event_id % 5)::double / 4.0 as sx, (event_id % 3)::double / 4.0 as sy, (event_id % 3)::double / 2.0 as f from events),
v as (select *, greatest(w - sx, 0.0) * greatest(h - sy, 0.0) as common, greatest(sx - w, 0.0) as gx, greatest(sy - h, 0.0) as gy from s)
"""


def ring(x: Column, y: Column, w: Column, h: Column) -> Column:
    at = lambda i, j: F.concat_ws(" ", (x + i * w).cast("string"), (y + j * h).cast("string"))
    return F.concat(F.lit("POLYGON(("), F.concat_ws(",", at(0, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0)), F.lit("))"))


def plain(polygon: Column) -> Column:
    return F.replace(polygon, F.lit("POLYGON"), F.lit(""))


def i3() -> Column:
    return c("id") % 3


def dealt(e: DataFrame) -> DataFrame:
    """Rows dealt out over all cores: a file of a few MB is one task, and its rows are seconds of geometry."""
    return e.repartition(int(e.sparkSession.conf.get("spark.sql.shuffle.partitions")), "event_id")


def shapes(t) -> DataFrame:
    e = dealt(t("events").select("event_id"))
    jts.register(e.sparkSession)
    i = c("event_id")
    s = e.select(
        i.alias("id"), ((i * 7919 % 36000).cast("double") / 100.0 - 180.0).alias("x"), ((i * 104729 % 17000).cast("double") / 100.0 - 85.0).alias("y"),
        ((i % 13).cast("double") / 10.0 + 0.3).alias("w"), ((i % 7).cast("double") / 5.0 + 0.2).alias("h"), ((i % 5).cast("double") / 4.0).alias("sx"), ((i % 3).cast("double") / 4.0).alias("sy"), ((i % 3).cast("double") / 2.0).alias("f"),
    )
    at = lambda i, j: F.concat_ws(" ", (c("x") + i * c("w")).cast("string"), (c("y") + j * c("h")).cast("string"))
    return s.select(
        "*", jts.from_wkt(ring(c("x"), c("y"), c("w"), c("h"))).alias("a"), jts.from_wkt(ring(c("x") + c("sx"), c("y") + c("sy"), c("w"), c("h"))).alias("b"),
        jts.from_wkt(ring(c("x") + c("w") / 4, c("y") + c("h") / 4, c("w") / 2, c("h") / 2)).alias("inner"), jts.point(c("x") + c("f") * c("w"), c("y") + c("h") / 2).alias("p"),
        jts.from_wkt(F.concat(F.lit("LINESTRING("), at(0, 0), F.lit(","), at(0.5, 0.5), F.lit(","), at(1, 1), F.lit(")"))).alias("l"),
        jts.from_wkt(F.concat(F.lit("POLYGON(("), F.concat_ws(",", at(0, 0), at(1, 1), at(1, 0), at(0, 1), at(0, 0)), F.lit("))"))).alias("t"),
        jts.from_wkt(F.concat(F.lit("LINESTRING("), F.concat_ws(" ", "x", "y"), F.lit(","), F.concat_ws(" ", (c("x") + c("w") / 2).cast("string"), (c("y") + (c("id") % 5).cast("double") / 100.0).cast("string")), F.lit(","), at(1, 0), F.when(c("id") % 2 == 0, F.concat(F.lit(","), at(0, 0))).otherwise(""), F.lit(")"))).alias("bent"),
        jts.from_wkt(F.concat(F.lit("MULTIPOLYGON("), plain(ring(c("x"), c("y"), c("w"), c("h"))), F.lit(","), plain(F.when(c("id") % 2 == 0, ring(c("x"), c("y"), c("w"), c("h"))).otherwise(ring(c("x") + c("w") / 4, c("y") + c("h") / 4, c("w") / 2, c("h") / 2))), F.lit(")"))).alias("twice"),
    ).withColumns({"any": F.when(i3() == 0, c("a")).when(i3() == 1, c("l")).otherwise(c("p")), "fair": F.when(c("id") % 2 == 0, c("a")).otherwise(c("t"))})


def area(g) -> Column:
    return jts.area(g)


def total(gs: Column) -> Column:
    return F.aggregate(F.transform(gs, lambda g: jts.area(g)), F.lit(0.0), lambda acc, x: acc + x)


def box_of(g, k: int) -> Column:
    return F.get(jts.bbox(g), F.lit(k))


R, MEAN, E = 6378137.0, 6371008.8, math.sqrt(0.00669437999014)
MERCATOR = lambda y: f"ln(tan(pi() / 4 + radians({y}) / 2)) * {R}"
BELT = lambda y: f"2 * atan2(tan(radians(w) / 2) * 2 * tan(radians({y}) / 2), 1 + pow(tan(radians({y}) / 2), 2))"
HAV = f"2 * {MEAN} * asin(sqrt(pow(sin(radians(h) / 2), 2) + cos(radians(y)) * cos(radians(y + h)) * pow(sin(radians(w) / 2), 2)))"
#: Length of the meridian from the equator, by the series in the third flattening.
N3 = 0.0016792203863837
MERIDIAN = lambda f: f"(6367449.14582342 * ({f} - {1.5 * N3 - 9 * N3**3 / 16} * sin(2 * {f}) + {15 * N3**2 / 16 - 15 * N3**4 / 32} * sin(4 * {f}) - {35 * N3**3 / 48} * sin(6 * {f}) + {315 * N3**4 / 512} * sin(8 * {f})))"
both = lambda: F.array("a", "b")

#: Name of the query: value in Spark (columns need a session, so they are made when a query runs), value in SQL, decimals.
FORMS: dict[str, tuple] = {
    "area": (lambda: area("a"), "w * h", 6),
    "perimeter": (lambda: jts.perimeter("a"), "2 * (w + h)", 6),
    "length": (lambda: jts.length("l"), "sqrt(w * w + h * h)", 6),
    "area_mercator": (lambda: jts.area_mercator("a") / 1e6, f"radians(w) * {R} * ({MERCATOR('y + h')} - {MERCATOR('y')}) / 1e6", 3),
    "area_sphere": (lambda: jts.area_sphere("a") / 1e6, f"abs({BELT('y + h')} - {BELT('y')}) * {MEAN} * {MEAN} / 1e6", 3),
    "transform_3857": (lambda: box_of(jts.to_3857("a"), 3), MERCATOR("y + h"), 3),
    "transform_back": (lambda: box_of(jts.from_3857(jts.to_3857("a")), 3), "y + h", 7),
    "transform_3395": (lambda: box_of(jts.to_3395("p"), 1), f"{R} * ln(tan(pi() / 4 + radians(y + h / 2) / 2) * pow((1 - {E} * sin(radians(y + h / 2))) / (1 + {E} * sin(radians(y + h / 2))), {E} / 2))", 3),
    "transform_4087": (lambda: box_of(jts.to_4087("p"), 0), f"radians(x + f * w) * {R}", 3),
    "intersection": (lambda: area(jts.intersection("a", "b")), "common", 6),
    "difference": (lambda: area(jts.difference("a", "b")), "w * h - common", 6),
    "union": (lambda: area(jts.union("a", "b")), "2 * w * h - common", 6),
    "union_aggregate": (lambda: area(jts.union_all(both())), "2 * w * h - common", 6),
    "union_grid": (lambda: area(jts.union_grid(F.array(c("a"), jts.from_wkt(ring(c("x") + c("sx") + 0.003, c("y") + c("sy") - 0.004, c("w"), c("h")))), 0.01)), "2 * w * h - common", 6),
    "intersects": (lambda: jts.intersects("a", "b").cast("double"), "(sx < w + 1e-9 and sy < h + 1e-9)::int::double", 0),
    "contains": (lambda: jts.contains("a", "p").cast("double"), "(f = 0.5)::int::double", 0),
    "contains_properly": (lambda: jts.contains_properly("a", "p").cast("double") * 10 + jts.contains("a", jts.intersection("a", "b")).cast("double"), "(f = 0.5)::int::double * 10 + (sx < w - 1e-9 and sy < h - 1e-9)::int::double", 0),
    "overlaps": (lambda: jts.overlaps("a", "b").cast("double"), "(sx < w - 1e-9 and sy < h - 1e-9 and sx + sy > 0)::int::double", 0),
    "distance": (lambda: jts.distance("a", "b"), "sqrt(gx * gx + gy * gy)", 6),
    "dwithin": (lambda: jts.dwithin("a", "b", 0.31).cast("double"), "(sqrt(gx * gx + gy * gy) <= 0.31)::int::double", 0),
    "distance_metres": (lambda: jts.distance_metres(jts.point(c("x"), c("y")), jts.point(c("x") + c("w"), c("y") + c("h"))), HAV, 2),
    "dwithin_metres": (lambda: jts.dwithin_metres(jts.point(c("x"), c("y")), jts.point(c("x") + c("w"), c("y") + c("h")), 100_000.0).cast("double"), f"({HAV} <= 100000.0)::int::double", 0),
    "distance_spheroid": (lambda: jts.distance_spheroid(jts.point(c("x"), F.lit(0.0)), jts.point(c("x") + c("w"), F.lit(0.0))) + jts.distance_spheroid(jts.point(c("x"), c("y")), jts.point(c("x"), c("y") + c("h"))), f"radians(w) * 6378137.0 + {MERIDIAN('radians(y + h)')} - {MERIDIAN('radians(y)')}", 2),
    "length_spheroid": (lambda: jts.length_spheroid(jts.from_wkt(F.concat(F.lit("LINESTRING("), F.concat_ws(" ", "x", "y"), F.lit(","), F.concat_ws(" ", c("x").cast("string"), (c("y") + c("h")).cast("string")), F.lit(")")))), f"{MERIDIAN('radians(y + h)')} - {MERIDIAN('radians(y)')}", 2),
    "dwithin_spheroid": (lambda: jts.dwithin_spheroid(jts.point(c("x"), c("y")), jts.point(c("x"), c("y") + c("h")), 100_000.0).cast("double"), f"({MERIDIAN('radians(y + h)')} - {MERIDIAN('radians(y)')} <= 100000.0)::int::double", 0),
    "area_spheroid": (lambda: jts.area_spheroid(jts.from_wkt(F.concat(F.lit("POLYGON(("), F.concat_ws(" ", "x", F.lit("0")), F.lit(","), F.concat_ws(" ", (c("x") + c("w")).cast("string"), F.lit("0")), F.lit(","), F.concat_ws(" ", "x", F.lit("90")), F.lit(","), F.concat_ws(" ", "x", F.lit("0")), F.lit("))")))) / 1e6, "radians(w) * 6371007.1809 * 6371007.1809 / 1e6", 0),
    "buffer": (lambda: area(jts.buffer("p", 0.5, 4)), "2 * sin(pi() / 8)", 6),
    "buffer_metres": (lambda: area(jts.to_3857(jts.buffer_metres(jts.point(0.0, c("y")), 20.0))) * F.pow(F.cos(F.radians("y")), 2), "400 * 16 * sin(pi() / 16)", 3),
    "expand": (lambda: area(jts.expand("a", 0.1)), "(w + 0.2) * (h + 0.2)", 6),
    "envelope": (lambda: box_of("a", 2) - box_of("a", 0) + box_of("a", 3) - box_of("a", 1), "w + h", 6),
    "centroid": (lambda: box_of(jts.centroid("a"), 0), "x + w / 2", 6),
    "point_on_surface": (lambda: box_of(jts.point_on_surface("a"), 0) - c("x") + (box_of(jts.point_on_surface("a"), 1) - c("y")) * 10, "w / 2 + h * 5", 6),
    "inscribed_circle": (lambda: jts.distance(jts.inscribed_circle("a"), jts.from_wkt(F.replace(F.replace(jts.wkt("a"), F.lit("POLYGON (("), F.lit("LINESTRING (")), F.lit("))"), F.lit(")")))), "least(w, h) / 2", 2),
    "make_valid": (lambda: area(jts.make_valid("fair")), "case when id % 2 = 0 then w * h else w * h / 2 end", 6),
    "make_valid_linework": (lambda: area(jts.make_valid_linework("fair")) + 10 * area(jts.make_valid_linework("twice")), "case when id % 2 = 0 then w * h else w * h / 2 + 10 * w * h * 0.75 end", 6),
    "is_valid": (lambda: jts.is_valid("fair").cast("double"), "(id % 2 = 0)::int::double", 0),
    "is_empty": (lambda: jts.is_empty(jts.intersection("a", "b")).cast("double"), "(sx > w + 1e-9 or sy > h + 1e-9)::int::double", 0),
    "is_closed": (lambda: jts.is_closed("bent").cast("double"), "(id % 2 = 0)::int::double", 0),
    "dimension": (lambda: jts.dimension("any").cast("double"), "(2 - id % 3)::double", 0),
    "npoints": (lambda: jts.npoints("any").cast("double"), "(5 - id % 3 * 2)::double", 0),
    "geometry_type": (lambda: F.length(jts.type_of("any")).cast("double"), "case id % 3 when 0 then 7.0 when 1 then 10.0 else 5.0 end", 0),
    "dump": (lambda: F.size(jts.dump(jts.union("a", "b"))).cast("double"), "case when (sx < w + 1e-9 and sy < h - 1e-9) or (sx < w - 1e-9 and sy < h + 1e-9) then 1.0 else 2.0 end", 0),
    "dump_points": (lambda: F.size(jts.dump_points("any")).cast("double"), "(5 - id % 3 * 2)::double", 0),
    "dump_rings": (lambda: total(jts.dump_rings(jts.difference("a", "inner"))), "w * h * 1.25", 6),
    "exterior_ring": (lambda: area(jts.exterior(jts.difference("a", "inner"))), "w * h", 6),
    "make_polygon": (lambda: area(jts.polygon("a", F.array("inner"))), "w * h * 0.75", 6),
    "collection_extract": (lambda: area(jts.polygons(jts.union("a", "l"))), "w * h", 6),
    "simplify": (lambda: jts.npoints(jts.simplify(F.when(c("id") % 2 == 1, c("bent")), 0.025)).cast("double"), "case when id % 2 = 1 then case when id % 5 >= 3 then 3.0 else 2.0 end end", 0),
    "simplify_vw": (lambda: jts.npoints(jts.simplify_vw(F.when(c("id") % 2 == 1, c("bent")), 0.0101)).cast("double"), "case when id % 2 = 1 then case when w * (id % 5)::double / 200.0 > 0.0101 then 3.0 else 2.0 end end", 0),
    "reduce_precision": (lambda: box_of(jts.reduce_precision("p", 0.5), 1), "floor((y + h / 2) * 2 + 0.5) / 2", 6),
    "line_interpolate_point": (lambda: box_of(jts.interpolate("l", 0.25), 0), "x + w / 4", 6),
    "segmentize": (lambda: F.when(jts.npoints(jts.segmentize_metres("l", 500.0)) >= jts.length("l") * 111195.0 / 500.0, jts.length(jts.segmentize_metres("l", 500.0))), "sqrt(w * w + h * h)", 6),
    "subdivide": (lambda: total(jts.subdivide(jts.buffer("p", 0.5, 16), 32)), "32 * 0.25 * sin(2 * pi() / 64)", 6),
}


def _put(name: str, value, sql: str, digits: int) -> None:
    def f(t) -> DataFrame:
        return shapes(t).select("id", (F.round(value(), digits) + 0.0).alias("value"))

    query(f"{SHAPES} select id, round(({sql})::double, {digits}) + 0.0 as value from v", f"jts_{name}")(f)


for _name, _form in FORMS.items():
    _put(_name, *_form)
