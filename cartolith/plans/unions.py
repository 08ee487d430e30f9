"""Space-filling curves and unions of many geometries, each with its closed form in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jts
from ..functions.curves import cell_of, hilbert
from ..operators.borders import simplify_shared
from ..operators.dissolve import in_cells, union_tree
from ..operators.graph import shared_folder
from ..tiles.flatgeobuf import read_flatgeobuf, write_flatgeobuf
from .catalogue import BOX, LAT, LON, boxes, points, query
from .shapes import dealt, ring

c = F.col


def _hilbert_sql(order: int) -> str:
    """One subquery for each bit of the two numbers, from the highest."""
    sql = f"select event_id, least(greatest(floor(({LON} + 180.0) / 360.0 * {1 << order}), 0), {(1 << order) - 1})::bigint as x, least(greatest(floor(({LAT} + 180.0) / 360.0 * {1 << order}), 0), {(1 << order) - 1})::bigint as y, 0::bigint as d from events"
    last = (1 << order) - 1
    for bit in reversed(range(order)):
        s = 1 << bit
        bits = f"select *, (x // {s}) % 2 as rx, (y // {s}) % 2 as ry from ({sql})"
        sql = f"select event_id, case when ry = 1 then x when rx = 1 then {last} - y else y end as x, case when ry = 1 then y when rx = 1 then {last} - x else x end as y, d + {s * s} * (case when rx = 1 and ry = 0 then 3 when rx = 1 then 2 else ry end) as d from ({bits})"
    return f"select event_id, d::bigint as d from ({sql})"


@query(_hilbert_sql(10))
def hilbert_key(t):
    """Where the cell of an event lies on the Hilbert curve over a square of 360 degrees."""
    at = lambda v: cell_of(c(v), F.lit(-180.0), F.lit(360.0), 10)
    return points(t).select("event_id", hilbert(at("lon"), at("lat"), 10).alias("d"))


def _measured(united: DataFrame, key: str) -> DataFrame:
    b = jts.bbox("geometry")
    return united.select(key, F.round(jts.area("geometry"), 6).alias("area"), F.size(jts.dump("geometry")).cast("long").alias("parts"), F.round(F.get(b, F.lit(2)) - F.get(b, F.lit(0)), 6).alias("width"))


@query("select event_id // 2000 as chain, count(*) * 0.125::double as area, 1::bigint as parts, count(*) * 0.5::double as width from events group by 1")
def union_tree_chain(t):
    """Chains of boxes that touch side by side: one component each, whose union is one long box."""
    e = t("events")
    jts.register(e.sparkSession)
    i = c("event_id")
    box = ring((i % 2000).cast("double") * 0.5, F.floor(i / 2000).cast("double") * 2, F.lit(0.5), F.lit(0.25))
    return _measured(union_tree(e.select(F.floor(i / 2000).alias("chain"), jts.from_wkt(box).alias("geometry")), ["chain"]), "chain")


@query("""
with s as (select event_type, (event_id * 7919 % 100003)::double / 4.0 as lo, (event_id * 7919 % 100003)::double / 4.0 + (event_id % 9 + 1)::double as hi from events),
f as (select *, max(hi) over (partition by event_type order by lo, hi rows between unbounded preceding and 1 preceding) as before from s),
g as (select *, sum(case when before >= lo then 0 else 1 end) over (partition by event_type order by lo, hi rows unbounded preceding) as island from f),
i as (select event_type, island, min(lo) as lo, max(hi) as hi from g group by all)
select event_type, round(sum(hi - lo), 6) as area, count(*)::bigint as parts, round(max(hi) - min(lo), 6) as width from i group by event_type""")
def union_tree_islands(t):
    """Boxes of one height along a line, by type: their union is that of intervals."""
    e = t("events")
    jts.register(e.sparkSession)
    i = c("event_id")
    box = ring((i * 7919 % 100003).cast("double") / 4.0, F.lit(0.0), (i % 9 + 1).cast("double"), F.lit(1.0))
    return _measured(union_tree(e.select("event_type", jts.from_wkt(box).alias("geometry")), ["event_type"]), "event_type")


@query(f"""
with b as (select event_id as id, {LON} as x0, {LAT} as y0, {LON} + (event_id % 13)::double / 2.0 + 0.5 as x1, {LAT} + (event_id % 7)::double / 2.0 + 0.5 as y1 from events),
k as (select *, unnest(range(floor(x0 / 2.5)::bigint, floor(x1 / 2.5)::bigint + 1)) as cx from b), j as (select *, unnest(range(floor(y0 / 2.5)::bigint, floor(y1 / 2.5)::bigint + 1)) as cy from k)
select id, cx, cy, round((least(x1, (cx + 1) * 2.5) - greatest(x0, cx * 2.5)) * (least(y1, (cy + 1) * 2.5) - greatest(y0, cy * 2.5)), 6) as area from j
where least(x1, (cx + 1) * 2.5) - greatest(x0, cx * 2.5) > 1e-9 and least(y1, (cy + 1) * 2.5) - greatest(y0, cy * 2.5) > 1e-9""")
def cut_by_cells(t):
    """Boxes cut along the lines of a grid."""
    p = points(lambda name: dealt(t(name).select("event_id")))
    jts.register(p.sparkSession)
    i = c("event_id")
    box = ring(c("lon"), c("lat"), (i % 13).cast("double") / 2.0 + 0.5, (i % 7).cast("double") / 2.0 + 0.5)
    x = in_cells(p.select(i.alias("id"), jts.from_wkt(box).alias("geometry")), 2.5)
    return x.select("id", "cx", "cy", F.round(jts.area("geometry"), 6).alias("area")).where("area > 1e-9")


#: How far the middle of the border under and left of a cell of the mosaic is bent, in hundredths; beyond TOLERANCE it stays.
UNDER, BESIDE, TOLERANCE = "(({x}) * 7 + ({y}) * 13 + 40) % 9 - 4", "(({x}) * 5 + ({y}) * 11 + 30) % 7 - 3", 0.025


@query(f"""
with m as (select event_id as id, event_id % 100 as x, event_id // 100 as y from events),
b as (select id, {UNDER.format(x="x", y="y")} as u, {UNDER.format(x="x", y="y + 1")} as o, {BESIDE.format(x="x", y="y")} as l, {BESIDE.format(x="x + 1", y="y")} as r from m),
k as (select id, case when abs(u) >= 3 then u else 0 end as u, case when abs(o) >= 3 then o else 0 end as o, case when abs(l) >= 3 then l else 0 end as l, case when abs(r) >= 3 then r else 0 end as r from b)
select id, round(1 + (o - u + r - l)::double / 200.0, 6) as area, (5 + (u <> 0)::int + (o <> 0)::int + (l <> 0)::int + (r <> 0)::int)::bigint as vertices from k""")
def mosaic_simplified(t):
    """A mosaic of cells with bent borders: each border is straightened or kept on both its sides alike."""
    e = t("events")
    jts.register(e.sparkSession)
    m = e.select(c("event_id").alias("id"), (c("event_id") % 100).alias("x"), F.floor(c("event_id") / 100).alias("y"))
    bend = lambda rule, x, y: F.expr(f"cast({rule.format(x=x, y=y)} as double) / 100.0")
    at = lambda x, y: F.concat_ws(" ", (c("x") + x).cast("string"), (c("y") + y).cast("string"))
    corners = [at(F.lit(0.0), F.lit(0.0)), at(F.lit(0.5), bend(UNDER, "x", "y")), at(F.lit(1.0), F.lit(0.0)), at(1.0 + bend(BESIDE, "x + 1", "y"), F.lit(0.5)), at(F.lit(1.0), F.lit(1.0)), at(F.lit(0.5), 1.0 + bend(UNDER, "x", "y + 1")), at(F.lit(0.0), F.lit(1.0)), at(bend(BESIDE, "x", "y"), F.lit(0.5)), at(F.lit(0.0), F.lit(0.0))]
    x = m.select("id", jts.from_wkt(F.concat(F.lit("POLYGON(("), F.concat_ws(",", *corners), F.lit("))"))).alias("geometry"))
    x = simplify_shared(x, TOLERANCE)
    return x.select("id", F.round(jts.area("geometry"), 6).alias("area"), jts.npoints("geometry").cast("long").alias("vertices"))


#: What is read back of the written features.
WINDOW = (-30.0, -20.0, 60.0, 45.0)


@query(f"{BOX} select id, round((xmax - xmin) * (ymax - ymin), 6) as area from a where xmin <= {WINDOW[2]} and xmax >= {WINDOW[0]} and ymin <= {WINDOW[3]} and ymax >= {WINDOW[1]}")
def flatgeobuf_by_box(t):
    """Features written to FlatGeobuf files, and those read back that meet a box, by the files' own trees."""
    b = boxes(lambda name: dealt(t(name).select("event_id")))
    spark = b.sparkSession
    jts.register(spark)
    path = f"{shared_folder(spark)}/cartolith-features-{uuid.uuid4().hex}"
    shape = ring(c("xmin"), c("ymin"), c("xmax") - c("xmin"), c("ymax") - c("ymin"))
    write_flatgeobuf(b.select("id", jts.from_wkt(shape).alias("geometry")), path)
    return read_flatgeobuf(spark, path, WINDOW).select("id", F.round(jts.area("geometry"), 6).alias("area"))
