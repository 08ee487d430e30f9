"""Simplification along shared borders, and repair of polygons by linework."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartolith.functions import jts
from cartolith.operators import borders
from cartolith.tiles import mvt

c = F.col


def wiggly(p, q, seed, most=0.015):
    """A line from p to q with bends that depend on the border alone, not on its direction."""
    (a, b), flip = sorted((p, q)), p > q
    rnd, n = random.Random(f"{a}{b}{seed}"), round(24 * math.dist(p, q))
    out = [a] + [(a[0] + (b[0] - a[0]) * k / n + rnd.uniform(-most, most), a[1] + (b[1] - a[1]) * k / n + rnd.uniform(-most, most)) for k in range(1, n)] + [b]
    return out[::-1] if flip else out


def polygon(*rings):
    return "POLYGON(" + ",".join("(" + ",".join(f"{x} {y}" for x, y in r) + ")" for r in rings) + ")"


def ring(corners, seed):
    out = []
    for p, q in zip(corners, corners[1:] + corners[:1]):
        out += wiggly(p, q, seed)[:-1]
    at = len(out) * 3 // 7 + len(out) % 5  # a ring may start anywhere
    out = out[at:] + out[:at]
    return out + out[:1]


def mosaic():
    """Cells of a wiggly grid, one of which has an island in its hole, and a cell of two parts."""
    rows = []
    for x in range(6):
        for y in range(5):
            corners = [(float(x), float(y)), (x + 1.0, float(y)), (x + 1.0, y + 1.0), (float(x), y + 1.0)]
            outer = ring(corners if (x + y) % 2 else corners[::-1], 1)
            if (x, y) == (2, 2):
                island = ring([(2.3, 2.3), (2.7, 2.3), (2.7, 2.7), (2.3, 2.7)], 2)
                rows += [(x * 10 + y, polygon(outer, island)), (999, polygon(island[::-1]))]
            else:
                rows.append((x * 10 + y, polygon(outer)))
    return rows


def test_neighbours_stay_neighbours(spark):
    jts.register(spark)
    df = spark.createDataFrame(mosaic(), "id int, w string").withColumn("geometry", jts.from_wkt("w")).repartition(3)
    s = borders.simplify_shared(df, 0.013).select("id", "geometry").cache()
    before, after = df.agg(F.sum(jts.npoints("geometry"))).first()[0], s.agg(F.sum(jts.npoints("geometry"))).first()[0]
    assert s.count() == 31 and after < before * 0.7
    parts = s.agg(F.sum(jts.area("geometry")).alias("sum"), jts.area(jts.union_all(F.collect_list("geometry"))).alias("whole"), F.size(jts.dump_rings(jts.union_all(F.collect_list("geometry")))).alias("rings")).first()
    assert parts["sum"] == pytest.approx(parts["whole"], abs=1e-9) and parts["rings"] == 1  # no overlaps, no gaps
    a, b = s.alias("a"), s.alias("b")
    pairs = a.join(b, c("a.id") < c("b.id")).agg(F.max(jts.area(jts.intersection("a.geometry", "b.geometry")))).first()[0]
    assert pairs < 1e-9
    alone = df.select(jts.simplify("geometry", 0.013).alias("geometry")).agg(F.sum(jts.area("geometry")).alias("sum"), jts.area(jts.union_all(F.collect_list("geometry"))).alias("whole")).first()
    assert abs(alone["sum"] - alone["whole"]) > 1e-6  # each on its own, they do not
    s.unpersist()


def test_what_vanishes_and_what_passes(spark):
    jts.register(spark)
    rows = [(1, "POLYGON((0 0,0.01 0,0.01 0.01,0 0.01,0 0))"), (2, "POINT(1 1)"), (3, "LINESTRING(0 0,1 0.001,2 0)"), (4, "POLYGON EMPTY"), (5, None), (6, "MULTIPOLYGON(((0 0,4 0,4 4,0 4,0 0),(1 1,1.01 1,1.01 1.01,1 1)),((9 9,9.01 9,9.01 9.01,9 9)))")]
    df = spark.createDataFrame(rows, "id int, w string").withColumn("geometry", jts.from_wkt("w"))
    got = {r["id"]: r["w"] for r in borders.simplify_shared(df, 0.1).select("id", jts.wkt("geometry").alias("w")).collect()}
    assert "EMPTY" in got[1] and got[2] == "POINT (1 1)" and got[3].count(",") == 2 and "EMPTY" in got[4] and got[5] is None
    assert got[6].count("(") <= 3 and "9" not in got[6]


def test_tiles_with_shared_borders(spark):
    """At a coarse zoom the polygons of a tile still add up to their whole."""
    jts.register(spark)
    df = spark.createDataFrame([(i, w) for i, w in mosaic()], "id int, w string").withColumn("geometry", jts.from_wkt("w"))
    from test_tiles import decoded, shoelace

    total = {}
    for shared in (False, True):
        t = mvt.tile_layer(df, "m", 3, 6, ["id"], shared_borders=shared).where("z = 4")
        total[shared] = [sum(map(shoelace, x[2])) for r in t.collect() for x in decoded(r["payload"])]
    assert len(total[True]) >= 31 and math.isfinite(sum(total[True]))


@pytest.mark.parametrize(
    ("wkt", "area"),
    [
        ("POLYGON((0 0,4 4,4 0,0 4,0 0))", 8.0),  # bow tie
        ("MULTIPOLYGON(((0 0,4 0,4 4,0 4,0 0)),((0 0,4 0,4 4,0 4,0 0)))", 0.0),  # doubled
        ("MULTIPOLYGON(((0 0,4 0,4 4,0 4,0 0)),((1 1,3 1,3 3,1 3,1 1)))", 12.0),  # nested
        ("MULTIPOLYGON(((0 0,4 0,4 4,0 4,0 0)),((1 1,3 1,3 3,1 3,1 1)),((1.5 1.5,2.5 1.5,2.5 2.5,1.5 2.5,1.5 1.5)))", 13.0),
        ("MULTIPOLYGON(((0 0,4 0,4 4,0 4,0 0)),((2 2,6 2,6 6,2 6,2 2)))", 24.0),  # overlapping: the common part is out
        ("POLYGON((0 0,10 0,10 10,0 10,0 0),(8 8,12 8,12 12,8 12,8 8))", 108.0),  # a hole that sticks out
        ("POLYGON((0 0,2 0,2 2,0 2,0 0,2 0,2 2,0 2,0 0))", 0.0),  # wound twice
        ("POLYGON((0 0,4 0,4 4,0 4,0 0))", 16.0),
    ],
)
def test_linework(spark, wkt, area):
    jts.register(spark)
    r = spark.createDataFrame([(wkt,)], "w string").select(jts.make_valid_linework(jts.from_wkt("w")).alias("g")).select(jts.area("g").alias("a"), jts.is_valid("g").alias("v")).first()
    assert r["a"] == pytest.approx(area) and r["v"]
