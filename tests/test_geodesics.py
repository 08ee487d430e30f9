"""Measures on the ellipsoid against published values."""

import pytest

from cartolith.functions import jts


def one(spark, sql_column):
    jts.register(spark)
    return spark.range(1).select(sql_column).first()[0]


def shape(wkt):
    from pyspark.sql import functions as F

    return jts.from_wkt(F.lit(wkt))


@pytest.mark.parametrize(
    ("wkt", "area"),
    [
        # The polygons of the planimeter tests of Karney's library
        ("POLYGON((0 89,90 89,180 89,270 89,0 89))", 24952305678.0),
        ("POLYGON((0 -89,90 -89,180 -89,270 -89,0 -89))", 24952305678.0),
        ("POLYGON((0 -1,1 0,0 1,-1 0,0 -1))", 24619419146.0),
        ("POLYGON((0 90,0 0,90 0,0 90))", 63758202715511.0),
    ],
)
def test_areas(spark, wkt, area):
    assert one(spark, jts.area_spheroid(shape(wkt))) == pytest.approx(area, rel=1e-6)


def test_lengths(spark):
    # An example of the inverse problem of the same library, and the line between Flinders Peak and Buninyong
    assert one(spark, jts.distance_spheroid(shape("POINT(-73.8 40.6)"), shape("POINT(-0.5 51.6)"))) == pytest.approx(5551759.4, rel=1e-8)
    assert one(spark, jts.distance_spheroid(shape("POINT(144.424867888889 -37.9510334166667)"), shape("POINT(143.926495527778 -37.6528211388889)"))) == pytest.approx(54972.271, rel=1e-6)
    assert one(spark, jts.length_spheroid(shape("LINESTRING(0 -1,1 0,0 1,-1 0,0 -1)"))) == pytest.approx(627598.2731, rel=1e-6)
    assert one(spark, jts.distance_spheroid(shape("POINT(179.9 0)"), shape("POINT(-179.9 0)"))) == pytest.approx(0.2 * 111319.490793, rel=1e-6)
    # a line and an area: across a meridian at 60 degrees north
    assert one(spark, jts.distance_spheroid(shape("LINESTRING(10 59,10 61)"), shape("POLYGON((10.1 59.9,11 59.9,11 60.1,10.1 60.1,10.1 59.9))"))) == pytest.approx(5580, rel=0.005)
    assert one(spark, jts.dwithin_spheroid(shape("POINT(0 0)"), shape("POINT(0 1)"), 110574.4)) and not one(spark, jts.dwithin_spheroid(shape("POINT(0 0)"), shape("POINT(0 1)"), 110574.3))


def test_long_edges_cost_little(spark):
    """A quarter of a hemisphere needs few points along its edges, not one every ten kilometres."""
    import time

    from pyspark.sql import functions as F

    jts.register(spark)

    def seconds(top):
        x = spark.range(0, 3000, 1, 1).select(jts.area_spheroid(jts.from_wkt(F.format_string("POLYGON((%1$d 0,%2$d 0,%1$d " + top + ",%1$d 0))", F.col("id") % 90, F.col("id") % 90 + 1))).alias("a"))
        start = time.time()
        assert x.agg(F.min("a")).first()[0] > 0
        return time.time() - start

    seconds("0.01")
    assert seconds("90") < 1 + 3 * seconds("0.01")


def test_areas_of_oblique_edges_add_up(spark):
    """A triangle of edges of thousands of kilometres, against its pieces of a tenth of a degree along the equator."""
    whole = one(spark, jts.area_spheroid(shape("POLYGON((0 0,70 0,20 65,0 0))")))
    parts = "POLYGON((0 0," + ",".join(f"{i / 10} 0" for i in range(1, 701)) + ",20 65,0 0))"
    assert whole == pytest.approx(one(spark, jts.area_spheroid(shape(parts))), rel=1e-10)
