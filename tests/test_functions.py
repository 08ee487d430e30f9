import math

import pytest
from pyspark.sql import functions as F

from cartolith.functions import geometry as geo
from cartolith.functions import jts
from cartolith.functions import tags as tg
from cartolith.functions import text as tx
from cartolith.functions.zoom import zres
from cartolith.operators import relational as rel
from cartolith.operators import spatial
from cartolith.operators.graph import connected_components
from cartolith.plans.layers import water_type


def one(spark, col, **values):
    d = spark.range(1).select(*(F.lit(v).alias(k) if not isinstance(v, dict) else F.create_map(*[F.lit(x) for kv in v.items() for x in kv]).alias(k) for k, v in values.items()) or [F.lit(1).alias("one")])
    return d.select(col).first()[0]


def test_text(spark):
    assert one(spark, tx.name_of(F.lit(""), F.lit(" b "))) == " b " and one(spark, tx.name_of(F.lit("  "), F.lit(" b "), trim=True)) == "b"
    assert one(spark, tx.similarity(F.lit("siding"), F.lit("siting"))) == pytest.approx(0.4)
    assert one(spark, tx.similarity(F.lit(None).cast("string"), F.lit("x"))) is None and one(spark, tx.similarity(F.lit("-"), F.lit(""))) == 0
    assert [one(spark, tx.to_int(F.lit(v))) for v in (2.5, 3.5, -2.5)] == [2, 4, -2]
    assert one(spark, water_type(F.lit(""))) == "water" and one(spark, water_type(F.lit("lake;pond"))) == "lake" and one(spark, water_type(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "key,value,tags,state,subject",
    [
        ("abandoned:railway", "rail", {"a": "b"}, "abandoned", "rail"), ("railway", "construction", {"construction": "tram"}, "construction", "tram"), ("railway", " Ruins", {"a": "b"}, "abandoned", "unknown"),
        ("railway", "rail", {"disused:railway": "rail"}, "disused", "rail"), ("railway", "rail", {"razed": "yes"}, "razed", "rail"), ("railway", "rail", {"disused": "no"}, "intact", "rail"),
        ("railway", "disused", {"disused": "yes", "disused:railway": "light_rail"}, "disused", "light_rail"), ("railway", "rail", {"construction": "minor"}, "intact", "rail"),
    ],
)
def test_lifecycle(spark, key, value, tags, state, subject):
    args = (F.col("k"), F.col("v"), F.col("t"), "railway")
    assert one(spark, tg.lifecycle_type(*args), k=key, v=value, t=tags) == state
    assert one(spark, tg.lifecycle_subject(*args, F.lit("unknown")), k=key, v=value, t=tags) == subject


def test_geometry(spark):
    jts.register(spark)
    sq = jts.from_wkt(F.lit("POLYGON((0 0,1 0,1 1,0 1,0 0))"))
    assert one(spark, jts.area(sq)) == 1
    quad = 6371008.8**2 * math.radians(1) * math.sin(math.radians(1))
    assert one(spark, jts.area_sphere(sq)) == pytest.approx(quad, rel=1e-3)
    assert one(spark, jts.area_spheroid(sq)) == pytest.approx(12308778361.0, rel=1e-3)
    assert one(spark, jts.area_mercator(sq)) == pytest.approx(111319.4908**2 * 1.00005, rel=1e-4)
    assert one(spark, geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))) == pytest.approx(111195.08, rel=1e-5)
    assert one(spark, geo.mercator_x(F.lit(180.0))) == pytest.approx(20037508.34, abs=0.01)
    assert one(spark, jts.distance(jts.from_3857(jts.to_3857(jts.point(10.0, 50.0))), jts.point(10.0, 50.0))) < 1e-9
    parts = one(spark, F.transform(jts.subdivide(jts.buffer(jts.point(0.0, 0.0), 1.0, 64), 32), lambda g: F.call_function("ct_npoints", g)))
    assert len(parts) > 4 and max(parts) <= 32
    pts = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 3.0))))
    assert one(spark, geo.line_length(pts)) == 7 and one(spark, geo.ring_area(pts)) == 6
    assert zres(13) == pytest.approx(19.1092570712941)


def test_spatial_joins(spark):
    box = lambda i: (i, float(i), 0.0, i + 1.0, 1.0)
    d = spark.createDataFrame([box(i) for i in range(0, 12, 3)] + [(100, 0.0, 0.0, 11.0, 11.0)], "id int, xmin double, ymin double, xmax double, ymax double")
    pairs = sorted((r[0], r[1]) for r in spatial.grid_join(d, d, 2.5, F.col("a.id") < F.col("b.id")).select("a.id", "b.id").collect())
    assert pairs == [(i, 100) for i in range(0, 12, 3)]
    far = spark.createDataFrame([(1, 20.0, 0.0, 20.0, 0.0)], d.schema)
    assert sorted(r["id"] for r in spatial.grid_join(d, far, 2.5, grow=10.0, how="left_semi").collect()) == [9, 100]
    assert sorted(r["id"] for r in spatial.grid_join(d, far, 2.5, grow=10.0, how="left_anti").collect()) == [0, 3, 6]
    with pytest.raises(ValueError):
        spatial.grid_join(d, d, 1.0, how="full")


def test_relational(spark):
    d = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (None, "y")], "k int, v string")
    assert sorted(r["v"] for r in rel.distinct_on(d, ["k"], [F.col("v")]).collect()) == ["a", "y"]
    with pytest.raises(ValueError):
        rel.assert_unique(d, ["k"])
    assert rel.assert_unique(d, ["v"]) is d
    nodes = spark.createDataFrame([(i,) for i in range(40)], "id bigint")
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 30) if i != 14], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in connected_components(nodes, edges).collect()}
    assert got == {i: 0 if i < 15 else 15 if i < 31 else i for i in range(40)}


def test_mercator_beyond_the_poles(spark):
    """No image beyond a pole, as the formula says, rather than an area of nothing; at the pole it is held just off it."""
    jts.register(spark)
    box = lambda y: jts.from_wkt(F.lit(f"POLYGON((0 {y},1 {y},1 {y + 0.4},0 {y + 0.4},0 {y}))"))
    assert all(math.isnan(one(spark, jts.area_mercator(box(y)))) for y in (89.8, 90.5, -91.0, 200.0))
    assert one(spark, jts.area_mercator(box(360.0))) == pytest.approx(one(spark, jts.area_mercator(box(0.0))))
    assert 0 < one(spark, jts.area_mercator(box(-90.0))) < 1e15 and 0 < one(spark, jts.area_mercator(box(89.6))) < 1e15


def test_inscribed_circle_of_a_rectangle(spark):
    """The middle, without a search whose answer is near it."""
    jts.register(spark)
    box = jts.from_wkt(F.lit("POLYGON((1 2,8.3 2,8.3 3.7,1 3.7,1 2))"))
    assert one(spark, jts.wkt(jts.inscribed_circle(box))) == "POINT (4.65 2.85)"
    assert one(spark, jts.distance(jts.inscribed_circle(jts.from_wkt(F.lit("POLYGON((0 0,4 0,2 4,0 0))"))), jts.point(2.0, 1.236068))) < 0.02


def test_rectangles_by_their_corners(spark):
    """A rectangle is rounded and kept as the overlay and the search would, whose results a fifth vertex on a side asks for."""
    jts.register(spark)
    plain = jts.from_wkt(F.lit("POLYGON((1.23456789 2,1.3 2,1.3 2.7654321,1.23456789 2.7654321,1.23456789 2))"))
    more = jts.from_wkt(F.lit("POLYGON((1.23456789 2,1.25 2,1.3 2,1.3 2.7654321,1.23456789 2.7654321,1.23456789 2))"))
    for f in (jts.reduce_precision, jts.simplify):
        assert one(spark, jts.bbox(f(plain, 0.001))) == one(spark, jts.bbox(f(more, 0.001))) and one(spark, jts.area(f(plain, 0.001))) == pytest.approx(one(spark, jts.area(f(more, 0.001))))
    flat = jts.from_wkt(F.lit("POLYGON((1 2,1.3 2,1.3 2.0001,1 2.0001,1 2))"))
    assert one(spark, jts.is_empty(jts.reduce_precision(flat, 0.001))) and one(spark, jts.npoints(jts.simplify(flat, 0.001))) < 5
    assert one(spark, jts.npoints(jts.simplify(flat, 0.00001))) == 5
