"""Spatial joins, the antimeridian and nearest neighbours against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartolith.operators import spatial

BOX = "id int, xmin double, ymin double, xmax double, ymax double"
POINT = "id int, x double, y double, kind string"


def mixed_boxes(n, most, seed):
    """From points to 10 ** most wide; some with sides and corners on the borders of cells."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        side, x, y = 0.0 if i % 5 == 0 else 10 ** rnd.uniform(-4, most), rnd.uniform(-180, 180), rnd.uniform(-80, 80)
        if i % 7 == 0:
            x, y, side = float(math.floor(x)), float(math.floor(y)), 2.0 ** rnd.randrange(-3, 4)
        out.append((i, x, y, x + side, y + side * (1 if i % 3 == 0 else rnd.random())))
    return out


def meet(p, q, grow=0.0):
    return p[1] - grow <= q[3] and p[3] + grow >= q[1] and p[2] - grow <= q[4] and p[4] + grow >= q[2]


def pairs(df):
    return sorted(tuple(r) for r in df.select("a.id", "b.id").collect())


@pytest.mark.parametrize("options", [{}, {"size": 3.0}, {"grow": 1.5}, {"crowd": 20}, {"size": 0.1, "crowd": 7}])
def test_grid_join_of_mixed_sizes(spark, options):
    a = mixed_boxes(300, 2.3, 1) + [(900, -180.0, -90.0, 180.0, 90.0)]
    b = mixed_boxes(400, 1.5, 2) + [(901, -180.0, -90.0, 180.0, 90.0), (902, 0.0, 0.0, 0.0, 0.0), (903, 0.0, 0.0, 0.0, 0.0)]
    got = pairs(spatial.grid_join(spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX), **options))
    assert got == sorted((p[0], q[0]) for p in a for q in b if meet(p, q, options.get("grow", 0.0)))


def test_a_world_box_stands_in_few_cells(spark):
    """Whatever the sizes of the other side: at most nine cells for each of its levels."""
    a = spark.createDataFrame([(0, -180.0, -90.0, 180.0, 90.0), *mixed_boxes(200, 2, 3)], BOX)
    b = spark.createDataFrame(mixed_boxes(200, -2, 4), BOX)
    x, y = spatial.cells_of_pairs(a, b)
    assert x.where("id = 0").groupBy("xmin").count().agg(F.max("count")).first()[0] <= 9
    levels = x.select("__k").distinct().count()
    assert y.groupBy("id").count().agg(F.max("count")).first()[0] <= 9 * (levels + 1)


def test_crowded_cells_are_dealt_out(spark):
    """A cell with many rows is cut into shares; pairs stay whole, and no share holds much more than its part."""
    dense = spark.range(4000).select(F.col("id").cast("int").alias("id"), (F.rand(1) * 0.5).alias("xmin"), (F.rand(2) * 0.5).alias("ymin")).selectExpr("*", "xmin as xmax", "ymin as ymax")
    wide = spark.createDataFrame([(7, 0.0, 0.0, 0.5, 0.5)], BOX)
    _, b = spatial.cells_of_pairs(wide, dense, crowd=500)
    shares = [r["n"] for r in b.where("__tag = 0").groupBy("__k", "__cx", "__cy", "__share").agg(F.count("*").alias("n")).collect()]
    assert max(shares) < 700 and sum(shares) >= 4000
    assert spatial.grid_join(wide, dense, crowd=500).count() == 4000


def test_joins_across_the_antimeridian(spark):
    rnd = random.Random(5)

    def some(n):
        out = []
        for i in range(n):
            x, y, w = rnd.uniform(-540, 540), rnd.uniform(-5, 5), float(rnd.choice([0, 0, 1, 30, 170, 300, 359, 360, 500]))
            out.append((i, x, y, x + w, y + float(i % 2)))
        return out

    a, b = some(100), some(120)
    touch = lambda p, q: p[2] <= q[4] and p[4] >= q[2] and any(p[1] <= q[3] + k * 360 and p[3] >= q[1] + k * 360 for k in range(-6, 7))
    got = pairs(spatial.wrapping_join(spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX)))
    assert got == sorted((p[0], q[0]) for p in a for q in b if touch(p, q))


def test_within_metres_at_poles_and_antimeridian(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.choice([-179.9, 179.95, rnd.uniform(-180, 180), 180.0]), rnd.choice([89.9, -89.95, 0.0, rnd.uniform(-90, 90)])) for i in range(250)]
    df = spark.createDataFrame(rows, "id int, lon double, lat double")

    def metres(p, q):
        a = math.sin(math.radians(q[2] - p[2]) / 2) ** 2 + math.cos(math.radians(p[2])) * math.cos(math.radians(q[2])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
        return 2 * 6371008.8 * math.asin(min(1.0, math.sqrt(a)))

    for reach in (30_000.0, 2_000_000.0, 30_000_000.0):
        got = pairs(spatial.within_metres(df, df, reach, F.col("a.id") < F.col("b.id")))
        assert got == sorted((p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and metres(p, q) <= reach)


def clustered(n, seed):
    """Uniform, crowded in a spot, on a lattice with ties, in a cloud; rare kinds and none."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        x, y = [(rnd.uniform(-180, 180), rnd.uniform(-85, 85)), (rnd.gauss(10, 1e-3), rnd.gauss(10, 1e-3)), (float(rnd.randrange(5)), float(rnd.randrange(5))), (rnd.gauss(-50, 5), rnd.gauss(40, 5))][i % 4]
        out.append((i, x, y, rnd.choice("aaab") if i % 50 else (f"z{i}" if i % 100 else None)))
    return out


def test_nearest_at_any_distance(spark):
    left, right = clustered(300, 7) + [(999, None, 1.0, "a")], clustered(500, 8)
    for these, exact in ((left, None), (right, F.col("a.id") != F.col("b.id"))):
        want = {}
        for p in these:
            of = [(round(math.hypot(p[1] - q[1], p[2] - q[2]), 9), q[0]) for q in right if p[1] is not None and p[3] == q[3] is not None and (exact is None or p[0] != q[0])]
            want[p[0]] = min(of)[1] if of else None
        df = spark.createDataFrame(these, POINT)
        got = spatial.nearest(df, spark.createDataFrame(right, POINT), "id", ["kind"], exact).collect()
        assert {r["id"]: r["nearest"] for r in got} == want and len(got) == len(these)
    none = spark.createDataFrame([], POINT)
    assert [r["nearest"] for r in spatial.nearest(spark.createDataFrame(left[:3], POINT), none, "id").collect()] == [None] * 3
    one = spark.createDataFrame([(1, 3.0, 3.0, "a")], POINT)
    assert [(r["nearest"], r["distance"]) for r in spatial.nearest(one, one, "id").collect()] == [(1, 0.0)]
    assert spatial.nearest(none, one, "id").count() == 0


def test_nearest_moves_a_row_once_or_twice(spark, monkeypatch):
    """Points on a lattice: a first look is at one cell a row, and the second, at the cells of the best's circle, is the last."""
    todo = []
    monkeypatch.setattr(spatial, "cut", lambda df, label, real=spatial.cut: (todo.append((label, real(df, label))), todo[-1][1])[1])
    p = spark.createDataFrame([(i, float(i % 30) + 0.3, float(i // 30) + 0.3, "a") for i in range(900)], POINT)
    got = spatial.nearest(p, p, "id", exact=F.col("a.id") != F.col("b.id")).collect()
    assert {round(r["distance"], 9) for r in got} == {1.0} and len(got) == 900
    first, *then = [df for label, df in todo if label == "round"]
    assert len(then) <= 1 and "reach" in first.columns and first.where("reach is not null").count() == 0


def test_small_boxes_climb_only_where_wide_ones_stand(spark):
    """The cells of the few widest boxes are known, so others do not climb into the empty ones."""
    a = spark.createDataFrame([(0, 0.0, 0.0, 60.0, 60.0)], BOX)
    b = spark.range(500).select(F.col("id").cast("int").alias("id"), (-170.0 + F.col("id") * 0.5).alias("xmin"), F.lit(10.0).alias("ymin")).selectExpr("*", "xmin + 0.25 as xmax", "ymin + 0.25 as ymax")
    _, y = spatial.cells_of_pairs(a, b)
    wide = y.where("__tag = 0").groupBy("__k").count().orderBy(F.desc("__k")).first()
    assert wide["count"] < 200
    assert spatial.grid_join(a, b).count() == b.where("xmax >= 0 and xmin <= 60").count()


def test_pairs_are_never_broadcast(spark):
    """A table of a few kB may have many cells: its side of the join is shuffled; a left join moves no pairs."""
    b = spark.createDataFrame(mixed_boxes(50, -2, 3), BOX)
    for how in ("inner", "left", "left_semi"):
        plan = spatial.grid_join(b, b, how=how)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("strategy=merge") >= 2, how


def test_clusters_of_a_crowd_make_few_edges(spark):
    """Two thousand boxes over one place: labels as by hand, and edges by the box, not by the pair."""
    from cartolith.operators import clusters

    rnd = random.Random(8)
    rows = [(i, x := rnd.uniform(0, 3), y := rnd.uniform(0, 3), x + rnd.uniform(0.2, 1), y + rnd.uniform(0.2, 1)) for i in range(1, 600)]
    rows += [(1000 + i, 10.0 + i, 0.0, 10.9 + i, 0.1) for i in range(20)] + [(2000 + i, 50.0 + i, 0.0, 51.0 + i, 0.01) for i in range(20)]
    df = spark.createDataFrame(rows, BOX)
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, p in enumerate(rows):
        for j in range(i):
            q = rows[j]
            if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4] and top(i) != top(j):
                group[max(top(i), top(j))] = min(top(i), top(j))
    assert {r["id"]: r["cluster"] for r in clusters.labelled(df, "id").collect()} == {p[0]: rows[top(i)][0] for i, p in enumerate(rows)}
    assert clusters._stars(df, "id", []).count() < 9 * len(rows)


def test_within_metres_measures_places_once(spark):
    """Rows of one place are met as one, in lists of bounded length; pairs are those of all rows."""
    rows = [(i, float(i % 7), float(i % 3)) for i in range(210)] + [(300, None, 1.0), (301, 1.0, None)]
    df = spark.createDataFrame(rows, "id int, lon double, lat double")
    assert spatial._places(df, 1000).count() == 21
    lists = [len(r[0]) for r in spatial._places(df, 4).select("__rows").collect()]
    assert max(lists) == 4 and sum(lists) == 210
    for most in (4, 1000):
        got = spatial.within_metres(df, df, 112_000.0, F.col("a.id") < F.col("b.id"), digits=0, most=most).select("a.id", "b.id", "metres").collect()
        near = lambda p, q: abs(p[1] - q[1]) + abs(p[2] - q[2]) <= 1
        assert sorted((r[0], r[1]) for r in got) == sorted((p[0], q[0]) for p in rows[:210] for q in rows[:210] if p[0] < q[0] and near(p, q))
        assert {r[2] for r in got if r[0] % 21 == r[1] % 21} == {0.0}


def test_grid_join_of_a_table_with_itself_shuffles_little(spark):
    """Of one level, both sides are the same rows in the same cells; sparse levels are put into one above; pairs stay as by hand."""
    b = spark.createDataFrame([p for p in mixed_boxes(300, 1.0, 9) if p[3] - p[1] <= 2.0 and p[4] - p[2] <= 2.0], BOX)
    x, y = spatial.cells_of_pairs(b, b, 2.0)
    assert x is y or x._jdf.queryExecution().analyzed().canonicalized().equals(y._jdf.queryExecution().analyzed().canonicalized())
    rows = [(i, v, v, v + 2.0 ** (6 - i.bit_length()), v + 2.0 ** (6 - i.bit_length())) for i, v in ((i, float(i * 37 % 300)) for i in range(1, 1000))]
    df = spark.createDataFrame(rows, BOX)
    assert len({r[0] for r in spatial.cells_of_pairs(df, df)[0].select("__k").distinct().collect()}) <= 5
    assert pairs(spatial.grid_join(df, df)) == sorted((p[0], q[0]) for p in rows for q in rows if meet(p, q))
