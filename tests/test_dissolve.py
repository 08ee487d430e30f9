"""Unions by a tree, cuts along a grid, the Hilbert curve and sums to roots."""

import random

import pytest
from pyspark.sql import functions as F

from cartolith.functions import jts
from cartolith.functions.curves import hilbert
from cartolith.operators import dissolve, graph

c = F.col


def box(x, y, w, h):
    at = lambda i, j: F.concat_ws(" ", (x + i * w).cast("string"), (y + j * h).cast("string"))
    return jts.from_wkt(F.concat(F.lit("POLYGON(("), F.concat_ws(",", at(0, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0)), F.lit("))")))


def test_hilbert_visits_each_cell_once_and_goes_by_neighbours(spark):
    d = spark.range(4096).select((c("id") % 64).alias("x"), F.floor(c("id") / 64).alias("y"))
    path = [(r["x"], r["y"]) for r in sorted(d.withColumn("d", hilbert(c("x"), c("y"), 6)).collect(), key=lambda r: r["d"])]
    assert len({r for r in path}) == 4096 and path[0] == (0, 0) and path[-1] == (63, 0)
    assert all(abs(a - p) + abs(b - q) == 1 for (a, b), (p, q) in zip(path, path[1:]))


def test_union_of_one_large_component(spark, monkeypatch):
    """A chain of 100,000 boxes that touch, beside small groups and one without key: no union takes more than its fan-out."""
    jts.register(spark)
    real = dissolve._union

    def counted(grid):
        return F.when(F.count("*") <= dissolve.FANOUT, real(grid))  # a larger one would give null

    monkeypatch.setattr(dissolve, "_union", counted)
    n = 100_000
    i = c("id")
    key = F.when(i < n, 0).when(i < n + 5, F.lit(None)).otherwise(i)
    df = spark.range(n + 40).select(key.cast("long").alias("k"), box((i % n).cast("double"), F.lit(0.0), F.lit(1.0), F.lit(2.0)).alias("geometry"))
    got = {r["k"]: (r["a"], r["p"]) for r in dissolve.union_tree(df, ["k"]).select("k", jts.area("geometry").alias("a"), F.size(jts.dump("geometry")).alias("p")).collect()}
    assert got == {0: (2.0 * n, 1), None: (10.0, 1)} | {k: (2.0, 1) for k in range(n + 5, n + 40)}


def test_union_of_crowded_and_equal_boxes(spark):
    jts.register(spark)
    i = c("id")
    df = spark.range(3000).select((i % 2).alias("k"), box(F.lit(5.0), (i % 3).cast("double") * 10, F.lit(1.0), F.lit(1.0)).alias("geometry"))
    df = df.unionByName(df.limit(1).select(F.lit(9).cast("long").alias("k"), F.lit(None).cast("binary").alias("geometry")))
    got = {r["k"]: r["a"] for r in dissolve.union_tree(df, ["k"], 0.001).select("k", jts.area("geometry").alias("a")).collect()}
    assert got == {0: 3.0, 1: 3.0}
    assert dissolve.union_tree(df.limit(0), ["k"]).count() == 0


def test_cells_keep_the_area(spark):
    """Large shapes are halved, then cut; the parts add up and none leaves its cell."""
    jts.register(spark)
    df = spark.range(3).select("id", jts.buffer(jts.point(c("id") * 7.3, F.lit(1.1)), 5.0, 600).alias("geometry"))
    x = dissolve.in_cells(df, 2.0, 256)
    whole = {r["id"]: r["a"] for r in df.select("id", jts.area("geometry").alias("a")).collect()}
    for r in x.groupBy("id").agg(F.sum(jts.area("geometry")).alias("a")).collect():
        assert r["a"] == pytest.approx(whole[r["id"]], rel=1e-9)
    b = jts.with_box(x)
    assert b.where("xmin < cx * 2.0 - 1e-9 or xmax > cx * 2.0 + 2.0 + 1e-9 or ymin < cy * 2.0 - 1e-9 or ymax > cy * 2.0 + 2.0 + 1e-9").count() == 0


def test_sums_to_root(spark):
    """A path of 3000 nodes, a bush, lone roots, nodes under a missing one."""
    rnd = random.Random(4)
    parent = {0: None} | {i: i - 1 for i in range(1, 3000)} | {5000: None} | {i: rnd.choice([5000, *range(5001, i)]) for i in range(5001, 5300)} | {7000: None, 7001: None, 8001: 8000, 8002: 8001}
    value = {i: rnd.randrange(-5, 50) for i in parent}
    want = {}
    for i in sorted(parent):
        p = parent[i]
        if p is None:
            want[i] = (i, value[i], 1)
        elif p in want:
            want[i] = (want[p][0], want[p][1] + value[i], want[p][2] + 1)
    df = spark.createDataFrame([(i, parent[i], value[i]) for i in parent], "id long, parent long, value int")
    got = {r["id"]: (r["root"], r["total"], r["depth"]) for r in graph.sums_to_root(df).collect()}
    assert got == want
    assert graph.sums_to_root(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        graph.sums_to_root(spark.createDataFrame([(1, 2, 1), (2, 3, 1), (3, 1, 1)], "id long, parent long, value int"))


def test_cells_cut_each_geometry_once(spark):
    """One call a cell, below the explode, so that no filter cuts again; borders that only touch leave nothing, and a rectangle gives what the overlay gives."""
    jts.register(spark)
    wkt = ["POLYGON((0.5 0.5,5 0.5,5 3,0.5 3,0.5 0.5))", "POLYGON((0.5 0.5,5 0.5,5 3,3 3.1,0.5 3,0.5 0.5))", "LINESTRING(1 1,5 1)", "POINT(2 2)", "POLYGON((0 0,2 0,2 2,0 2,0 0))"]
    df = spark.createDataFrame(list(enumerate(wkt)), "id int, wkt string").select("id", jts.from_wkt("wkt").alias("geometry"))
    x = dissolve.in_cells(df, 2.0)
    kept = x.select("id", "cx", "cy", jts.area("geometry").alias("area"), jts.length("geometry").alias("length")).where("area >= 0")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ct_clip(") == 1 and "ct_intersection" not in plan
    rows = {(r["id"], r["cx"], r["cy"]): (round(r["area"], 6), round(r["length"], 6)) for r in kept.collect()}
    assert {k[1:]: v[0] for k, v in rows.items() if k[0] == 0} == {(0, 0): 2.25, (1, 0): 3.0, (2, 0): 1.5, (0, 1): 1.5, (1, 1): 2.0, (2, 1): 1.0}
    assert sum(v[0] for k, v in rows.items() if k[0] == 1) == pytest.approx(11.475, abs=1e-5)
    assert {k: v[1] for k, v in rows.items() if k[0] == 2} == {(2, 0, 0): 1.0, (2, 1, 0): 2.0, (2, 2, 0): 1.0}
    assert [k for k in rows if k[0] == 3] == [(3, 1, 1)] and {k: v for k, v in rows.items() if k[0] == 4} == {(4, 0, 0): (4.0, 0.0)}
