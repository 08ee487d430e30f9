"""Queries of the catalogue against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from cartolith.plans import catalogue, maps, maps_land, shapes, unions  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    d = duckdb.connect()
    d.execute("set timezone = 'UTC'")
    for f in os.listdir(SF):
        d.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return d


def canon(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    one = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_against_sql(spark, db, name):
    d = catalogue.QUERIES[name](spark, SF)
    r = db.execute(catalogue.ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(d.columns) == sorted(names)
    assert canon(d.collect(), d.columns) == canon(r.fetchall(), names)


def test_grid_join_rows(spark):
    """Equal rows and rows without id are rows of their own in every mode; columns may be maps."""
    from pyspark.sql import functions as F

    from cartolith.operators import spatial

    at = lambda rows: spark.createDataFrame(rows, "id int, xmin double, ymin double").selectExpr("*", "xmin + 1 as xmax", "ymin + 1 as ymax", "map('k', id) as m")
    left = at([(1, 0.0, 0.0), (1, 0.0, 0.0), (None, 0.2, 0.2), (2, 50.0, 50.0), (None, 60.0, 60.0)])
    right = at([(7, 0.5, 0.5), (8, 0.9, 0.1)])
    run = lambda how: spatial.grid_join(left, right, 0.3, how=how)
    assert [r["id"] for r in run("left_semi").collect()].count(1) == 2 and run("left_semi").count() == 3
    assert {r["id"] for r in run("left_anti").collect()} == {2, None} and run("left_anti").count() == 2
    assert run("inner").count() == 6
    rows = run("left").select("a.id", F.col("b.id").alias("other")).collect()
    assert sorted((str(r[0]), str(r[1])) for r in rows) == sorted([("1", "7"), ("1", "8")] * 2 + [("None", "7"), ("None", "8"), ("2", "None"), ("None", "None")])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_pairs_of_few_groups_are_dealt(spark):
    """The self join has its own number of tasks, which adaptive execution does not join up; flags come from semi joins."""
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.001"
    plan = lambda q: e.queries()[q](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert plan("null_safe_self_join").count(f"], {tasks}") >= 2
    flags = plan("overlap_contained_flags")
    assert flags.count("LeftSemi") == 4 and "max(" not in flags  # in cells, then of the rows


def test_clusters_of_a_long_chain(spark, tmp_path):
    """A chain of boxes of many more steps than rounds were counted out once: one label in Spark and in the SQL, and those without a type among themselves."""
    d = 85_679  # a hundredth of a degree to the east and nine to the south
    rows = [(k * d, "a" if k <= 300 else None) for k in range(1, 401)] + [(1, None)]
    spark.createDataFrame(rows, "event_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = {tuple(r) for r in catalogue.QUERIES["cluster_touching"](spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert got == set(db.execute(catalogue.ORACLE_SQL["cluster_touching"]).fetchall())
    assert got == {(k * d, d if k <= 300 else 301 * d) for k in range(1, 401)} | {(1, 1)}
