"""Tagged features to typed tables: a mapping compiled to one projection.

    {"type": "polygon", "mapping": {"natural": ["water"], "waterway": ["__any__"]}, "columns": [{"name": "name", "type": "string", "key": "name"}, ...],
     "filters": {"require": {...}, "reject": {...}}}

Input rows are (id, type, tags, geometry, members); a feature gives one row for each key and value that the mapping names.
"""

from __future__ import annotations

from fnmatch import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jts

ANY = "__any__"
GEOMETRY = {"point": ["Point"], "linestring": ["LineString", "MultiLineString"], "polygon": ["Polygon", "MultiPolygon"]}
KNOWN = {"type", "mapping", "columns", "filters", "tags"}


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Features as Parquet: id, type, tags, geometry (WKB) and, for relations, members."""
    return spark.read.parquet(path)


def read_points_csv(spark: SparkSession, path: str, x: str, y: str, sep: str = ",") -> DataFrame:
    """A delimited file with longitude and latitude columns; all other columns stay text."""
    jts.register(spark)
    d = spark.read.option("header", True).option("sep", sep).csv(path)
    return d.withColumn("geometry", F.when(F.col(x).try_cast("double").isNotNull(), jts.point(F.col(x).try_cast("double"), F.col(y).try_cast("double"))))


def one_layer(names: list[str], pattern: str) -> str:
    """The only name that matches."""
    found = [n for n in names if fnmatch(n, pattern)]
    if len(found) != 1:
        raise ValueError(f"{pattern!r} matches {found}")
    return found[0]


def _is(values: list[str], v: Column) -> Column:
    return v.isNotNull() if ANY in values else F.coalesce(v.isin(*values), F.lit(False))


def prune_tags(tags: Column, keep: list[str]) -> Column:
    """Tags that a mapping, a column or the include list names."""
    return F.map_filter(tags, lambda k, _: k.isin(*keep))


def column(spec: dict) -> Column:
    v, kind = F.col("tags")[spec.get("key", spec["name"])], spec["type"]
    if kind == "string":
        out = F.coalesce(v, F.lit(""))
    elif kind == "bool":
        out = F.coalesce(v, F.lit("no")).isin("yes", "true", "1")
    elif kind == "integer":
        out = v.try_cast("int")
    elif kind == "direction":
        out = F.when(v.isin("yes", "true", "1"), 1).when(v == "-1", -1).otherwise(0)
    elif kind == "id":
        out = F.col("id")
    elif kind in ("geometry", "validated_geometry"):
        out = jts.make_valid("geometry") if kind == "validated_geometry" else F.col("geometry")
    elif kind == "area":
        out = jts.area_mercator("geometry").cast("float")
    elif kind == "mapping_key":
        out = F.col("__m.key")
    elif kind == "mapping_value":
        out = F.col("__m.value")
    elif kind == "hstore_tags":
        out = F.col("tags")
    else:
        raise ValueError(f"unknown column type {kind!r}")
    return out.alias(spec["name"])


def apply_mapping(features: DataFrame, spec: dict) -> DataFrame:
    if unknown := set(spec) - KNOWN:
        raise ValueError(f"unknown keys {sorted(unknown)}")
    f = features
    if spec.get("type") in GEOMETRY:
        f = f.where(jts.type_of("geometry").isin(GEOMETRY[spec["type"]]))
    rules = spec.get("filters", {})
    for key, values in rules.get("require", {}).items():
        f = f.where(_is(values, F.col("tags")[key]))
    for key, values in rules.get("reject", {}).items():
        f = f.where(~_is(values, F.col("tags")[key]))
    wanted = lambda e: reduce(lambda a, b: a | b, [(e["key"] == k) & _is(v, e["value"]) for k, v in spec["mapping"].items()])
    f = f.withColumn("__m", F.explode(F.filter(F.map_entries("tags"), wanted)))
    if "tags" in spec:
        f = f.withColumn("tags", prune_tags(F.col("tags"), [*spec["mapping"], *(c.get("key", c["name"]) for c in spec["columns"]), *spec["tags"]]))
    return f.select(*(column(c) for c in spec["columns"]))


def relation_members(features: DataFrame, spec: dict, from_member: list[str] = ()) -> DataFrame:
    """One row per relation and member: osm_id, member, role, the relation's tags and, if asked, tags and shape of the member."""
    r = features.where(F.col("type") == "relation")
    for key, values in spec["mapping"].items():
        r = r.where(_is(values, F.col("tags")[key]))
    r = r.select(F.col("id").alias("osm_id"), F.col("tags"), F.explode("members").alias("m")).select("osm_id", "tags", F.col("m.ref").alias("member"), F.col("m.role").alias("role"))
    m = features.where(F.col("type") != "relation").select(F.col("id").alias("member"), "geometry", *(F.col("tags")[k].alias(k) for k in from_member))
    return r.join(m, "member", "left")


def clip(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Features that meet the box, cut to it."""
    box = jts.from_wkt(F.lit(f"POLYGON(({xmin} {ymin},{xmax} {ymin},{xmax} {ymax},{xmin} {ymax},{xmin} {ymin}))"))
    return df.where(jts.intersects("geometry", box)).withColumn("geometry", jts.intersection("geometry", box))
