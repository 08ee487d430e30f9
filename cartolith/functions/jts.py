"""Geometry over WKB by the JTS library on Spark's own class path.

``CartolithGeometry.java`` is compiled once per session by the bundled Janino compiler, added as a jar and registered
as JVM functions ``ct_<name>``; no Python runs per row.  Coordinates are lon, lat degrees unless said otherwise.

Known bounds: ``area_spheroid`` takes edges as geodesics of the ellipsoid, with points every ten kilometres, and sums on the authalic
sphere; ``*_spheroid`` lengths and distances are geodesic (NaN between nearly opposite points), the nearest points of lines and areas
are those of a plane scaled to their latitude; ``*_metres`` are on the sphere; ``buffer_metres`` and ``segmentize_metres`` use the local scale, within 1 % for features under
100 km; ``make_valid`` is the structure method and ``make_valid_linework`` the even-odd one, areas only; ``simplify_vw`` takes an area;
``simplify_arcs`` takes x and y of the junctions in turn; ``clip`` takes xmin, ymin, xmax and ymax of a box; ``hilbert`` takes x, y and order, as that of ``curves``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

B, D, L, I, S = T.BinaryType(), T.DoubleType(), T.ArrayType(T.BinaryType()), T.IntegerType(), T.StringType()
FUNCTIONS = (
    dict.fromkeys("area area_mercator area_sphere area_spheroid length perimeter length_mercator length_spheroid distance distance_metres distance_spheroid".split(), D)
    | dict.fromkeys("from_wkt union_all to_3857 from_3857 to_3395 to_4087 make_valid make_valid_linework point_on_surface centroid polygons exterior inscribed_circle union_grid point polygon simplify_vw simplify buffer_metres reduce_precision interpolate segmentize_metres expand intersection difference union buffer simplify_arcs clip".split(), B)
    | dict.fromkeys("is_valid is_empty is_closed intersects contains contains_properly overlaps dwithin dwithin_metres dwithin_spheroid".split(), T.BooleanType())
    | dict.fromkeys("dump dump_points dump_rings subdivide".split(), L)
    | {"hilbert": T.LongType(), "dimension": I, "npoints": I, "type": S, "wkt": S, "bbox": T.ArrayType(D), "ring_vertices": T.ArrayType(T.ArrayType(D))}
)

TWO = frozenset("union_grid point polygon simplify_vw simplify buffer_metres reduce_precision subdivide interpolate segmentize_metres expand intersects contains contains_properly overlaps distance distance_metres distance_spheroid intersection difference union clip".split())
THREE = frozenset("hilbert dwithin dwithin_metres dwithin_spheroid buffer simplify_arcs".split())


def register(spark: SparkSession) -> None:
    """Compiles and registers the functions, once per session."""
    if spark.conf.get("cartolith.jts", None) == "ready":
        return
    jvm = spark.sparkContext._jvm
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
    with open(os.path.join(os.path.dirname(__file__), "CartolithGeometry.java")) as f:
        compiler.cook(f.read())
    jar = os.path.join(tempfile.gettempdir(), f"cartolith-{uuid.uuid4().hex}.jar")
    with zipfile.ZipFile(jar, "w") as z:
        for entry in compiler.getBytecodes().entrySet():
            z.writestr(f"{entry.getKey().replace('.', '/')}.class", bytes(entry.getValue()))
    spark.sql(f"ADD JAR '{jar}'")  # Spark's file server hands it to the executors
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    kinds = spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 1)
    kinds[0] = jvm.java.lang.Class.forName("java.lang.String")
    make = {}
    for arity in ("One", "Two", "Three"):
        name = f"CartolithGeometry${arity}"
        try:
            made = jvm.java.lang.Class.forName(name, True, loader)
        except Exception:
            made = compiler.getClassLoader().loadClass(name)
        make[arity] = made.getConstructor(kinds)
    for name, kind in FUNCTIONS.items():
        arity = "Three" if name in THREE else "Two" if name in TWO else "One"
        args = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 1)
        args[0] = name
        java_type = spark._jsparkSession.parseDataType(kind.json())
        spark._jsparkSession.udf().register(f"ct_{name}", make[arity].newInstance(args), java_type)
    spark.conf.set("cartolith.jts", "ready")


def _call(name: str):
    def f(*args) -> Column:
        return F.call_function(f"ct_{name}", *(F.col(a) if isinstance(a, str) else a if isinstance(a, Column) else F.lit(a) for a in args))

    f.__name__ = name
    return f


for _name in FUNCTIONS:
    globals()[_name if _name != "type" else "type_of"] = _call(_name)


def with_box(df, geometry: str = "geometry"):
    """Adds xmin, ymin, xmax, ymax, which spatial joins work on."""
    b = _call("bbox")(geometry)
    return df.withColumn("__box", b).select("*", *(F.get("__box", F.lit(i)).alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax")))).drop("__box")
