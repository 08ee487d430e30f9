"""FlatGeobuf files written by tasks and read back, whole and by box."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartolith.functions import jts
from cartolith.functions.curves import hilbert
from cartolith.tiles import flatgeobuf as fgb


def test_buffers_hold_what_was_put():
    t = fgb.Table({0: "né", 1: ("<f8", np.arange(4.0)), 2: ("<B", 3), 7: [fgb.Table({0: "a", 1: ("<B", 11)}), fgb.Table({0: "", 1: ("<B", 5)})], 8: ("<Q", 1 << 40), 9: ("<H", 16), 10: fgb.Table({1: ("<i", -5)})})
    raw = fgb.buffer(t)
    v = fgb.View(raw)
    assert v.string(0) == "né" and v.array(1, "<f8").tolist() == [0, 1, 2, 3] and v.number(2, "<B") == 3 and v.number(8, "<Q") == 1 << 40 and v.number(9, "<H") == 16
    assert [(x.string(0), x.number(1, "<B")) for x in v.tables(7)] == [("a", 11), ("", 5)] and v.table(10).number(1, "<i") == -5
    assert v.number(3, "<B", 9) == 9 and v.table(12) is None and v.tables(11) == [] and len(v.array(5, "<u4")) == 0
    assert (struct.unpack_from("<I", raw)[0]) % 8 == 0


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257, 5000])
def test_tree_finds_what_a_scan_finds(n):
    rng = np.random.default_rng(n)
    low = rng.uniform(-10, 10, (n, 2))
    boxes = np.concatenate([low, low + rng.exponential(0.5, (n, 2))], 1)
    tree = fgb.packed_tree(boxes, np.arange(n) * 10)
    assert len(tree) == sum(fgb.levels(n)) and tree["box"][0].tolist() == [*boxes[:, :2].min(0), *boxes[:, 2:].max(0)]
    for _ in range(20):
        a = rng.uniform(-11, 11, 2)
        q = (*a, *(a + rng.exponential(2, 2)))
        meets = (boxes[:, 0] <= q[2]) & (boxes[:, 2] >= q[0]) & (boxes[:, 1] <= q[3]) & (boxes[:, 3] >= q[1])
        assert fgb.search(tree, n, q).tolist() == (np.flatnonzero(meets) * 10).tolist()


SHAPES = [
    "POINT (1 2)", "MULTIPOINT ((1 2), (3 4))", "LINESTRING (0 0, 5 1)", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3, 4 1))", "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))",
    "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)), ((10 10, 19 10, 19 19, 10 19, 10 10), (11 11, 12 11, 12 12, 11 11)))",
]


def test_shapes_and_types_round_trip(spark, tmp_path):
    jts.register(spark)
    rows = [(i, f"n{i}" if i % 2 else None, i * 1.5, i % 3 == 0, i, bytes([i]), w) for i, w in enumerate(SHAPES)] + [(90, "no", None, None, None, None, None), (91, "empty", None, None, None, None, "POLYGON EMPTY")]
    df = spark.createDataFrame(rows, "id bigint, name string, x double, b boolean, i int, raw binary, w string").withColumn("geometry", jts.from_wkt("w")).withColumn("f", F.col("x").cast("float"))
    path = str(tmp_path / "a")
    fgb.write_flatgeobuf(df, path, "shapes", 3857)
    back = fgb.read_flatgeobuf(spark, path)
    assert [f.dataType for f in back.schema if f.name != "geometry"] == [f.dataType for f in df.schema if f.name != "geometry"]
    got = {r["id"]: r for r in back.withColumn("again", jts.wkt("geometry")).collect()}
    assert set(got) == set(range(len(SHAPES)))
    for r in df.where("id < 90").collect():
        g = got[r["id"]]
        assert g["again"] == r["w"] and all(g[k] == r[k] for k in ("name", "x", "b", "i", "raw", "f"))


def test_many_files_by_box(spark, tmp_path):
    jts.register(spark)
    rnd = random.Random(3)
    rows = [(i, rnd.uniform(-180, 179), rnd.uniform(-80, 80), rnd.expovariate(1)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, x double, y double, s double")
    at = lambda a, b: F.concat_ws(" ", (F.col("x") + a * F.col("s")).cast("string"), (F.col("y") + b * F.col("s")).cast("string"))
    df = df.withColumn("geometry", jts.from_wkt(F.concat(F.lit("POLYGON(("), F.concat_ws(",", at(0, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0)), F.lit("))"))))
    path = str(tmp_path / "b")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fgb.write_flatgeobuf(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = [p for p in (tmp_path / "b").iterdir() if p.suffix == ".fgb"]
    assert len(files) > 1 and all(p.read_bytes()[:8] == fgb.MAGIC and not p.name.startswith(".") for p in files)
    assert fgb.read_flatgeobuf(spark, path).count() == 3000
    for box in ((0.0, 0.0, 30.0, 20.0), (-180.0, -80.0, -170.0, -60.0), (500.0, 0.0, 501.0, 1.0)):
        got = sorted(r["id"] for r in fgb.read_flatgeobuf(spark, path, box).collect())
        assert got == sorted(i for i, x, y, s in rows if x <= box[2] and x + s >= box[0] and y <= box[3] and y + s >= box[1])


def _wkb(kind, xy, end):
    head = struct.pack(end + "BI", end == "<", kind)
    body = struct.pack(f"{end}{2 * len(xy)}d", *(v for p in xy for v in p))
    n = struct.pack(end + "I", len(xy))
    one = struct.pack(end + "I", 1)
    return head + {1: body, 2: n + body, 3: one + n + body, 4: n + b"".join(_wkb(1, [p], end) for p in xy) if kind == 4 else b""}[kind]


def test_features_of_one_layout_are_encoded_at_once(monkeypatch):
    """The same bytes, boxes and types as one by one, for all types, byte orders, nulls and slices, with few buffers made."""
    rnd = random.Random(5)
    columns = [("name", "string"), ("x", "double"), ("f", "float"), ("b", "boolean"), ("i", "int"), ("l", "bigint"), ("raw", "binary")]
    maybe = lambda v: None if rnd.random() < 0.1 else v
    point = lambda: (rnd.uniform(-9, 9), rnd.uniform(-9, 9))
    rows = []
    for i in range(3000):
        kind = rnd.choice([1, 2, 3, 3, 3, 4])
        xy = [point() for _ in range(1 if kind == 1 else rnd.randint(4, 6))]
        xy = [*xy, xy[0]] if kind == 3 else xy
        rows.append({"name": maybe(rnd.choice(["", "né", "four"])), "x": maybe(rnd.random()), "f": maybe(0.5 * i), "b": maybe(i % 2 == 0), "i": i - 9, "l": maybe((1 << 62) + i), "raw": maybe(bytes([i % 256])), "geometry": _wkb(kind, xy, rnd.choice("<>"))})
    types = [pa.string(), pa.float64(), pa.float32(), pa.bool_(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    batch = pa.RecordBatch.from_pylist(rows, pa.schema(list(zip([n for n, _ in columns] + ["geometry"], types))))
    for a, n in ((0, 3000), (7, 900), (11, 1)):
        want = []
        for r in rows[a : a + n]:
            g, box = fgb.geometry_table(r["geometry"])
            raw = fgb.buffer(fgb.Table({0: g, 1: ("<u1", np.frombuffer(fgb.properties(r, columns), "u1"))}))
            want.append((struct.pack("<I", len(raw)) + raw, box.tolist(), g[6][1]))
        out, boxes, sizes, kinds = fgb.encode(batch.slice(a, n), columns)
        assert out.tobytes() == b"".join(w[0] for w in want) and sizes.tolist() == [len(w[0]) for w in want]
        assert boxes.tolist() == [w[1] for w in want] and kinds == {w[2] for w in want}
    same = pa.RecordBatch.from_pylist([{"id": i, "geometry": _wkb(3, [(i, 0), (i + 1, 0), (i, 1), (i, 0)], ">")} for i in range(2000)], pa.schema([("id", pa.int64()), ("geometry", pa.binary())]))
    made = []
    monkeypatch.setattr(fgb, "buffer", lambda t, f=fgb.buffer: made.append(1) or f(t))
    fgb.encode(same, [("id", "bigint")])
    assert len(made) == 1


def test_rows_are_made_once(spark, tmp_path):
    """What is written is not computed again for its envelope and its ranges; the place on the curve is that of ``curves``."""
    jts.register(spark)
    seen = spark.sparkContext.accumulator(0)
    shape = F.udf(lambda i: seen.add(1) or f"POINT ({i} {i % 7})")
    fgb.write_flatgeobuf(spark.range(500).select("id", jts.from_wkt(shape("id")).alias("geometry")), str(tmp_path / "c"))
    assert seen.value == 500 and fgb.read_flatgeobuf(spark, str(tmp_path / "c")).count() == 500
    cells = spark.range(3000).selectExpr("id * 7919 % 65536 as x", "id * 104729 % 65536 as y")
    assert cells.where(hilbert(F.col("x"), F.col("y"), 16) != jts.hilbert("x", "y", F.lit(16))).count() == 0
