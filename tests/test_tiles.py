import struct

import pytest
from pyspark.sql import functions as F

from cartolith.functions import jts
from cartolith.plans import pipeline
from cartolith.plans.layers import Catalog
from cartolith.sources import mapping
from cartolith.tiles import mvt, packages
from cartolith.tiles.filters import compile_filter


def fields(b):
    at, out = 0, []

    def varint():
        nonlocal at
        v = s = 0
        while True:
            c = b[at]
            at += 1
            v |= (c & 0x7F) << s
            s += 7
            if c < 0x80:
                return v

    while at < len(b):
        k = varint()
        if k & 7 == 2:
            n = varint()
            out.append((k >> 3, b[at : at + n]))
            at += n
        elif k & 7 == 1:
            out.append((k >> 3, struct.unpack("<d", b[at : at + 8])[0]))
            at += 8
        else:
            out.append((k >> 3, varint()))
    return out


def test_layer_encoding():
    square = struct.pack("<BIII", 1, 3, 1, 5) + struct.pack("<10d", 0, 0, 1e6, 0, 1e6, 1e6, 0, 1e6, 0, 0)
    n, tile = mvt.encode_layer("a", [(square, {"k": "v", "n": 3, "f": 1.5, "b": True, "none": None})], 0, 0, 0)
    layer = fields(fields(tile)[0][1])
    assert n == 1 and (1, b"a") in layer and (15, 2) in layer and (5, 4096) in layer
    feature = dict(fields(next(v for k, v in layer if k == 2)))
    assert feature[3] == 3 and len(feature[2]) == 8
    assert [v for k, v in layer if k == 3] == [b"k", b"n", b"f", b"b"]
    kind, cmd = mvt.commands(square, 0, 0, 0)
    assert kind == 3 and cmd[0] == 9 and cmd[-1] == 15 and cmd[3] == (3 << 3 | 2)


def decoded(tile):
    """(kind, attributes, [points]) of each feature of a tile of one layer; points in tile units, a list for each pen-down."""
    layer = fields(fields(tile)[0][1])
    keys, values = [v.decode() for k, v in layer if k == 3], [fields(v)[0][1] for k, v in layer if k == 4]
    ints = lambda b: [v for _, v in fields(b"".join(b"\x08" + x for x in varints(b)))]
    zag = lambda v: v >> 1 if not v & 1 else -(v + 1 >> 1)
    out = []
    for f in (fields(v) for k, v in layer if k == 2):
        f = dict(f)
        tags, g = ints(f.get(2, b"")), ints(f[4])
        lines, x, y, i = [], 0, 0, 0
        while i < len(g):
            op, n = g[i] & 7, g[i] >> 3
            i += 1
            if op == 7:
                continue
            for _ in range(n):
                x, y, i = x + zag(g[i]), y + zag(g[i + 1]), i + 2
                if op == 1:
                    lines.append([])
                lines[-1].append((x, y))
        out.append((f[3], {keys[a]: values[b] for a, b in zip(tags[::2], tags[1::2])}, lines))
    return out


def varints(b):
    out, at = [], 0
    while at < len(b):
        end = at
        while b[end] & 0x80:
            end += 1
        out.append(b[at : end + 1])
        at = end + 1
    return out


def shoelace(line):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(line, line[1:] + line[:1])) / 2


def test_parts_decode_to_the_same_features(spark):
    """A tile made of many parts holds what one part holds, in the same order; coalescing keeps the area of each attribute."""
    jts.register(spark)
    i = F.col("id")
    corner = lambda dx, dy: F.concat_ws(" ", (i % 30 * 3.0 - 60 + dx).cast("string"), (F.floor(i / 30) * 3.0 - 40 + dy).cast("string"))
    ring = F.concat(F.lit("POLYGON(("), F.concat_ws(",", corner(0, 0), corner(2, 0), corner(2, 2), corner(0, 2), corner(0, 0)), F.lit("))"))
    d = spark.range(600).select(F.when(F.floor(i % 30 / 15) == 0, "west").otherwise("east").alias("kind"), F.when(i % 7 == 0, F.lit(None)).otherwise(F.floor(i / 300)).alias("n"), jts.from_wkt(ring).alias("geometry"))
    d = d.unionByName(spark.range(40).select(F.lit("dot").alias("kind"), F.lit(1).cast("long").alias("n"), jts.point(i * 1.0, F.lit(5.0)).alias("geometry")))
    run = lambda **o: {(r["z"], r["x"], r["y"]): (r["n"], decoded(r["payload"])) for r in mvt.tile_layer(d, "l", 0, 1, ["kind", "n"], simplify=False, **o).collect()}
    for options in ({}, {"hilbert_order": True}, {"hilbert_order": True, "coalesce": True}):
        whole, many = run(**options), run(**options, part=17)
        assert whole == many and whole[0, 0, 0][0] == len(whole[0, 0, 0][1])
    plain, joined = run(), run(hilbert_order=True, coalesce=True)

    def areas(features):
        out = {}
        for kind, a, lines in features:
            key = kind, tuple(sorted(a.items()))
            out[key] = out.get(key, 0) + (sum(map(shoelace, lines)) if kind == 3 else len(lines))
        return out

    for tile, (n, features) in plain.items():
        assert areas(features) == areas(joined[tile][1]) and joined[tile][0] <= n
    assert joined[0, 0, 0][0] < plain[0, 0, 0][0] / 3
    assert all(a != b for a, b in zip(*(lambda f: (f, f[1:]))([x[:2] for x in joined[0, 0, 0][1]])))


def test_bundle_round_trip():
    tiles = [(130, 5, b"abc"), (129, 127, b"xy"), (128, 0, b"z" * 1000)]
    b = packages.bundle_bytes(tiles)
    assert all(packages.bundle_tile(b, r, c) == d for r, c, d in tiles) and packages.bundle_tile(b, 131, 6) is None
    head = struct.unpack_from("<4I3Q6I", b)
    assert head[0] == 3 and head[2] == 1000 and head[5] == len(b)
    assert packages.bundle_name(9, 1, 2) == "L09/R0080C0100.bundle"


def test_filters(spark):
    d = spark.createDataFrame([("a", 1, 5), ("b", None, 12), (None, 3, 12)], "k string, n int, z int")
    keep = lambda f: [(r["k"], r["z"]) for r in d.where(compile_filter({"*": f}, "x", F.col("z"), d.columns)).collect()]
    assert keep(["==", "k", "a"]) == [("a", 5)] and keep(["!=", "k", "a"]) == [("b", 12), (None, 12)]
    assert keep(["all", [">=", "$zoom", 10], ["has", "n"]]) == [(None, 12)] and keep(["any", ["<", "n", 2], ["!in", "k", "a", "b"]]) == [("a", 5), (None, 12)]
    assert keep(["none", ["in", "k", "a"], ["!has", "k"]]) == [("b", 12)] and keep(["has", "missing"]) == []
    with pytest.raises(ValueError):
        compile_filter({"*": ["near", "k"]}, "x", F.col("z"), d.columns)
    assert d.where(compile_filter({"other": ["==", "k", "a"]}, "x", F.col("z"), d.columns)).count() == 3


def test_tiles_end_to_end(spark, tmp_path):
    jts.register(spark)
    rows = [("POINT(10 50)", "p", 1), ("LINESTRING(0 0, 20 20)", "l", 2), ("POLYGON((-10 -10,10 -10,10 10,-10 10,-10 -10))", "g", 3)]
    d = spark.createDataFrame(rows, "w string, name string, n int").withColumn("geometry", jts.from_wkt("w"))
    t = mvt.tile_layer(d, "things", 0, 2, ["name", "n"], {"*": ["any", ["!=", "name", "p"], [">=", "$zoom", 2]]})
    got = {(r["z"], r["x"], r["y"]): r["n"] for r in t.collect()}
    assert got[0, 0, 0] == 2 and got[2, 2, 1] >= 3 and all(0 <= x < 2**z and 0 <= y < 2**z for z, x, y in got)
    both = mvt.join_tiles(t, t.withColumn("layer", F.lit("z")))
    assert both.where("z = 0").first()["n"] == 4
    path = str(tmp_path / "a.mbtiles")
    packages.write_mbtiles(t, path, {"maxzoom": "2", "json": '{"tilestats": 1, "x": 2}'})
    meta, tiles = packages.read_mbtiles(path)
    assert len(tiles) == len(got) and meta["maxzoom"] == "2" and fields(tiles[0][3])[0][0] == 3
    packages.trim_mbtiles(path, str(tmp_path / "b.mbtiles"), 1)
    meta, tiles = packages.read_mbtiles(str(tmp_path / "b.mbtiles"))
    assert meta["maxzoom"] == "1" and max(z for z, *_ in tiles) == 1
    b = packages.to_bundles(t).collect()
    assert sum(r["tiles"] for r in b) == len(got) and {r["z"] for r in b} == {0, 1, 2}
    assert packages.common_crs([{}, {"crs": "EPSG:3857"}]) == "EPSG:3857"
    with pytest.raises(ValueError):
        packages.common_crs([{}, {"crs": "EPSG:3395"}])
    assert mvt.zoom_range(11, 13, 9) == (9, 9) and mvt.extra_detail(13, 9) == 10


def test_mapping(spark):
    jts.register(spark)
    rows = [(1, "way", {"natural": "water", "waterway": "dam", "name": "L", "width": "x"}, "POLYGON((0 0,1 0,1 1,0 1,0 0))", None), (2, "way", {"natural": "water", "covered": "yes"}, "POLYGON((0 0,1 0,1 1,0 1,0 0))", None), (3, "node", {"natural": "water"}, "POINT(5 5)", None), (-4, "relation", {"route": "road"}, None, [(1, "main")])]
    f = spark.createDataFrame(rows, "id bigint, type string, tags map<string,string>, w string, members array<struct<ref:bigint,role:string>>").withColumn("geometry", jts.from_wkt("w"))
    spec = {"type": "polygon", "mapping": {"natural": ["water"], "waterway": [mapping.ANY]}, "columns": [{"name": "osm_id", "type": "id"}, {"name": "name", "type": "string"}, {"name": "width", "type": "integer"}, {"name": "class", "type": "mapping_key"}, {"name": "subclass", "type": "mapping_value"}, {"name": "tags", "type": "hstore_tags"}], "filters": {"reject": {"covered": ["yes"]}}, "tags": []}
    got = sorted((r["osm_id"], r["class"], r["subclass"], r["name"], r["width"], len(r["tags"])) for r in mapping.apply_mapping(f, spec).collect())
    assert got == [(1, "natural", "water", "L", None, 4), (1, "waterway", "dam", "L", None, 4)]
    r = mapping.relation_members(f, {"mapping": {"route": ["road"]}}, ["name"]).first()
    assert (r["osm_id"], r["member"], r["role"], r["name"]) == (-4, 1, "main", "L")
    assert mapping.clip(f.where("geometry is not null"), 0.5, 0, 2, 2).count() == 2
    with pytest.raises(ValueError):
        mapping.apply_mapping(f, {**spec, "filtres": {}})
    with pytest.raises(ValueError):
        mapping.one_layer(["a_x", "a_y"], "a_*")
    assert mapping.one_layer(["a_x", "b"], "a_*") == "a_x"


def test_runner(spark, tmp_path):
    jts.register(spark)
    d = spark.createDataFrame([(1, "gate", "G", "", "POINT(0 0)")], "osm_id bigint, subclass string, name string, name_en string, w string").withColumn("geometry", jts.from_wkt("w"))
    cat = Catalog(spark, lambda name: {"osm_barrier_point": d}[name])
    said = pipeline.run_layers(cat, str(tmp_path), ["barrier_point", "barrier_line"], summary=str(tmp_path / "summary.json"))
    assert said["status"] == pipeline.PARTIAL and {r["layer"]: r["status"] for r in said["layers"]} == {"barrier_point": "SUCCESS", "barrier_line": "FAILED"}
    assert pipeline.run_layers(cat, str(tmp_path), ["barrier_point"])["layers"][0]["skipped"]
    assert spark.read.parquet(str(tmp_path / "barrier_point")).first()["name"] == "G"
