"""Vector tiles: features to (z, x, y, layer) payloads in the Mapbox vector tile encoding.

Features are dealt out over the tiles that their boxes touch, clipped in the JVM to the tile with a margin, and
encoded in parts by Arrow batches.  A tile's features are those of one layer; tiles of several layers are joined by
concatenation, which the format allows.
"""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jts
from ..functions.curves import cell_of, hilbert
from ..functions.zoom import AROUND
from ..operators.borders import with_junctions
from ..operators.graph import cut
from .filters import compile_filter

HALF = AROUND / 2
EXTENT = 4096
#: Margin around a tile, of its extent.
MARGIN = 80
#: Order of the Hilbert curve over a tile.
ORDER = 12
SCHEMA = "z int, x bigint, y bigint, layer string, n bigint, payload binary"


def zoom_range(min_zoom: int, max_zoom: int, limit: int) -> tuple[int, int]:
    """A layer's zooms under a limit on the highest."""
    top = min(max_zoom, limit)
    return min(min_zoom, top), top


def extra_detail(max_zoom: int, constant: int) -> int:
    return min(max_zoom + 1, constant + 1)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def _number(number: int, v: int) -> bytes:
    return _varint(number << 3) + _varint(v)


def value(v) -> bytes:
    if isinstance(v, bool):
        return _number(7, int(v))
    if isinstance(v, int):
        return _number(6, v << 1 if v >= 0 else (-v << 1) - 1)
    if isinstance(v, float):
        return _varint(3 << 3 | 1) + struct.pack("<d", v)
    return _field(1, str(v).encode())


def parts(wkb: bytes) -> tuple[int, list[list[list[tuple[float, float]]]]]:
    """Type (1 point, 2 line, 3 polygon) and, for each part, its rings or lines."""
    def one(at: int):
        order = "<" if wkb[at] else ">"
        kind = struct.unpack_from(order + "I", wkb, at + 1)[0] & 0xFF
        at += 5

        def points(at: int, n: int):
            flat = struct.unpack_from(f"{order}{2 * n}d", wkb, at)
            return list(zip(flat[::2], flat[1::2], strict=True)), at + 16 * n

        if kind == 1:
            p, at = points(at, 1)
            return 1, [[p]], at
        n = struct.unpack_from(order + "I", wkb, at)[0]
        at += 4
        if kind == 2:
            p, at = points(at, n)
            return 2, [[p]], at
        if kind == 3:
            rings = []
            for _ in range(n):
                m = struct.unpack_from(order + "I", wkb, at)[0]
                p, at = points(at + 4, m)
                rings.append(p)
            return 3, [rings] if rings else [], at
        top, every = 0, []
        for _ in range(n):
            k, some, at = one(at)
            if k > top:
                top, every = k, []
            if k == top:
                every += some
        return top, every, at

    kind, every, _ = one(0)
    return kind, every


def _signed(ring: list[tuple[int, int]]) -> int:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))


def _zig(v: int) -> int:
    return v << 1 if v >= 0 else (-v << 1) - 1


def _zag(v: int) -> int:
    return v >> 1 if not v & 1 else -(v + 1 >> 1)


def drawn(wkb: bytes, z: int, x: int, y: int, extent: int = EXTENT) -> tuple[int, list[int], tuple[int, int]]:
    """Geometry of plane coordinates as kind, tile commands and the point where the pen ends."""
    kind, every = parts(wkb)
    side = AROUND / 2**z
    left, top = x * side - HALF, HALF - y * side
    out: list[int] = []
    cx = cy = 0

    def put(p: tuple[int, int]) -> None:
        nonlocal cx, cy
        out.extend((_zig(p[0] - cx), _zig(p[1] - cy)))
        cx, cy = p

    moved = [[[(round((px - left) / side * extent), round((top - py) / side * extent)) for px, py in line] for line in part] for part in every]
    if kind == 1:
        pts = [line[0] for part in moved for line in part]
        if pts:
            out.append(len(pts) << 3 | 1)
            for p in pts:
                put(p)
        return 1, out, (cx, cy)
    for part in moved:
        for i, line in enumerate(part):
            line = [p for k, p in enumerate(line) if k == 0 or p != line[k - 1]]
            if kind == 3:
                if len(line) > 1 and line[0] == line[-1]:
                    line = line[:-1]
                if len(line) < 3 or _signed(line) == 0:
                    if i == 0:
                        break
                    continue
                if (_signed(line) > 0) != (i == 0):  # outer rings turn right on the screen, inner ones left
                    line = line[::-1]
            elif len(line) < 2:
                continue
            out.append(1 << 3 | 1)
            put(line[0])
            out.append((len(line) - 1) << 3 | 2)
            for p in line[1:]:
                put(p)
            if kind == 3:
                out.append(1 << 3 | 7)
    return kind, out, (cx, cy)


def commands(wkb: bytes, z: int, x: int, y: int, extent: int = EXTENT) -> tuple[int, list[int]]:
    return drawn(wkb, z, x, y, extent)[:2]


class Layer:
    """Features of one tile in order, with dictionaries of their own: a whole layer, or a part that others are added to."""

    def __init__(self, coalesce: bool = False):
        self.coalesce = coalesce
        self.keys: dict[str, int] = {}
        self.values: dict[bytes, int] = {}
        self.features: list[tuple[int, list[int], list[int], tuple[int, int]]] = []

    def add(self, kind: int, tags: list[int], geometry: list[int], end: tuple[int, int]) -> None:
        """Appends a feature; one with the tags and kind of the last joins it, if the layer coalesces."""
        if self.coalesce and self.features and self.features[-1][:2] == (kind, tags):
            _, _, before, (ex, ey) = self.features[-1]
            head = [_zig(_zag(geometry[1]) - ex), _zig(_zag(geometry[2]) - ey)]  # from where the pen is, not from the corner
            if kind == 1:  # points are one command
                joined = [((before[0] >> 3) + (geometry[0] >> 3)) << 3 | 1, *before[1:], *head, *geometry[3:]]
            else:
                joined = [*before, geometry[0], *head, *geometry[3:]]
            self.features[-1] = kind, tags, joined, end
        else:
            self.features.append((kind, tags, geometry, end))

    def draw(self, wkb: bytes, attributes: dict, z: int, x: int, y: int, extent: int = EXTENT) -> None:
        kind, geometry, end = drawn(wkb, z, x, y, extent)
        if geometry:
            pairs = ((self.keys.setdefault(k, len(self.keys)), self.values.setdefault(value(v), len(self.values))) for k, v in attributes.items() if v is not None)
            self.add(kind, [i for pair in pairs for i in pair], geometry, end)

    def extend(self, keys: list[str], values: list[bytes], features) -> None:
        """Adds a later part, its tags renumbered by this layer's dictionaries."""
        number = [[self.keys.setdefault(k, len(self.keys)) for k in keys], [self.values.setdefault(v, len(self.values)) for v in values]]
        for kind, tags, geometry, end in features:
            self.add(kind, [number[i & 1][t] for i, t in enumerate(tags)], geometry, tuple(end))

    def encode(self, layer: str, extent: int = EXTENT) -> bytes:
        if not self.features:
            return b""
        body = [_field(2, (_field(2, b"".join(map(_varint, tags))) if tags else b"") + _number(3, kind) + _field(4, b"".join(map(_varint, geometry)))) for kind, tags, geometry, _ in self.features]
        tail = [_field(3, k.encode()) for k in self.keys] + [_field(4, v) for v in self.values]
        return _field(3, _number(15, 2) + _field(1, layer.encode()) + b"".join(body) + b"".join(tail) + _number(5, extent))


def encode_layer(layer: str, features: list[tuple[bytes, dict]], z: int, x: int, y: int, extent: int = EXTENT) -> tuple[int, bytes]:
    """Number of features and the tile that holds them."""
    whole = Layer()
    for wkb, attributes in features:
        whole.draw(wkb, attributes, z, x, y, extent)
    return len(whole.features), whole.encode(layer, extent)


#: Features that a part of a layer holds at most.
PART = 4096
PARTIAL = pa.schema([("z", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("range", pa.int32()), ("part", pa.int64()), ("keys", pa.list_(pa.string())), ("values", pa.list_(pa.binary())), ("kinds", pa.list_(pa.int32())), ("tags", pa.list_(pa.list_(pa.int32()))), ("drawings", pa.list_(pa.list_(pa.int64()))), ("ends", pa.list_(pa.list_(pa.int64())))])
PARTIAL_SCHEMA = "z int, x bigint, y bigint, range int, part bigint, keys array<string>, values array<binary>, kinds array<int>, tags array<array<int>>, drawings array<array<bigint>>, ends array<array<bigint>>"


def _encoded_parts(names: list[str], coalesce: bool, most: int):
    """Sorted features of tiles to parts of layers, a part at a time."""

    def run(batches):
        from pyspark import TaskContext

        at, layer, seen, part, made = None, Layer(coalesce), 0, 0, TaskContext.get().partitionId()

        def row():
            f = layer.features
            one = [*at, made, part, list(layer.keys), list(layer.values), *([x[i] for x in f] for i in range(3)), [list(x[3]) for x in f]]
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(one, PARTIAL, strict=True)], schema=PARTIAL)

        for b in batches:
            for r in b.to_pylist():
                tile = (r["z"], r["x"], r["y"])
                if tile != at or seen == most:
                    if layer.features:
                        yield row()
                        part += 1
                    at, layer, seen = tile, Layer(coalesce), 0
                layer.draw(r["clipped"], {k: r[k] for k in names}, *tile)
                seen += 1
        if layer.features:
            yield row()

    return run


def _joined_parts(layer: str, coalesce: bool):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("range", "ascending"), ("part", "ascending")])
        whole = Layer(coalesce)
        for b in t.to_batches(max_chunksize=1):
            r = b.to_pylist()[0]
            whole.extend(r["keys"], r["values"], zip(r["kinds"], r["tags"], r["drawings"], r["ends"], strict=True))
        z, x, y = (t.column(k)[0].as_py() for k in ("z", "x", "y"))
        return pa.table({"z": pa.array([z], pa.int32()), "x": [x], "y": [y], "layer": [layer], "n": [len(whole.features)], "payload": pa.array([whole.encode(layer)], pa.binary())})

    return run


def tile_layer(df: DataFrame, layer: str, min_zoom: int, max_zoom: int, attributes: list[str], filters: dict | None = None, simplify: bool = True, shared_borders: bool = False, hilbert_order: bool = False, coalesce: bool = False, part: int = PART) -> DataFrame:
    """Tiles of one layer: geometry in degrees, attributes as named (none: geometry alone), a JSON filter by zoom.

    Features of a tile stand in an order of their hash, or along a Hilbert curve over the tile; with ``coalesce``, neighbours in
    that order with equal attributes become one.  With ``shared_borders``, polygons are simplified along common borders alike,
    whose parting points are found once for all zooms.  Features are clipped, written, sorted by ranges of (tile, order)
    and encoded where they lie, in parts of at most ``part`` features with dictionaries of their own; then the parts of a tile
    are joined by renumbering tags.  So a tile that holds everything is many parts, and what meets in one task is its payload.
    """
    df = df.where(F.col("geometry").isNotNull() & ~jts.is_empty("geometry")).withColumn("plane", jts.to_3857("geometry"))
    df = with_junctions(df, "plane") if simplify and shared_borders else df.withColumn("__junctions", F.lit(None).cast("array<double>"))
    df = df.withColumn("z", F.explode(F.sequence(F.lit(min_zoom), F.lit(max_zoom)))).where(compile_filter(filters, layer, F.col("z"), df.columns))
    df = df.select("z", *attributes, "plane", "__junctions")
    pixel = F.lit(AROUND) / F.pow(F.lit(2.0), F.col("z")) / EXTENT
    if simplify:
        coarse = jts.make_valid(jts.simplify_arcs("plane", "__junctions", pixel * 8)) if shared_borders else jts.simplify("plane", pixel * 8)
        df = df.withColumn("plane", F.when(F.col("z") < max_zoom, coarse).otherwise(F.col("plane")))
    side = F.lit(AROUND) / F.pow(F.lit(2.0), F.col("z"))
    most = F.pow(F.lit(2.0), F.col("z")).cast("long") - 1
    m = side * MARGIN / EXTENT
    box = jts.bbox("plane")
    df = df.withColumn("box", box)
    at = lambda i: F.get("box", F.lit(i))
    clamp = lambda v: F.greatest(F.least(F.floor(v).cast("long"), most), F.lit(0).cast("long"))
    xs = F.sequence(clamp((at(0) - m + HALF) / side), clamp((at(2) + m + HALF) / side))
    ys = F.sequence(clamp((HALF - at(3) - m) / side), clamp((HALF - at(1) + m) / side))
    df = df.withColumn("x", F.explode(xs)).withColumn("y", F.explode(ys))
    left, top = F.col("x") * side - HALF, F.lit(HALF) - F.col("y") * side
    corner = lambda dx, dy: F.format_string("%.3f %.3f", left + dx, top + dy)
    ring = F.concat(F.lit("POLYGON(("), F.concat_ws(",", corner(-m, m), corner(side + m, m), corner(side + m, -side - m), corner(-m, -side - m), corner(-m, m)), F.lit("))"))
    df = df.withColumn("clipped", jts.intersection("plane", jts.from_wkt(ring))).where(~jts.is_empty("clipped"))
    order = F.lit(0).cast("long")
    if hilbert_order:
        middle = lambda i, j, low: cell_of((F.get("box", F.lit(i)) + F.get("box", F.lit(j))) / 2, low, side, ORDER)
        df = df.withColumn("box", jts.bbox("clipped"))
        order = hilbert(middle(0, 2, left), middle(1, 3, top - side), ORDER)
    df = cut(df.select("z", "x", "y", "clipped", order.alias("order"), F.xxhash64("clipped", *attributes).alias("rank"), *attributes), "clipped")
    by = ["z", "x", "y", "order", "rank"]
    df = df.repartitionByRange(*by).sortWithinPartitions(*by).select("z", "x", "y", "clipped", *attributes)
    return df.mapInArrow(_encoded_parts(attributes, coalesce, part), PARTIAL_SCHEMA).groupBy("z", "x", "y").applyInArrow(_joined_parts(layer, coalesce), SCHEMA)


def join_tiles(*layers: DataFrame) -> DataFrame:
    """Layers of a tile, in the order of their names, as one payload."""
    from functools import reduce

    every = reduce(DataFrame.unionByName, layers)
    ordered = F.array_sort(F.collect_list(F.struct("layer", "payload")))
    return every.groupBy("z", "x", "y").agg(F.sum("n").alias("n"), F.aggregate(ordered, F.lit(b"").cast("binary"), lambda a, v: F.concat(a, v["payload"])).alias("payload"))


def trim_zoom(tiles: DataFrame, most: int) -> DataFrame:
    return tiles.where(F.col("z") <= most)
