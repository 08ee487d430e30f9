"""FlatGeobuf files by Spark's data source interface: a file per task, each with a packed Hilbert R-tree of its own.

``write_flatgeobuf`` sorts the rows by ranges of their place on a Hilbert curve, so that neighbours lie in one file and beside each other
in it.  A task encodes its features into a spool, those of one layout (points, properties that are null, their lengths) at once,
keeps a box and a size of each, and then lays header, tree and features down as one file, under another name until all tasks are
done.  ``read_flatgeobuf`` with a box opens the files whose envelope it
meets, walks their trees and reads only the features that may meet it.  Files are opened by pyarrow's file systems, so the
path can be any that these know.  Rows without geometry, or with an empty one, are left out, since a tree has no place for
them; collections are not supported.
"""

from __future__ import annotations

import struct
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..functions import jts
from ..functions.curves import cell_of
from ..operators.graph import cut
from .mvt import parts

# The format's first bytes, types of columns and geometries.
MAGIC = b"fgb\x03fgb\x00"
BOOL, INT, LONG, FLOAT, DOUBLE, STRING, BINARY = 2, 5, 7, 9, 10, 11, 14
NODE = 16
ITEM = np.dtype([("box", "<f8", 4), ("offset", "<u8")])
KINDS = {"boolean": (BOOL, "<?"), "int": (INT, "<i"), "bigint": (LONG, "<q"), "float": (FLOAT, "<f"), "double": (DOUBLE, "<d"), "string": (STRING, None), "binary": (BINARY, None)}
ORDER = 16


class Table(dict):
    """Slots of a table: (format, number), a string, (format, array), a table or a list of tables."""


def buffer(root: Table) -> bytes:
    """The tables as one flat buffer: a table comes before what it refers to."""
    out = bytearray(4)

    def pad(n: int, ahead: int = 0) -> None:
        out.extend(b"\0" * (-(len(out) + ahead) % n))

    def refer(at: int, to: int) -> None:
        struct.pack_into("<I", out, at, to - at)

    def put(x) -> int:
        if isinstance(x, str):
            pad(4)
            at, raw = len(out), x.encode()
            out.extend(struct.pack("<I", len(raw)) + raw + b"\0")
            return at
        if isinstance(x, tuple):
            data = np.ascontiguousarray(x[1], x[0])
            pad(max(4, data.itemsize), 4)
            at = len(out)
            out.extend(struct.pack("<I", len(data)) + data.tobytes())
            return at
        if isinstance(x, list):
            pad(4)
            at = len(out)
            out.extend(struct.pack("<I", len(x)) + b"\0" * 4 * len(x))
            for k, y in enumerate(x):
                refer(at + 4 + 4 * k, put(y))
            return at
        scalar = {k: v for k, v in x.items() if isinstance(v, tuple) and not hasattr(v[1], "__len__")}
        width = {k: struct.calcsize(scalar[k][0]) if k in scalar else 4 for k in x}
        place, size = {}, 4
        for k in sorted(x, key=lambda k: -width[k]):
            size += -size % width[k]
            place[k] = size
            size += width[k]
        slots = max(x, default=-1) + 1
        pad(8, 4 + 2 * slots)
        first = len(out)
        out.extend(struct.pack(f"<{2 + slots}H", 4 + 2 * slots, size, *(place.get(k, 0) for k in range(slots))))
        at = len(out)
        out.extend(struct.pack("<i", at - first) + b"\0" * (size - 4))
        for k, (how, v) in scalar.items():
            struct.pack_into(how, out, at + place[k], v)
        for k, v in x.items():
            if k not in scalar:
                refer(at + place[k], put(v))
        return at

    refer(0, put(root))
    return bytes(out)


class View:
    """Reads a table of a flat buffer."""

    def __init__(self, raw, at: int | None = None):
        self.raw, self.at = raw, at if at is not None else struct.unpack_from("<I", raw)[0]

    def _place(self, slot: int) -> int:
        first = self.at - struct.unpack_from("<i", self.raw, self.at)[0]
        if 4 + 2 * slot >= struct.unpack_from("<H", self.raw, first)[0]:
            return 0
        off = struct.unpack_from("<H", self.raw, first + 4 + 2 * slot)[0]
        return self.at + off if off else 0

    def number(self, slot: int, how: str, other=0):
        at = self._place(slot)
        return struct.unpack_from(how, self.raw, at)[0] if at else other

    def _target(self, slot: int) -> int:
        at = self._place(slot)
        return at + struct.unpack_from("<I", self.raw, at)[0] if at else 0

    def begin(self, slot: int) -> int:
        """Where the values of an array begin."""
        return self._target(slot) + 4

    def array(self, slot: int, how: str) -> np.ndarray:
        at = self._target(slot)
        return np.frombuffer(self.raw, how, struct.unpack_from("<I", self.raw, at)[0], at + 4) if at else np.zeros(0, how)

    def string(self, slot: int) -> str:
        return self.array(slot, "u1").tobytes().decode()

    def table(self, slot: int) -> View | None:
        at = self._target(slot)
        return View(self.raw, at) if at else None

    def tables(self, slot: int) -> list[View]:
        at = self._target(slot)
        n = struct.unpack_from("<I", self.raw, at)[0] if at else 0
        return [View(self.raw, p + struct.unpack_from("<I", self.raw, p)[0]) for p in range(at + 4, at + 4 + 4 * n, 4)]


def geometry_table(wkb: bytes) -> tuple[Table, np.ndarray]:
    """Geometry and its box; a geometry of several parts is of the multiple type."""
    kind, every = parts(wkb)
    xy = lambda lines: np.array([v for line in lines for p in line for v in p], "<f8")
    flat = xy([line for part in every for line in part]).reshape(-1, 2)
    box = np.concatenate([flat.min(0), flat.max(0)])
    ends = lambda lines: ("<u4", np.cumsum([len(line) for line in lines]))

    def polygon(rings) -> Table:
        return Table({1: ("<f8", xy(rings)), 6: ("<B", 3)} | ({0: ends(rings)} if len(rings) > 1 else {}))

    if kind == 3:
        return (polygon(every[0]) if len(every) == 1 else Table({6: ("<B", 6), 7: [polygon(p) for p in every]})), box
    lines = [line for part in every for line in part]
    one = Table({1: ("<f8", xy(lines)), 6: ("<B", kind if len(every) == 1 else kind + 3)})
    return (one | {0: ends(lines)} if kind == 2 and len(lines) > 1 else one), box


def to_wkb(g: View) -> bytes:
    """Well-known bytes of a geometry."""
    kind, xy, ends = g.number(6, "<B"), g.array(1, "<f8"), g.array(0, "<u4").tolist()
    lines = [xy[2 * a : 2 * b] for a, b in zip([0, *ends], ends)] or [xy]
    head = lambda k: struct.pack("<BI", 1, k)
    counted = lambda line: struct.pack("<I", len(line) // 2) + line.tobytes()
    if kind == 6:
        of = g.tables(7)
        return head(6) + struct.pack("<I", len(of)) + b"".join(_polygon(p, head, counted) for p in of)
    if kind == 3:
        return _polygon(g, head, counted)
    if kind == 1:
        return head(1) + xy.tobytes()
    if kind == 2:
        return head(2) + counted(xy)
    if kind == 4:
        return head(4) + struct.pack("<I", len(xy) // 2) + b"".join(head(1) + xy[k : k + 2].tobytes() for k in range(0, len(xy), 2))
    return head(5) + struct.pack("<I", len(lines)) + b"".join(head(2) + counted(line) for line in lines)


def _polygon(g: View, head, counted) -> bytes:
    xy, ends = g.array(1, "<f8"), g.array(0, "<u4").tolist()
    rings = [xy[2 * a : 2 * b] for a, b in zip([0, *ends], ends)] or [xy]
    return head(3) + struct.pack("<I", len(rings)) + b"".join(map(counted, rings))


def properties(row: dict, columns: list[tuple[str, str]]) -> bytes:
    out = []
    for k, (name, kind) in enumerate(columns):
        v = row[name]
        if v is None:
            continue
        how = KINDS[kind][1]
        raw = v.encode() if isinstance(v, str) else v
        out.append(struct.pack("<H", k) + (struct.pack(how, v) if how else struct.pack("<I", len(raw)) + raw))
    return b"".join(out)


def read_properties(raw: bytes, columns: list[tuple[str, str]]) -> dict:
    out, at = {name: None for name, _ in columns}, 0
    while at < len(raw):
        name, kind = columns[struct.unpack_from("<H", raw, at)[0]]
        how, at = KINDS[kind][1], at + 2
        if how:
            out[name], at = struct.unpack_from(how, raw, at)[0], at + struct.calcsize(how)
        else:
            n = struct.unpack_from("<I", raw, at)[0]
            v, at = bytes(raw[at + 4 : at + 4 + n]), at + 4 + n
            out[name] = v.decode() if kind == "string" else v
    return out


FEW, PIECE = 4, 1 << 22  # rows of one layout below which they go one by one; bytes of rows taken at once


def _bytes(column: pa.Array, how: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a column, where each value begins and its length (-1: null)."""
    none = column.is_null().to_numpy(zero_copy_only=False)
    if how:
        values = np.ascontiguousarray(column.fill_null(False if how == "<?" else 0).to_numpy(zero_copy_only=False), how)
        return values.view("u1"), np.arange(len(column)) * values.itemsize, np.where(none, -1, values.itemsize)
    x = column.cast(pa.large_binary())
    at = np.frombuffer(x.buffers()[1], "<i8")[x.offset : x.offset + len(x) + 1]
    return np.frombuffer(x.buffers()[2] or b"", "u1"), at[:-1], np.where(none, -1, np.diff(at))


def _simple(heads: np.ndarray) -> np.ndarray:
    """Type * 2 + byte order of points, lines and polygons of one ring, whose length tells their points; 0: others."""
    out = np.zeros(len(heads), np.int64)
    for order, end in enumerate("><"):
        for kind in (1, 2, 3):
            want = np.frombuffer(struct.pack(f"{end}BI" + "I" * (kind == 3), order, kind, *[1] * (kind == 3)), "u1")
            out[(heads[:, : len(want)] == want).all(1)] = kind * 2 + order
    return out


def _feature(g: Table, raw: bytes | np.ndarray) -> bytes:
    return buffer(Table({0: g, 1: ("<u1", np.frombuffer(raw, "u1"))}))


def _alike(simple: int, wkb: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of one layout and their boxes, from rows of bytes of shapes and properties: the first one's buffer, refilled."""
    xy = np.ascontiguousarray(wkb[:, 1 + 4 * (simple // 2) :]).view("<f8" if simple % 2 else ">f8").astype("<f8")
    first = _feature(geometry_table(wkb[0].tobytes())[0], np.ascontiguousarray(raw[0]))
    v = View(first)
    out = np.tile(np.frombuffer(struct.pack("<I", len(first)) + first, "u1"), (len(wkb), 1))
    for at, data in ((v.table(0).begin(1), xy.view("u1")), (v.begin(1), raw)):
        out[:, 4 + at : 4 + at + data.shape[1]] = data
    xy = xy.reshape(len(xy), -1, 2)
    return out, np.concatenate([xy.min(1), xy.max(1)], 1)


def encode(batch: pa.RecordBatch, columns: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, set[int]]:
    """The features of some rows one after the other, their boxes, sizes and types."""
    n = batch.num_rows
    wkb, at, length = _bytes(batch.column("geometry"), None)
    cells = [_bytes(batch.column(name), KINDS[kind][1]) for name, kind in columns]
    simple = _simple(wkb[at[:, None] + np.arange(9)])
    group = np.unique(np.stack([simple, length, *(x[2] for x in cells)], 1), axis=0, return_inverse=True)[1].reshape(-1)
    order = np.argsort(group, kind="stable")
    boxes, sizes, kinds, made, alone = np.empty((n, 4)), np.empty(n, np.int64), set(), [], []
    for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        one = rows[0]
        if not simple[one] or len(rows) < FEW:
            alone += rows.tolist()
            continue
        raw = [np.zeros((len(rows), 0), "u1")]
        for k, ((_, kind), (data, begin, size)) in enumerate(zip(columns, cells, strict=True)):
            if size[one] >= 0:
                head = struct.pack("<H", k) + (b"" if KINDS[kind][1] else struct.pack("<I", size[one]))
                raw += [np.tile(np.frombuffer(head, "u1"), (len(rows), 1)), data[begin[rows][:, None] + np.arange(size[one])]]
        m, boxes[rows] = _alike(int(simple[one]), wkb[at[rows][:, None] + np.arange(length[one])], np.concatenate(raw, 1))
        sizes[rows] = m.shape[1]
        kinds.add(int(simple[one]) // 2)
        made.append((rows, m))
    for r, row in zip(alone, batch.take(pa.array(alone, pa.int64())).to_pylist(), strict=True):
        g, boxes[r] = geometry_table(row["geometry"])
        raw = _feature(g, properties(row, columns))
        sizes[r] = 4 + len(raw)
        kinds.add(g[6][1])
        made.append((np.array([r]), np.frombuffer(struct.pack("<I", len(raw)) + raw, "u1")[None]))
    starts, out = np.cumsum(sizes) - sizes, np.empty(sizes.sum(), "u1")
    for rows, m in made:
        out[starts[rows][:, None] + np.arange(m.shape[1])] = m
    return out, boxes, sizes, kinds


def levels(n: int) -> list[int]:
    """Nodes of each level of a tree over n leaves, from the leaves up."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // NODE))
    return out if n > 1 else [1, 1]


def packed_tree(boxes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Nodes root first: those above hold the place of their first child."""
    sizes = levels(len(boxes))
    starts = np.cumsum([0, *sizes[::-1]])[:-1][::-1]  # of each level, from the leaves up
    tree = np.zeros(sum(sizes), ITEM)
    tree["box"][starts[0] : starts[0] + sizes[0]], tree["offset"][starts[0] : starts[0] + sizes[0]] = boxes, offsets
    for k in range(1, len(sizes)):
        below = tree["box"][starts[k - 1] : starts[k - 1] + sizes[k - 1]]
        first = np.arange(0, sizes[k - 1], NODE)
        here = slice(starts[k], starts[k] + sizes[k])
        tree["box"][here] = np.concatenate([np.minimum.reduceat(below[:, :2], first), np.maximum.reduceat(below[:, 2:], first)], 1)
        tree["offset"][here] = starts[k - 1] + first
    return tree


def search(tree: np.ndarray, n: int, box: tuple[float, float, float, float]) -> np.ndarray:
    """Offsets of the leaves whose boxes meet the box, ascending."""
    sizes = levels(n)
    starts = np.cumsum([0, *sizes[::-1]])[:-1][::-1]
    at = np.array([0])
    for k in range(len(sizes) - 1, -1, -1):
        b = tree["box"][at]
        at = at[(b[:, 0] <= box[2]) & (b[:, 2] >= box[0]) & (b[:, 1] <= box[3]) & (b[:, 3] >= box[1])]
        if k:
            first = tree["offset"][at].astype(np.int64)
            ends = np.minimum(first + NODE, starts[k - 1] + sizes[k - 1])
            at = np.concatenate([np.arange(a, e) for a, e in zip(first, ends)]) if len(at) else np.zeros(0, np.int64)
    return np.sort(tree["offset"][at])


class Done(WriterCommitMessage):
    def __init__(self, path: str | None):
        self.path = path


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, name: str, code: int):
        self.path, self.name, self.code = path.rstrip("/"), name, code
        self.columns = [(f.name, f.dataType.simpleString()) for f in schema if f.name != "geometry"]

    def _open(self):
        return pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Done:
        boxes, sizes, kinds = [], [], set()
        with tempfile.TemporaryFile() as spool:
            for batch in iterator:
                step = max(1, batch.num_rows * PIECE // max(batch.nbytes, PIECE))
                for k in range(0, batch.num_rows, step):
                    raw, box, size, kind = encode(batch.slice(k, step), self.columns)
                    spool.write(raw)
                    boxes.append(box), sizes.append(size), kinds.update(kind)
            if not boxes:
                return Done(None)
            every, size = np.concatenate(boxes), np.concatenate(sizes)
            column = lambda n, k: Table({0: n, 1: ("<B", KINDS[k][0])})
            header = Table({0: self.name, 1: ("<f8", np.concatenate([every[:, :2].min(0), every[:, 2:].max(0)])), 2: ("<B", kinds.pop() if len(kinds) == 1 else 0), 8: ("<Q", len(every)), 9: ("<H", NODE), 10: Table({0: "EPSG", 1: ("<i", self.code)})})
            if self.columns:
                header[7] = [column(n, k) for n, k in self.columns]
            head = buffer(header)
            tree = packed_tree(every, (np.cumsum(size) - size).astype("<u8"))
            files, top = self._open()
            files.create_dir(top, recursive=True)
            at = f"{top}/.part-{uuid.uuid4().hex}.fgb"
            spool.seek(0)
            with files.open_output_stream(at) as f:
                f.write(MAGIC + struct.pack("<I", len(head)) + head + tree.tobytes())
                while piece := spool.read(1 << 22):
                    f.write(piece)
        return Done(at)

    def commit(self, messages) -> None:
        files, _ = self._open()
        for m in messages:
            if m is not None and m.path:
                files.move(m.path, m.path.replace("/.part-", "/part-"))

    def abort(self, messages) -> None:
        files, _ = self._open()
        for m in messages:
            if m is not None and m.path:
                files.delete_file(m.path)


class File(InputPartition):
    pass


def read_header(f) -> tuple[View, list[tuple[str, str]], int]:
    """Header, columns, and where the tree begins."""
    if f.read(8) != MAGIC:
        raise ValueError("not a FlatGeobuf file")
    n = struct.unpack("<I", f.read(4))[0]
    h = View(f.read(n))
    names = {v[0]: k for k, v in KINDS.items()}
    return h, [(x.string(0), names[x.number(1, "<B")]) for x in h.tables(7)], 12 + n


class Reader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, box: tuple[float, ...] | None):
        self.path, self.box = path.rstrip("/"), box
        self.names = [f.name for f in schema]

    def _open(self):
        return pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)

    def partitions(self):
        files, top = self._open()
        found = [x.path for x in files.get_file_info(pafs.FileSelector(top)) if x.path.endswith(".fgb") and "/.part-" not in x.path]
        return [File(x) for x in sorted(found)]

    def read(self, partition):
        files, _ = self._open()
        with files.open_input_file(partition.value) as f:
            h, columns, at = read_header(f)
            e, n = h.array(1, "<f8"), h.number(8, "<Q")
            if self.box and not (e[0] <= self.box[2] and e[2] >= self.box[0] and e[1] <= self.box[3] and e[3] >= self.box[1]):
                return
            size = sum(levels(n)) * ITEM.itemsize
            tree = np.frombuffer(f.read(size), ITEM)
            begin = at + size
            for off in search(tree, n, self.box or tuple(e)).tolist():
                f.seek(begin + off)
                feature = View(f.read(struct.unpack("<I", f.read(4))[0]))
                row = read_properties(feature.array(1, "u1").tobytes(), columns) | {"geometry": to_wkb(feature.table(0))}
                yield tuple(row[k] for k in self.names)


class FlatGeobuf(DataSource):
    @classmethod
    def name(cls) -> str:
        return "flatgeobuf"

    def schema(self) -> str:
        files, top = Reader(self.options["path"], T.StructType(), None)._open()
        first = next(x.path for x in files.get_file_info(pafs.FileSelector(top)) if x.path.endswith(".fgb"))
        with files.open_input_file(first) as f:
            columns = read_header(f)[1]
        return ", ".join([*(f"`{n}` {k}" for n, k in columns), "geometry binary"])

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], schema, self.options.get("name", ""), int(self.options.get("crs", "4326")))

    def reader(self, schema: T.StructType) -> Reader:
        box = self.options.get("box")
        return Reader(self.options["path"], schema, tuple(map(float, box.split(","))) if box else None)


def write_flatgeobuf(df: DataFrame, path: str, name: str = "", crs: int = 4326) -> None:
    """Columns of plain types and ``geometry`` (WKB) to a folder of files.

    The envelope, the ranges of the sort and the sort itself each read the rows, which are therefore made once and written to the
    shared folder first.
    """
    df.sparkSession.dataSource.register(FlatGeobuf)
    df = cut(jts.with_box(df), "features").where("geometry is not null and xmin <= xmax")  # an empty one has no box
    low = df.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    span = F.lit(max(low[2] - low[0], low[3] - low[1]) or 1.0) if low[0] is not None else F.lit(1.0)
    at = lambda a, b, v: cell_of((F.col(a) + F.col(b)) / 2, F.lit(v or 0.0), span, ORDER)
    df = df.withColumn("__at", jts.hilbert(at("xmin", "xmax", low[0]), at("ymin", "ymax", low[1]), ORDER))
    df = df.repartitionByRange("__at").sortWithinPartitions("__at").drop("xmin", "ymin", "xmax", "ymax", "__at")
    df.write.format("flatgeobuf").mode("append").option("path", path).option("name", name).option("crs", str(crs)).save()


def read_flatgeobuf(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """The features of a folder of files; with a box (xmin, ymin, xmax, ymax) those whose own boxes meet it."""
    spark.dataSource.register(FlatGeobuf)
    r = spark.read.format("flatgeobuf").option("path", path)
    return (r.option("box", ",".join(map(str, box))) if box else r).load()
