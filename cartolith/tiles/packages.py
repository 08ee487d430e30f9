"""Tile packages: MBTiles databases and compact cache bundles."""

from __future__ import annotations

import gzip
import json
import os
import sqlite3
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tiles import SIDE, bundle_of, flip

SLOTS = SIDE * SIDE
#: Bytes of a bundle's header and of an index entry's offset part.
HEADER, OFFSET_BITS = 64, 40


def bundle_bytes(tiles: list[tuple[int, int, bytes]]) -> bytes:
    """A bundle of tiles (row, column, payload): header, index, payloads with their size before them."""
    index, body, at, largest = [0] * SLOTS, [], HEADER + 8 * SLOTS, 0
    for row, col, data in sorted(tiles):
        index[row % SIDE * SIDE + col % SIDE] = at + 4 | len(data) << OFFSET_BITS
        body += [struct.pack("<I", len(data)), data]
        at += 4 + len(data)
        largest = max(largest, len(data))
    head = struct.pack("<4I3Q6I", 3, SLOTS, largest, 5, 0, at, 40, 20 + 8 * SLOTS, 3, 16, SLOTS, 5, 8 * SLOTS)
    return head + struct.pack(f"<{SLOTS}Q", *index) + b"".join(body)


def bundle_tile(bundle: bytes, row: int, col: int) -> bytes | None:
    """A tile read back through the index."""
    entry = struct.unpack_from("<Q", bundle, HEADER + 8 * (row % SIDE * SIDE + col % SIDE))[0]
    at, size = entry & (1 << OFFSET_BITS) - 1, entry >> OFFSET_BITS
    return bundle[at : at + size] if size else None


def bundle_name(z: int, row: int, col: int) -> str:
    """Path of a bundle by its first row and column."""
    return f"L{z:02d}/R{row * SIDE:04x}C{col * SIDE:04x}.bundle"


def _bundled(t: pa.Table) -> pa.Table:
    z, row, col = (t.column(k)[0].as_py() for k in ("z", "bundle_row", "bundle_col"))
    tiles = list(zip(t.column("y").to_pylist(), t.column("x").to_pylist(), t.column("payload").to_pylist(), strict=True))
    return pa.table({"z": pa.array([z], pa.int32()), "name": [bundle_name(z, row, col)], "tiles": pa.array([len(tiles)], pa.int64()), "bundle": pa.array([bundle_bytes(tiles)], pa.binary())})


def to_bundles(tiles: DataFrame, max_zoom: int | None = None) -> DataFrame:
    """(z, x, y, payload), rows from the top -> (z, name, tiles, bundle): one task row per bundle."""
    t = tiles if max_zoom is None else tiles.where(F.col("z") <= max_zoom)
    t = t.select("z", "x", "y", "payload").withColumns({"bundle_row": bundle_of(F.col("y")), "bundle_col": bundle_of(F.col("x"))})
    return t.groupBy("z", "bundle_row", "bundle_col").applyInArrow(_bundled, "z int, name string, tiles bigint, bundle binary")


def write_mbtiles(tiles: DataFrame, path: str, metadata: dict[str, str]) -> None:
    """An SQLite file, written beside and renamed when whole.  Rows stream from the cluster partition by partition."""
    partial = f"{path}.partial"
    if os.path.exists(partial):
        os.remove(partial)
    db = sqlite3.connect(partial)
    db.executescript("create table metadata (name text primary key, value text); create table tiles (zoom_level integer, tile_column integer, tile_row integer, tile_data blob, primary key (zoom_level, tile_column, tile_row));")
    rows = tiles.select("z", "x", flip(F.col("y"), F.col("z")).alias("row"), "payload")
    for r in rows.toLocalIterator():
        db.execute("insert or replace into tiles values (?, ?, ?, ?)", (r["z"], r["x"], r["row"], gzip.compress(bytes(r["payload"]), mtime=0)))
    upsert(db, metadata)
    db.commit()
    db.close()
    os.replace(partial, path)


def upsert(db: sqlite3.Connection, metadata: dict[str, str]) -> None:
    db.executemany("insert or replace into metadata values (?, ?)", list(metadata.items()))


def strip_tilestats(db: sqlite3.Connection) -> None:
    row = db.execute("select value from metadata where name = 'json'").fetchone()
    if row:
        said = json.loads(row[0])
        said.pop("tilestats", None)
        upsert(db, {"json": json.dumps(said)})


def trim_mbtiles(path: str, out: str, most: int) -> None:
    """A copy without the zooms above ``most``, its metadata to match."""
    partial = f"{out}.partial"
    if os.path.exists(partial):
        os.remove(partial)
    old, new = sqlite3.connect(path), sqlite3.connect(partial)
    old.backup(new)
    old.close()
    new.execute("delete from tiles where zoom_level > ?", (most,))
    top = int(dict(new.execute("select name, value from metadata")).get("maxzoom", most))
    upsert(new, {"maxzoom": str(min(most, top))})
    new.commit()
    new.close()
    os.replace(partial, out)


def read_mbtiles(path: str) -> tuple[dict[str, str], list[tuple[int, int, int, bytes]]]:
    """Metadata and tiles (z, x, y from the top, payload)."""
    db = sqlite3.connect(path)
    meta = dict(db.execute("select name, value from metadata"))
    tiles = [(z, x, 2**z - 1 - r, gzip.decompress(d)) for z, x, r, d in db.execute("select zoom_level, tile_column, tile_row, tile_data from tiles order by 1, 2, 3")]
    db.close()
    return meta, tiles


def common_crs(metadata: list[dict[str, str]], key: str = "crs") -> str:
    """The one coordinate system of all inputs."""
    found = {m.get(key, "EPSG:3857") for m in metadata}
    if len(found) != 1:
        raise ValueError(f"inputs differ in {key}: {sorted(found)}")
    return found.pop()
