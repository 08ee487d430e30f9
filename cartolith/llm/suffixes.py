"""Suffix-array deduplication (operator 6): prefix doubling over the positions that a content-chosen filter leaves.

Every byte covered by a string of ``LENGTH`` bytes that starts anywhere else too is removed.  Plain prefix doubling sorts a
rank pair for each byte of the corpus in each round; here most positions are settled before:

1. A window of 200 bytes is represented by its least 64-byte gram (least hash, the leftmost of equals), a choice that
   depends on the window's bytes alone, so equal windows have equal grams at equal offsets.  Consecutive windows share
   grams; there is about one for 70 bytes.  Grams are counted; windows of a unique gram are unique and leave.
2. For each repeated gram, the string over all windows it represents is named.  Where that name occurs again, all
   these windows are repeats; this settles the inside of shared passages.
3. What is left lies at the ends of shared passages.  Sets of 32 and then 8 adjoining windows are settled when the string
   over all of a set occurs again, and leave when the string common to all of it does not; one of each group of settled
   equals stays as a partner for the others.
4. The windows that remain go through prefix doubling.  A position starts with the pair of digests of its first and second 32
   bytes; in each round equal pairs at equal distance from equal grams get one rank, positions of a unique pair leave,
   and the rank is paired with that of the position 64 and then 72 bytes on, until ranks stand for 200 bytes.  A window
   whose last rank is shared is a repeat.  So the result is exact, up to collisions of digests.

Null texts are empty; texts shorter than a window keep all bytes; each row is judged by its own text, also where rows
share a doc_id or have none, and equal rows are copies of each other; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp as tn
from .common import Written, table

LENGTH, GRAM = 200, 64
OFFSETS = LENGTH - GRAM + 1
#: Windows of a set in each round of step 3.
ROUNDS = (32, 8)
#: Bytes of the digests that the first ranks are made of.
FIRST = 32
KEY = ["k1", "k2"]


def anchors(buf: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """Hash, position, first and last window of the grams that represent windows, and their rows (positions in the piece)."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(np.uint64), none, none, none, none
    roll = tn.Quick(tn.codes(31)[buf])
    at = np.arange(n - gram + 1)
    h = roll.of(at, at + gram)
    low = (h >> np.uint64(31) << np.uint64(31)) | at.astype(np.uint64)
    reach = length - gram + 1
    k = 1
    while k * 2 <= reach:
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    if reach > k:
        low = np.minimum(low[: len(low) - (reach - k)], low[reach - k :])
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(low)]
    start = np.flatnonzero(np.arange(len(low)) + length <= offs[1:][row])
    if not len(start):
        return none.astype(np.uint64), none, none, none, none
    of = (low[start] & np.uint64((1 << 31) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    lo, hi = start[new], start[np.concatenate([new[1:], [len(start)]]) - 1]
    return h[of[new]], of[new], lo, hi, row[lo]


def _grams(length: int, gram: int):
    def run(batches):
        for b in batches:
            for _, buf, offs in tn.pieces(b.column(0)):
                yield pa.RecordBatch.from_arrays([tn.as_long(anchors(buf, offs, length, gram)[0])], ["h"])

    return run


def _named(length: int, gram: int):
    def run(batches):
        for b in batches:
            for first, buf, offs in tn.pieces(b.column(2)):
                h, at, lo, hi, row = anchors(buf, offs, length, gram)
                if len(h):
                    name = tn.Rolling(tn.codes(32)[buf], tn.BASE_B).of(lo, hi + length)
                    base = offs[row]
                    yield pa.RecordBatch.from_arrays(
                        [tn.as_long(h), tn.as_long(name), *(b.column(k).take(pa.array(row + first)) for k in (0, 1)), *(pa.array((x - base).astype(np.int32)) for x in (at, lo, hi))],
                        ["h", "name", *KEY, "at", "lo", "hi"],
                    )

    return run


def _contexts(length: int, gram: int):
    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            out: dict[str, list] = {k: [] for k in CONTEXT.names}
            for k1, k2, text, found in zip(t.column("k1").to_pylist(), t.column("k2").to_pylist(), t.column("text").to_pylist(), t.column("found").to_pylist(), strict=True):
                raw = (text or "").encode()
                for x in found:
                    if x["hi"] + length <= len(raw):
                        left = min(x["at"], length - gram)
                        for k, v in (("h", x["h"]), ("k1", k1), ("k2", k2), ("at", x["at"]), ("lo", x["lo"]), ("hi", x["hi"]), ("weight", x["weight"]), ("left", left), ("bytes", raw[x["at"] - left : x["at"] + length])):
                            out[k].append(v)
                if len(out["h"]) > 5000:
                    yield pa.RecordBatch.from_pydict(out, CONTEXT)
                    out = {k: [] for k in out}
            yield pa.RecordBatch.from_pydict(out, CONTEXT)

    return run


CONTEXT = pa.schema([("h", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("weight", pa.int32()), ("left", pa.int32()), ("bytes", pa.binary())])


def _kept(length: int):
    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                raw = (text or "").encode()
                spans: list[list[int]] = []
                for x in sorted((x["lo"], min(x["hi"] + length, len(raw))) for x in found or ()):
                    if spans and x[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], x[1])
                    else:
                        spans.append([*x])
                left, p = hashlib.sha256(), 0
                for x, y in spans:
                    left.update(raw[p:x])
                    p = y
                left.update(raw[p:])
                rows.append((doc_id, len(raw), sum(y - x for x, y in spans), len(spans), left.hexdigest(), [{"start": x, "end": y} for x, y in spans]))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [b.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def levels(length: int) -> list[tuple[int, int, list[int]]]:
    """Bytes of a rank's two halves, offset of the second, and the offsets in a window at which such ranks are needed."""
    most = FIRST
    while most * 2 < length:
        most *= 2
    out, need, step = [(most, length - most, [0])], [0, length - most], most // 2
    while step >= FIRST:
        out.append((step, step, need))
        need, step = sorted({*need, *(x + step for x in need)}), step // 2
    return out[::-1]


def _pairs(length: int):
    """First rank pairs of the positions that windows of open sets need: pos counts from the gram, own is the weight of a window that starts there."""
    offsets = np.array(levels(length)[0][2])

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            ids, h, gram, lo, hi, left = (t.column(k).to_numpy() for k in ("id", "h", "at", "lo", "hi", "left"))
            sets = t.column("sets").combine_chunks()
            upto, flat = sets.offsets.to_numpy() - sets.offsets[0].as_py(), sets.flatten()
            d1, d2, weight = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("d1", "d2", "weight"))
            of = np.repeat(np.arange(len(ids)), np.diff(upto))
            for first, buf, offs in tn.pieces(t.column("bytes")):
                rows = len(offs) - 1
                s = slice(upto[first], upto[first + rows])
                many = d2[s] - d1[s] + 1
                row, own = np.repeat(of[s], many), np.repeat(weight[s], many)
                d = np.repeat(d1[s], many) + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                size = np.diff(offs)[row - first]
                ok = (d <= gram[row] - lo[row]) & (d >= gram[row] - hi[row]) & (left[row] >= d) & (left[row] - d + length <= size)
                row, own, d = row[ok], own[ok], d[ok]
                at = (left[row] - d)[:, None] + offsets
                place, back = np.unique((row[:, None].astype(np.int64) << 16 | at).reshape(-1), return_inverse=True)
                most, begins = np.zeros(len(place), np.int32), np.zeros(len(place), np.int32)
                np.maximum.at(most, back, np.repeat(own, len(offsets)))
                np.maximum.at(begins, back.reshape(-1, len(offsets))[:, 0], own)
                row, at = place >> 16, place & 0xFFFF
                x = offs[row - first] + at
                roll = tn.Rolling(tn.codes(33)[buf], tn.BASE_A)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(h[row]), pa.array((at - left[row]).astype(np.int32)), pa.array(most), pa.array(begins), tn.as_long(roll.of(x, x + FIRST)), tn.as_long(roll.of(x + FIRST, x + 2 * FIRST))],
                    ["id", "h", "pos", "weight", "own", "r1", "r2"],
                )

    return run


def doubled(contexts: DataFrame, open_sets: DataFrame, length: int) -> DataFrame:
    """(id, h, at, lo, hi, left, bytes) and (id, d1, d2, weight) -> id, pos, own of the windows whose last rank is shared."""
    sets = open_sets.groupBy("id").agg(F.collect_list(F.struct("d1", "d2", "weight")).alias("sets"))
    pairs = contexts.join(sets, "id").mapInArrow(_pairs(length), "id bigint, h bigint, pos int, weight int, own int, r1 bigint, r2 bigint")
    pairs, by = Written(pairs, "pairs"), ["h", "pos", "r1", "r2"]
    for half, _, _ in levels(length):
        last = half * 2 >= length
        weight = F.col("own") if last else F.col("weight")
        ranks = pairs.df.where(weight > 0).groupBy(*by).agg(F.sum(weight).alias("n"), F.min("id").alias("rank")).where("n > 1").drop("n")
        ranked = Written(pairs.df.join(ranks, by).select("id", "h", "pos", "weight", "own", "rank"), "ranks")
        pairs.drop()
        if last:
            return ranked.df.where("own > 0").select("id", "pos", "own")
        offset = next(second for first, second, _ in levels(length) if first == half * 2)
        ahead = ranked.df.select("id", (F.col("pos") - offset).alias("pos"), F.col("rank").alias("r2"))
        pairs = Written(ranked.df.withColumnRenamed("rank", "r1").join(ahead, ["id", "pos"]), "pairs")
        ranked.drop()


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(k1, k2, text) -> k1, k2, lo, hi: windows starting at bytes lo to hi occur elsewhere too."""
    grams = docs.select("text").mapInArrow(_grams(length, gram), "h bigint")
    twice = Written(grams.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "grams")
    named = docs.select(*KEY, "text").mapInArrow(_named(length, gram), "h bigint, name bigint, k1 bigint, k2 bigint, at int, lo int, hi int")
    cand = Written(named.join(twice.df, "h"), "candidates")
    twice.drop()
    groups = cand.df.groupBy("h", "name").agg(F.count("*").alias("c"), F.min(F.struct(*KEY, "at", "lo", "hi")).alias("x"))
    groups = Written(groups, "groups")
    inner = Written(cand.df.join(groups.df.where("c > 1").select("h", "name"), ["h", "name"], "left_semi").select(*KEY, "lo", "hi"), "inner").df
    cand.drop()
    open_ = groups.df.groupBy("h").agg(F.count("*").alias("k"), F.min("c").alias("least")).where("k > 1 and least = 1").select("h")
    edge = groups.df.join(open_, "h", "left_semi").select("x.k1", "x.k2", F.struct("h", "x.at", "x.lo", "x.hi", F.least("c", F.lit(2)).cast("int").alias("weight")).alias("found"))
    edge = Written(edge.groupBy(*KEY).agg(F.collect_list("found").alias("found")), "edges")
    groups.drop()
    texts = docs.select(*KEY, "text").join(edge.df, KEY).dropDuplicates(KEY)  # of equal rows one stands for its grams
    ctx = texts.mapInArrow(_contexts(length, gram), "h bigint, k1 bigint, k2 bigint, at int, lo int, hi int, weight int, left int, bytes binary")
    ctx = Written(ctx.withColumn("id", F.monotonically_increasing_id()), "contexts")
    edge.drop()
    # d: bytes between a window's start and its gram; a set of windows is d1 .. d2; rows of a round hold names, no bytes
    now = ctx.df.withColumns({"d1": F.lit(0), "d2": F.lit(length - gram)})
    settled, before = inner, None
    for size in ROUNDS:
        part = F.explode(F.sequence(F.col("d1"), F.col("d2"), F.lit(size))).alias("from")
        x = now.select("id", "h", *KEY, "at", "lo", "hi", "weight", "left", "bytes", F.col("d2").alias("to"), part)
        x = x.select("*", F.col("from").alias("d1"), F.least(F.col("from") + size - 1, F.col("to")).alias("d2")).drop("from", "to")
        x = x.where("d1 <= at - lo and d2 >= at - hi")
        at = lambda first, last: F.when(
            (F.col("left") >= first) & (F.col("left") - last + length <= F.length("bytes")),
            F.xxhash64(F.substring(F.col("bytes"), (F.col("left") - first + 1).cast("int"), (first - last + length).cast("int"))),
        )
        x = x.withColumns({"whole": at(F.col("d2"), F.col("d1")), "core": at(F.col("d1"), F.col("d2"))}).where("core is not null")
        x = Written(x.select("id", "h", *KEY, "at", "weight", "d1", "d2", "whole", "core"), "round")
        if before:
            before.drop()
        by = ["h", "d1", "whole"]
        equal = x.df.where("whole is not null").groupBy(*by).agg(F.sum("weight").alias("n"), F.min("id").alias("one")).where("n > 1").drop("n")
        y = Written(x.df.join(equal, by, "left").drop("whole"), "equal")
        x.drop()
        again = F.col("one").isNotNull()
        settled = settled.unionByName(y.df.where(again & (F.col("weight") == 1)).select(*KEY, (F.col("at") - F.col("d2")).alias("lo"), (F.col("at") - F.col("d1")).alias("hi")))
        by = ["h", "d1", "core"]
        cores = y.df.groupBy(*by).agg(F.sum("weight").alias("n"), F.max(~again).alias("unsettled")).where("n > 1 and unsettled").select(*by)
        before = y.df.join(cores, by, "left_semi").where(~again | (F.col("id") == F.col("one")))
        before = Written(before.select("id", F.when(again, 2).otherwise(F.col("weight")).cast("int").alias("weight"), "d1", "d2"), "open")
        now = ctx.df.drop("weight").join(before.df, "id")
    last = doubled(ctx.df.select("id", "h", "at", "lo", "hi", "left", "bytes"), before.df, length).where("own = 1")
    last = ctx.df.select("id", *KEY, "at").join(last, "id").select(*KEY, (F.col("at") + F.col("pos")).alias("lo"), (F.col("at") + F.col("pos")).alias("hi"))
    last = Written(last, "windows").df
    ctx.drop()
    before.drop()
    return settled.unionByName(last)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans: one row per row of docs."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    d = d.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(7), "text", "doc_id")})
    found = repeated_windows(d, length, gram).groupBy(F.col("k1").alias("i1"), F.col("k2").alias("i2")).agg(F.collect_set(F.struct("lo", "hi")).alias("found"))
    x = d.join(found, (d["k1"] == found["i1"]) & (d["k2"] == found["i2"]), "left").select("doc_id", "text", "found")
    return x.mapInArrow(_kept(length), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")
