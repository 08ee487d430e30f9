"""Substring deduplication (operator 2): content-defined chunks by a gear rolling hash, deduplicated by digest.

The gear hash of the last 32 bytes is taken at the end of each word (and at every eighth byte or so of a word past 32
bytes); a chunk ends at the last least hash of any 17 such places in a row.  So boundaries depend on nearby content only,
come about every 9 words and fall back in step after any insertion; a stretch without one is cut every 1024 bytes.
Chunks are counted by a 128-bit BLAKE2 digest of them and the 32 bytes before over the whole corpus.

A repeated passage of over 50 words has 35 places or more whose 32 bytes lie inside it, so two ends of chunks and a whole
chunk between them are the same in each copy: no such passage is without a repeated chunk.  Where repeated chunks begin or
end in a document, or go over to those of another first document, the windows of 51 words there, and those about the same
chunks elsewhere, are counted by digest in turn, which gives the passages to their last word.  What repeated windows cover,
and adjoining repeated chunks of ``least`` bytes or more, is removed except for the first occurrence in the corpus
(smallest doc_id, then position).  Shorter repeats, such as single common lines, stay.

Null texts stay null, empty ones empty; rows without doc_id keep their text; rows that share a doc_id are judged by their
own text and count as occurrences in one document, so they do not remove each other; an empty table gives an empty result; extra columns are passed through, those named like the added ones are replaced.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnp as tn
from .common import Written, table

REACH = 32
LONGEST = 1024
#: Places of which one ends a chunk: two in a row fit into 51 words less the 16 that 32 bytes take at most.
PLACES = 17
#: Words of the shortest passage.
WORDS = 51
#: Bytes of adjoining repeated chunks that are removed without a repeated window.
LEAST = 120


def chunks(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the chunks of a piece."""
    n, rows = len(buf), len(offs) - 1
    size = np.diff(offs)
    row = np.repeat(np.arange(rows), size)
    at = np.arange(n) - offs[:-1][row]
    h = tn.gear(buf)
    ok = at >= REACH - 1
    ok[:-1] &= (buf[1:] & 0xC0) != 0x80
    first, last, _ = tn.runs(~tn.spaces()[buf], offs)
    place = np.zeros(n, bool)
    place[last - 1] = True
    for s, e in zip(first[last - first > REACH], last[last - first > REACH]):
        w = h[s:e]
        fresh = (w[REACH:] & 7) == 0
        for k in range(1, REACH):  # none in text of a short period
            fresh &= w[REACH:] != w[REACH - k : -k]
        place[s + REACH : e] |= fresh
    place = np.flatnonzero(place & ok)
    cut = np.zeros(n, bool)
    if len(place) >= PLACES:
        view = np.lib.stride_tricks.sliding_window_view(h[place], PLACES)
        low = np.arange(len(view)) + PLACES - 1 - view[:, ::-1].argmin(axis=1)
        cut[place[low[row[place[: len(view)]] == row[place[PLACES - 1 :]]]]] = True
    cut[offs[1:][size > 0] - 1] = True
    end = np.flatnonzero(cut) + 1
    start = np.concatenate([[0], end[:-1]]) if len(end) else end
    long = np.flatnonzero(end - start > LONGEST)
    if len(long):
        more = []
        for i in long:
            p = start[i] + LONGEST
            while p < end[i]:
                q = p
                while q > start[i] and (buf[q] & 0xC0) == 0x80:
                    q -= 1
                more.append(q)
                p += LONGEST
        end = np.unique(np.concatenate([end, np.array(more, np.int64)]))
        start = np.concatenate([[0], end[:-1]])
    return start, end, row[start] if len(start) else start


def _chunked(batches):
    for batch in batches:
        for lo, buf, offs in tn.pieces(batch.column(1)):
            if not len(buf):
                continue
            start, end, row = chunks(buf, offs)
            back = np.maximum(start - REACH, offs[row])  # with what its begin depends on: short chunks are not equal by chance
            raw = memoryview(buf.tobytes())
            d = np.frombuffer(b"".join([blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(back.tolist(), end.tolist())]), np.uint64).reshape(-1, 2)
            ids, texts = (batch.column(k).take(pa.array(row + lo)) for k in (0, 2))
            yield pa.RecordBatch.from_arrays(
                [*(tn.as_long(np.ascontiguousarray(d[:, k])) for k in (0, 1)), ids, texts, pa.array((start - offs[row]).astype(np.int32)), pa.array((end - start).astype(np.int32))],
                ["d1", "d2", "doc_id", "th", "start", "size"],
            )


def _edges(batches):
    """Digests of chunks at which repeats of an earlier document begin or end."""
    for batch in batches:
        occ = batch.column(1)
        flat = occ.flatten()
        doc = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in occ])
        start, size, first, d1 = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "size", "first", "d1"))
        order = np.lexsort((start, doc))
        doc, start, size, first, d1 = doc[order], start[order], size[order], first[order], d1[order]
        same = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + size[:-1]) & (first[1:] == first[:-1])
        left, right = np.append(True, ~same)[: len(doc)] & (start > 0), np.append(~same, True)[: len(doc)]
        at = np.flatnonzero((left | right) & (first != doc))
        yield pa.RecordBatch.from_arrays([pa.array(d1[at]), pa.array(left[at]), pa.array(right[at])], ["d1", "left", "right"])


def _windows(batches):
    """Digest, size, doc_id and start of the windows of words that may begin or end a passage at a chunk."""
    code, space = tn.codes(13), tn.spaces()
    for batch in batches:
        occ, edges = batch.column(3), batch.column(4)
        ends = [np.concatenate([[0], np.cumsum([len(x) for x in y])]) for y in (occ, edges)]
        begin, size, digest = (occ.flatten().field(k).to_numpy(zero_copy_only=False) for k in ("start", "size", "d1"))
        known, *sides = (edges.flatten().field(k).to_numpy(zero_copy_only=False) for k in ("d1", "left", "right"))
        at = np.full(len(digest), -1)
        for i in range(len(occ)):  # the digests of a document's edges are sorted
            mine, own = slice(ends[0][i], ends[0][i + 1]), known[ends[1][i] : ends[1][i + 1]]
            k = np.minimum(np.searchsorted(own, digest[mine]), len(own) - 1)
            at[mine] = np.where(own[k] == digest[mine], k + ends[1][i], -1)
        chosen = np.flatnonzero(at >= 0)
        upto, begin, size = np.searchsorted(chosen, ends[0]), begin[chosen], size[chosen]
        left, right = (side[at[chosen]] for side in sides)
        for lo, buf, offs in tn.pieces(batch.column(1)):
            first, last, row = tn.runs(~space[buf], offs)
            if len(first) < WORDS:
                continue
            here = slice(upto[lo], upto[lo + len(offs) - 1])
            s = begin[here].astype(np.int64) + np.repeat(offs[:-1], np.diff(upto[lo : lo + len(offs)]))
            lower, upper = np.searchsorted(first, s, "right") - 1, np.searchsorted(last, s + size[here]) + 1 - WORDS  # windows from upper to lower hold the chunk
            mark = np.zeros(len(first) + 1, np.int64)
            # a chunk begins after 2 * PLACES words at most and ends within PLACES words of the end
            for side, a, b in ((left[here], np.maximum(upper, lower - 2 * PLACES), lower + 1), (right[here], upper, np.minimum(lower, upper + PLACES + 1) + 1)):
                a, b = np.maximum(a, 0), np.maximum(b, 0)
                some = side & (a < b)
                np.add.at(mark, a[some], 1)
                np.add.at(mark, b[some], -1)
            w = np.flatnonzero(np.cumsum(mark)[: len(first) + 1 - WORDS])
            w = w[row[w] == row[w + WORDS - 1]]
            start, end, of = first[w], last[w + WORDS - 1], row[w]
            digest = tn.Rolling(code[buf], tn.BASE_A).of(start, end)
            yield pa.RecordBatch.from_arrays(
                [tn.as_long(digest), pa.array((end - start).astype(np.int32)), *(batch.column(k).take(pa.array(of + lo)) for k in (0, 2)), pa.array((start - offs[of]).astype(np.int32))],
                ["d1", "size", "doc_id", "th", "start"],
            )


def covered(doc_id: int, start: np.ndarray, size: np.ndarray, first: np.ndarray, digest: np.ndarray) -> list[tuple[int, int]]:
    """Spans of repeated windows that an earlier document holds, or an earlier place of this one apart from them."""
    order = np.lexsort((size, start))
    start, end, first, digest = start[order], start[order] + size[order], first[order], digest[order]
    _, at, which = np.unique(digest, return_index=True, return_inverse=True)
    gone = (first != doc_id) | (end[at][which] <= start)
    return [(int(x), int(y)) for x, y in zip(start[gone], end[gone])]


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x, y in sorted(spans):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def removed(doc_id: int, start: np.ndarray, size: np.ndarray, first: np.ndarray, digest: np.ndarray, least: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Spans to remove, and those of runs of repeated chunks."""
    order = np.lexsort((size, start))
    keep = np.ones(len(order), bool)
    keep[1:] = np.diff(start[order]) > 0  # rows that repeat a doc_id
    order = order[keep]
    start, end, first, digest = start[order], start[order] + size[order], first[order], digest[order]
    run = np.concatenate([[0], np.cumsum(start[1:] != end[:-1])])
    long = np.bincount(run, end - start)[run] >= least
    seen = np.zeros(len(start), bool)
    seen[np.unique(digest, return_index=True)[1]] = True
    out: list[tuple[int, int]] = []
    repeat = long & ~((first == doc_id) & seen)
    gone = repeat & (end - start >= REACH)
    beside = lambda i, j: 0 <= j < len(gone) and run[i] == run[j] and gone[j]
    few = np.flatnonzero(repeat & ~gone)
    for i in [*few, *few[::-1]]:  # short ones go with a neighbour of the same origin, or between two
        gone[i] |= any(beside(i, j) and first[i] == first[j] for j in (i - 1, i + 1)) or beside(i, i - 1) and beside(i, i + 1)
    for i in np.flatnonzero(gone):
        if out and out[-1][1] == start[i]:
            out[-1] = (out[-1][0], int(end[i]))
        else:
            out.append((int(start[i]), int(end[i])))
    return out, [(int(x), int(y)) for x, y in zip(start[long], end[long])]


def _cut(names: list[str], schema: pa.Schema, least: int):
    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            texts, ids = t.column("text").to_pylist(), t.column("doc_id").to_pylist()
            part = {}
            for k in ("__chunks", "__windows"):
                occ = t.column(k).combine_chunks()
                flat = occ.flatten()
                part[k] = np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in occ])]), [flat.field(f).to_numpy(zero_copy_only=False) for f in ("start", "size", "first", "d1")]

            def of(k, i):
                at, (start, size, first, d1) = part[k]
                s = slice(at[i], at[i + 1])
                return start[s].astype(np.int64), size[s].astype(np.int64), first[s], d1[s]

            n_bytes, n_removed, n_shared, spans = [], [], [], []
            for i, text in enumerate(texts):
                raw = (text or "").encode()
                chunk, window = of("__chunks", i), of("__windows", i)
                gone, shared = removed(ids[i], *chunk, least) if len(chunk[0]) else ([], [])
                if len(window[0]):
                    gone = united(gone + covered(ids[i], *window))
                    shared = shared + [(int(x), int(x + y)) for x, y in zip(window[0], window[1])]
                shared = sum(y - x for x, y in united(shared))
                if gone:
                    p, parts = 0, []
                    for x, y in gone:
                        parts.append(raw[p:x])
                        p = y
                    texts[i] = b"".join([*parts, raw[p:]]).decode("utf-8", "replace")
                n_bytes.append(len(raw))
                n_removed.append(sum(y - x for x, y in gone))
                n_shared.append(shared)
                spans.append([{"start": x, "end": y} for x, y in gone])
            cols = [pa.array(texts, schema.field("text").type) if k == "text" else t.column(k).combine_chunks() for k in names]
            cols += [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_shared, pa.int64()), pa.array(spans, schema.field("__spans").type)]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    return run


def substring_dedup(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """All columns of docs with repeated passages cut out of text, and __n_bytes, __n_removed, __n_shared, __spans."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop("__n_bytes", "__n_removed", "__n_shared", "__spans")
    text_hash = F.xxhash64("text")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash.alias("th"))
    by = [F.col("doc_id").alias("__id"), F.col("th").alias("__th")]
    listed = lambda x, name: x.groupBy(*by).agg(F.collect_set(F.struct("start", "size", "first", "d1")).alias(name))
    pieces = d.mapInArrow(_chunked, "d1 bigint, d2 bigint, doc_id bigint, th bigint, start int, size int")
    repeated = pieces.groupBy("d1", "d2").agg(F.count("*").alias("c"), F.min("doc_id").alias("first")).where("c > 1").drop("c")
    repeated = Written(repeated, "repeated")
    found = Written(listed(pieces.join(repeated.df, ["d1", "d2"]).where("doc_id is not null"), "__chunks"), "chunks").df
    repeated.drop()
    edges = found.select("__id", "__chunks").mapInArrow(_edges, "d1 bigint, left boolean, right boolean").groupBy("d1").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    edges = Written(edges, "edges")
    # a document asks once for each digest, however often it holds the chunk
    asked = found.select("__id", "__th", F.explode(F.array_distinct(F.transform("__chunks", lambda x: x["d1"]))).alias("d1")).join(edges.df, "d1")
    asked = Written(asked.groupBy("__id", "__th").agg(F.sort_array(F.collect_list(F.struct("d1", "left", "right"))).alias("__edges")), "asked")
    edges.drop()
    about = Written(found.join(asked.df, ["__id", "__th"]).select("__id", "__th", F.transform("__chunks", lambda x: F.struct(x["start"], x["size"], x["d1"])).alias("__about"), "__edges"), "about")
    asked.drop()
    windows = d.join(about.df, (d["doc_id"] == about.df["__id"]) & (d["th"] == about.df["__th"])).select("doc_id", "text", "th", "__about", "__edges")
    windows = Written(windows.mapInArrow(_windows, "d1 bigint, size int, doc_id bigint, th bigint, start int"), "windows")
    about.drop()
    again = Written(windows.df.groupBy("d1", "size").agg(F.count("*").alias("c"), F.min("doc_id").alias("first")).where("c > 1").drop("c"), "again")
    within = Written(listed(windows.df.join(again.df, ["d1", "size"]), "__windows"), "passages").df
    again.drop()
    windows.drop()
    own = lambda x: (docs["doc_id"].cast("long") == x["__id"]) & (F.xxhash64(docs["text"]) == x["__th"])
    x = docs.join(found, own(found), "left").drop("__id", "__th")
    x = x.join(within, own(within), "left").drop("__id", "__th")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in ("__n_bytes", "__n_removed", "__n_shared")), T.StructField("__spans", span)])
    return x.mapInArrow(_cut(docs.columns, to_arrow_schema(schema), least), schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_shared (bytes in repeated passages), n_removed, n_spans, kept_sha256 of what is left."""
    x = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return x.select(
        "doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_shared").alias("n_shared"), F.col("__n_removed").alias("n_removed"),
        F.size("__spans").cast("long").alias("n_spans"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
