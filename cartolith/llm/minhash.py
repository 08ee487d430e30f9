"""MinHash near-deduplication (operator 7): SuperMinHash signatures, banding, verification on full sets, components.

Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased.  A document's set is its distinct
``shingle``-word shingles as 64-bit hashes (the whole word sequence where it has fewer words); a document without words
has an empty set and is linked with nothing.  Documents of equal sets are one class from the start.

Candidates are found among the classes by banding: each bucket links its members to its least one, so buckets never
emit their pairs and a dense group shares few pivots; buckets of equal members are folded into one first.  Links are
confirmed on full sets.  Buckets that then still hold several components are compared on full sets in blocks of
``BLOCK`` members, the largest component of a bucket against the others and these among themselves; a task returns one
edge per linked member.  So no link between different components is lost, and members of one component are not compared.
With 30 bands of 6 rows a pair at similarity 0.85 misses all buckets with probability 7e-7, one at 0.8 with 1e-4.

Classes are named by one of their rows, and the least doc_id is carried beside the name, so rows that share a doc_id are
judged by their own text each.  Null and empty texts form components of their own, ties take the smallest doc_id; rows
without doc_id link nothing and have the component of their equals, else null; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp as tn
from .common import Written, components, table

BANDS, ROWS = 30, 6
BLOCK = 512


def shingles(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a piece, by row and then by hash, and the offsets of rows in them."""
    start, end, row = tn.runs(~tn.spaces()[buf], offs)
    n = len(offs) - 1
    words = np.bincount(row, minlength=n)
    h = tn.Rolling(tn.codes(1, lower=True)[buf], tn.BASE_A).of(start, end)
    weight = tn.constant(2, k)
    whole = np.maximum(words - k + 1, np.minimum(words, 1))
    first = np.concatenate([[0], np.cumsum(words)])[:-1]
    out_row = np.repeat(np.arange(n), whole)
    at = first[out_row] + np.arange(len(out_row)) - np.repeat(np.cumsum(whole) - whole, whole)
    size = np.minimum(words, k)[out_row]
    x = np.zeros(len(at), np.uint64)
    for i in range(k):
        ok = i < size
        x[ok] += h[at[ok] + i] * (weight[i] | np.uint64(1))
    x = tn.mix64(x + size.astype(np.uint64))
    order = np.lexsort((x, out_row))
    x, r = x[order], out_row[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (r[1:] != r[:-1])
    x, r = x[new], r[new]
    return x, np.searchsorted(r, np.arange(n + 1))


def superminhash(x: np.ndarray, offs: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash of each row's set: in round j an element puts j + its uniform draw at entry j of its own random
    permutation of the m slots; a row stops when every slot holds less than the next round can bring."""
    n = len(offs) - 1
    row = np.repeat(np.arange(n), np.diff(offs))
    best = np.full(n * m, np.inf)
    perm = None
    for j in range(m):
        draw = tn.mix64(x + np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        pick = tn.mix64(draw ^ np.uint64(0xA0761D6478BD642F))
        k = j + ((pick >> np.uint64(32)) % np.uint64(m - j)).astype(np.int64)
        value = j + (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        if j == 0:
            slot = k
        else:
            each = np.arange(len(x))
            if perm is None:
                perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(x), 1))
                perm[each, first_k], perm[:, 0] = 0, first_k
            slot = perm[each, k].astype(np.int64)
            perm[each, k] = perm[:, j]
        np.minimum.at(best, row * m + slot, value)
        live = best.reshape(n, m).max(1) >= j + 1
        live &= np.diff(offs) > 0
        if not live.any():
            break
        keep = live[row]
        first_k = k[keep] if j == 0 else None
        if not keep.all():
            x, row = x[keep], row[keep]
            perm = perm[keep] if perm is not None else None
        elif j == 0:
            first_k = k
    return best.reshape(n, m)


def fingerprint(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over each set."""
    sums = np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(np.stack([tn.mix64(x), tn.mix64(x ^ np.uint64(0x5851F42D4C957F2D))], 1), 0)])
    return sums[at[1:]] - sums[at[:-1]]


def _signed(k: int, bands: int, rows: int):
    def run(batches):
        weight = tn.constant(9, rows) | np.uint64(1)
        for b in batches:
            for lo, buf, offs in tn.pieces(b.column(1)):
                x, at = shingles(buf, offs, k)
                n = len(at) - 1
                size, s = np.diff(at), fingerprint(x, at)
                sig = superminhash(x, at, bands * rows).view(np.uint64)
                band = tn.mix64((tn.mix64(sig).reshape(n, bands, rows) * weight).sum(2, dtype=np.uint64))
                full = size > 0
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(full, bands, 0))]).astype(np.int32)), tn.as_long(band[full].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n), b.column(2).slice(lo, n), tn.as_long(size), tn.as_long(np.ascontiguousarray(s[:, 0])), tn.as_long(np.ascontiguousarray(s[:, 1])), lists],
                    ["doc_id", "th", "n", "s1", "s2", "bands"],
                )

    return run


def _sets(k: int):
    def run(batches):
        for b in batches:
            for lo, buf, offs in tn.pieces(b.column(1)):
                x, at = shingles(buf, offs, k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(at) - 1), tn.as_long(np.ascontiguousarray(fingerprint(x, at)[:, 0])), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), tn.as_long(x))], ["rep", "s1", "shingles"]
                )

    return run


def _linked(percent: int):
    """Edges (member, least member of its component) by full sets; of two blocks (side 1 and 2) only across them."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("rep")
        rep, part, side = (t.column(c).to_numpy() for c in ("rep", "component", "side"))
        sets = t.column("shingles").combine_chunks()
        values, code = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        size = np.diff(sets.offsets.to_numpy())
        at = np.cumsum(size) - size
        link = np.zeros((len(rep), len(rep)), bool)
        mark = np.zeros(len(values), np.int32)
        for i in range(len(rep)):
            mine = code[at[i] : at[i] + size[i]]
            mark[mine] = 1
            both = np.add.reduceat(mark[code], at)
            mark[mine] = 0
            link[i] = 100 * both >= percent * (size[i] + size - both)
        link &= part[:, None] != part[None]
        if (side != 0).any():
            link &= side[:, None] != side[None]
        least, todo = np.arange(len(rep)), link.any(1)
        for i in np.flatnonzero(todo):
            if todo[i]:
                front = np.array([i])
                todo[i] = False
                while len(front):
                    new = link[front].any(0) & todo
                    todo[new], least[new] = False, i
                    front = np.flatnonzero(new)
        new = least != np.arange(len(rep))
        return pa.table({"a": rep[least[new]], "b": rep[new]})

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    x = pairs.join(sets.withColumnsRenamed({"rep": "a", "shingles": "sa"}), "a").join(sets.withColumnsRenamed({"rep": "b", "shingles": "sb"}), "b")
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return x.where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id, kept, th (hash of the text): one row per row of docs."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    signed = d.mapInArrow(_signed(k, bands, rows), "doc_id bigint, th bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>")
    signed = Written(signed.withColumn("row", F.monotonically_increasing_id()), "signed").df
    key = ["s1", "s2", "n"]
    classes = signed.where("n > 0 and doc_id is not null").groupBy(*key).agg(F.min("row").alias("rep"), F.min("doc_id").alias("least"))
    classes = Written(classes, "classes").df
    reps = Written(signed.join(classes.select(F.col("rep").alias("row")), "row").withColumnRenamed("row", "rep"), "reps").df
    banded = reps.select("rep", F.posexplode("bands").alias("band", "bh"))
    met = banded.groupBy("band", "bh").agg(F.min("rep").alias("pivot"), F.count("*").alias("members"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("y"))
    once = met.where("members > 1").groupBy("members", "x", "y").agg(F.min(F.struct("band", "bh", "pivot")).alias("of")).select("of.*", "members")
    once = Written(once, "pivots").df
    shared = Written(banded.join(once, ["band", "bh"]), "buckets").df
    ids = Written(reps.join(shared, "rep", "left_semi").select("rep", "s1", F.col("doc_id").alias("of"), F.col("th").alias("as")), "members").sized()
    sets = d.join(ids.drop("s1"), (F.col("doc_id") == F.col("of")) & (F.col("th") == F.col("as"))).select("rep", "text")
    sets = sets.mapInArrow(_sets(k), "rep bigint, s1 bigint, shingles array<bigint>")
    sets = Written(sets.join(ids.select("rep", "s1"), ["rep", "s1"], "left_semi").drop("s1").dropDuplicates(["rep"]), "sets").df

    star = shared.where(F.col("rep") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = Written(verified(star, sets, percent), "links").df
    parts = Written(components(links), "parts").df
    # members of the buckets that hold several components, with the largest of these; two members are a star
    x = shared.where("members > 2").select("band", "bh", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    sizes = x.groupBy("band", "bh", "component").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("band", "bh").agg(F.max(F.struct("m", "component")).alias("x"), F.count("*").alias("parts")).where("parts > 1")
    x = Written(x.join(largest.select("band", "bh", F.col("x.component").alias("largest")), ["band", "bh"]), "apart").df

    host = F.col("component") == F.col("largest")
    blocks = lambda which: F.ceil(F.count_if(which) / BLOCK).cast("int")
    cut = x.groupBy("band", "bh").agg(blocks(host).alias("hosts"), blocks(~host).alias("others"))
    y = x.join(Written(cut, "cut").df, ["band", "bh"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.when(host, F.col("hosts")).otherwise(F.col("others"))).cast("int"))
    task = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))
    # blocks i <= j of the others meet under (i, j); block i of the others meets block j of the largest under (i, -1 - j)
    among = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda j: task(F.least(j, "block"), F.greatest(j, "block"), F.when(j == F.col("block"), 0).when(j < F.col("block"), 2).otherwise(1)))
    against = F.transform(F.sequence(F.lit(0), F.col("hosts") - 1), lambda j: task(F.col("block"), -1 - j, F.lit(1)))
    hosted = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda i: task(i, -1 - F.col("block"), F.lit(2)))
    y = y.withColumn("task", F.explode(F.when(host, hosted).otherwise(F.concat(among, against))))
    y = y.select("band", "bh", "rep", "component", "task.i", "task.j", "task.side").join(sets, "rep")
    more = Written(y.groupBy("band", "bh", "i", "j").applyInArrow(_linked(percent), "a bigint, b bigint"), "more").df
    if more.limit(1).count():
        parts = Written(components(links.unionByName(more)), "parts").df
    named = parts.join(classes.select(F.col("rep").alias("node"), "least"), "node")
    lows = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(lows, "component").select(F.col("node").alias("rep"), "component_id")
    out = signed.select("doc_id", "th", *key).join(classes, key, "left").join(named, "rep", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "least", "doc_id").alias("component_id"), "th")
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "th")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("th")
