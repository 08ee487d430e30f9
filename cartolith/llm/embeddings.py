"""Embedding near-deduplication (operator 1): spherical k-means cells, blocked cosine products, exact links.

Only vectors of equal, non-null label and equal dimension are compared.  Exact copies are first folded into one
representative with a multiplicity.  Spherical k-means (fitted for each dimension on a sample of ``SAMPLE_PER_CELL`` vectors a
cell, cells growing with the square root of the largest label) gives each vector its nearest cell; a vector is also a guest
of each cell of lower number that can hold a vector within the threshold angle.  The test for that is exact: the boundary
between cells c and c' is the hyperplane normal to c - c', and a vector whose angle to it exceeds the threshold has no partner
beyond it; nor has one in a cell whose furthest member is too near to the cell's centroid.  So every pair at or above the
threshold meets in exactly one cell.  Cells are cut into blocks of at most about ``BLOCK`` vectors and block pairs are
multiplied as matrices, a strip at a time; a task returns counts and one edge per linked vector, never pairs.  Of vectors
without structure a cell keeps few others out, so work on them stays near the square of a label's size.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, as do those without label:
n_links 0, a component of their own.  Repeated rows count as vectors, also those that share a vec_id; ties take the smallest
vec_id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Written, components, table

BLOCK = 2048
#: Rows of a block multiplied at once.
STRIP = 512
#: The fit reads at most this many vectors for each cell, of which there are at most so many; fewer vectors need no cells.
SAMPLE_PER_CELL, MOST_CELLS, FEWEST = 32, 2048, 64


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision, without overflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids; starts at evenly spaced rows, an empty cell keeps its centroid."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1)
        c[size > 1e-12] = total[size > 1e-12] / size[size > 1e-12, None]
    return c


def _matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _radii(cells: dict[int, np.ndarray]):
    """(dim, v) -> dim, cell, least cosine of the cell's members in the batch."""

    def run(batches):
        for b in batches:
            dims = b.column(0).to_numpy()
            for dim in np.unique(dims):
                if (c := cells.get(int(dim))) is not None:
                    score = unit(_matrix(b.filter(pa.array(dims == dim)).column(1))) @ c.T
                    cell, best = score.argmax(1), score.max(1)
                    least = np.full(len(c), np.inf)
                    np.minimum.at(least, cell, best)
                    at = np.flatnonzero(np.isfinite(least))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), dim, np.int32)), pa.array(at.astype(np.int32)), pa.array(least[at])], ["dim", "cell", "least"])

    return run


def _placed(cells: dict[int, np.ndarray], radii: dict[int, np.ndarray], least: float):
    """(node, label, dim, v, weight) -> a row for the own cell and one for each cell the vector is a guest of."""
    reach = float(np.sin(np.arccos(least))) * (1 + 1e-9) + 1e-9

    def run(batches):
        apart = {dim: np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0)) for dim, c in cells.items()}
        for b in batches:
            dims = b.column(2).to_numpy()
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                n = part.num_rows
                row, cell, guest = np.arange(n), np.zeros(n, np.int64), np.zeros(n, bool)
                if (c := cells.get(int(dim))) is not None:
                    score = unit(_matrix(part.column(3))) @ c.T
                    cell = score.argmax(1)
                    near = score[row, cell][:, None] - score <= reach * apart[int(dim)][cell]
                    near &= np.arange(len(c))[None] < cell[:, None]
                    near &= np.arccos(np.clip(score, -1, 1)) <= radii[int(dim)][None] + np.arccos(least) + 1e-6
                    gr, gc = np.nonzero(near)
                    row, cell, guest = np.concatenate([row, gr]), np.concatenate([cell, gc]), np.concatenate([guest, np.ones(len(gr), bool)])
                for lo in range(0, len(row), 8192):
                    at = slice(lo, lo + 8192)
                    yield pa.RecordBatch.from_arrays([*part.take(pa.array(row[at])).columns, pa.array(cell[at].astype(np.int32)), pa.array(guest[at])], ["node", "label", "dim", "v", "weight", "cell", "guest"])

    return run


def groups_of(link: np.ndarray) -> np.ndarray:
    """Component of each row of a symmetric boolean matrix, as the least row of it."""
    out = np.full(len(link), -1)
    for i in range(len(link)):
        if out[i] < 0:
            out[i], front = i, np.array([i])
            while len(front):
                new = link[front].any(0) & (out < 0)
                out[new] = i
                front = np.flatnonzero(new)
    return out


def _compared(least: float):
    def run(t: pa.Table) -> pa.Table:
        v, node = unit(_matrix(t.column("v"))), t.column("node").to_numpy()
        side, weight = t.column("side").to_numpy(), t.column("weight").to_numpy().astype(np.float64)
        link, links = np.zeros((len(v), len(v)), bool), np.zeros(len(v))
        across = bool((side != 0).any())  # two blocks: only pairs across them
        for lo in range(0, len(v), STRIP):
            at = slice(lo, lo + STRIP)
            x = v[at] @ v.T >= least
            if across:
                x &= side[at, None] != side[None]
            x[np.arange(len(x)), np.arange(lo, lo + len(x))] = False
            link[at], links[at] = x, x @ weight
        some = np.flatnonzero(links)
        parts = groups_of(link[np.ix_(some, some)])
        return pa.table({"a": node[some], "b": node[some][parts] if len(some) else node[some], "n": links[some].astype(np.int64)})

    return run


def cells_of(reps: DataFrame, least: float) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """Centroids by dimension, and the greatest angle between a centroid and a member of its cell."""
    cells: dict[int, np.ndarray] = {}
    sizes = reps.groupBy("dim", "label").agg(F.count("*").alias("n")).groupBy("dim").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    for r in sizes.where(F.col("n") >= FEWEST).collect():
        k = min(max(2, round((20 * r["most"] / BLOCK) ** 0.5)), MOST_CELLS)
        drawn = reps.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("node"), "node").limit(SAMPLE_PER_CELL * k).select("v").collect()
        cells[r["dim"]] = spherical_kmeans(unit(np.array([x["v"] for x in drawn])), k)
    radii = {dim: np.zeros(len(c)) for dim, c in cells.items()}
    if cells:
        found = reps.select("dim", "v").mapInArrow(_radii(cells), "dim int, cell int, least double")
        for r in found.groupBy("dim", "cell").agg(F.min("least").alias("least")).collect():
            radii[r["dim"]][r["cell"]] = np.arccos(np.clip(r["least"], -1, 1))
    return cells, radii


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """(vec_id, embedding, label) -> vec_id, n_links, component_id, kept: one row per row."""
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("v").isNotNull() & ~odd & F.exists("v", lambda x: x != 0) & F.col("label").isNotNull()
    v = v.withColumn("fine", F.coalesce(fine, F.lit(False)))
    v = v.withColumns({"h1": F.when(F.col("fine"), F.xxhash64("v")), "h2": F.when(F.col("fine"), F.xxhash64(F.lit(7), "v"))})
    key = ["label", "h1", "h2"]
    reps = v.where("fine").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("v").alias("v"))
    # vec_ids may repeat: what is linked is nodes, numbered where the table is written
    reps = Written(reps.withColumns({"dim": F.size("v"), "node": F.monotonically_increasing_id()}), "reps").df
    kind = dict(reps.dtypes)
    placed = reps.select("node", "label", "dim", "v", "weight").mapInArrow(
        _placed(*cells_of(reps, least), least), f"node bigint, label {kind['label']}, dim int, v array<double>, weight bigint, cell int, guest boolean"
    )
    placed = Written(placed.withColumn("v", F.col("v").cast(vectors.schema["embedding"].dataType)), "placed")
    at = ["label", "dim", "cell"]
    count = placed.df.groupBy(*at).agg(
        F.greatest(F.ceil(F.sum(F.when(F.col("guest"), 0).otherwise(1)) / BLOCK), F.lit(1)).cast("int").alias("own"),
        F.ceil(F.sum(F.when(F.col("guest"), 1).otherwise(0)) / BLOCK).cast("int").alias("guests"),
    )
    x = placed.df.join(Written(count, "cells").sized(), at)
    x = x.withColumn("block", F.pmod(F.xxhash64("node"), F.greatest(F.when(F.col("guest"), F.col("guests")).otherwise(F.col("own")), F.lit(1))).cast("int"))
    task = lambda first, second, side: F.struct(first.cast("int").alias("i"), second.cast("int").alias("j"), side.cast("int").alias("side"))
    # own blocks i <= j meet under (i, j); guest block g meets own block j under (-1 - g, j)
    own = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda j: task(F.least(j, "block"), F.greatest(j, "block"), F.when(j == F.col("block"), 0).when(j < F.col("block"), 2).otherwise(1)))
    hosts = F.transform(F.sequence(F.lit(1), F.col("guests")), lambda g: task(-g, F.col("block"), F.lit(1)))
    hosts = F.when(F.col("guests") > 0, hosts).otherwise(F.array().cast("array<struct<i:int,j:int,side:int>>"))
    guests = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda j: task(-1 - F.col("block"), j, F.lit(2)))
    x = x.withColumn("task", F.explode(F.when(F.col("guest"), guests).otherwise(F.concat(own, hosts))))
    x = x.select("node", "v", "weight", *at, "task.i", "task.j", "task.side")
    found = x.groupBy(*at, "i", "j").applyInArrow(_compared(least), "a bigint, b bigint, n bigint")
    found = Written(found, "found").df
    placed.drop()
    parts = Written(components(found.select("a", "b"), "vectors"), "parts").df
    linked = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    of = reps.select(*key, "node", "rep", "weight").join(linked, "node", "left").join(parts, "node", "left")
    low = of.where("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
    of = of.join(low, "component", "left")
    out = v.select("vec_id", *key).join(of.drop("node"), key, "left")
    out = out.select(
        "vec_id",
        F.coalesce(F.col("weight") - 1 + F.coalesce("linked", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "rep", "vec_id").cast("long").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
