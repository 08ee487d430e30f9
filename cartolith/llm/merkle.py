"""Merkle manifest of a dataset (operator 13), by supersteps of messages between the nodes of a forest.

Each row is a leaf: the sha256 of its fields, a null field as ``-``, others as byte count, ``:``, value.  Per source the
leaves ascend by doc_id (null first; rows of one doc_id by their digest) and every ``FANOUT`` consecutive nodes, the last
run possibly fewer, have a parent, the sha256 of their digests as hex text, until one is left: the subroot.  Subroots,
ordered by source (null first, bytewise), have a tree of their own, whose last node is the root.

A leaf's place comes from one sort by ranges, so a source that holds most rows is just many ranges.  Upward supersteps: nodes
send their digests to their parents, combined inside tasks first; a parent that has all its children hashes them and
sends on in the next superstep, one that lacks some waits.  Downward supersteps, in reverse: a node that has its own path to
the root (the siblings at each level above) sends it, with the siblings at its level, to each child.  The leaves of a
parent share its path, so paths are made per run of leaves and meet the leaves once, at most ``FANOUT`` a key.  Each
superstep is an RDD written to the scratch folder: a lost executor costs one superstep, and there are as many as levels.

An empty table has no leaves and gives an empty result; a lone leaf is subroot and root, with no siblings (the sha256 of
nothing); nulls in any column and texts of any length are hashed as stated; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from hashlib import sha256

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Written, _fs, numbered, scratch, table

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Tree of the subroots; the trees of sources are numbered from 0 in their order.
TOP = -1
#: Nodes that one task of a superstep should have.
NODES = 1 << 16
PROVED = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf_digest(fields: dict[str, Column]) -> Column:
    """32 bytes: sha256 over the fields in turn, each by its length, so that no two rows share their input."""

    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, fields.values())).cast("binary"), 256))


def digest(parts: list[bytes]) -> bytes:
    """sha256 of digests written as hex text."""
    return sha256(b"".join(parts).hex().encode()).digest()


def width(leaves: int, level: int) -> int:
    """Nodes of a level of a tree."""
    return -(-leaves // FANOUT**level)


def height(leaves: int) -> int:
    h = 0
    while width(leaves, h) > 1:
        h += 1
    return h


def parent(tree: int, level: int, at: int, leaves: int, trees: int) -> tuple[tuple[int, int, int], int, int] | None:
    """(tree, level, place) of a node's parent, the node's slot in it and the leaves of the parent's tree; None at the root."""
    if width(leaves, level) == 1:
        if tree == TOP or trees == 1:
            return None
        tree, level, at, leaves = TOP, 0, tree, trees
    return (tree, level + 1, at // FANOUT), at % FANOUT, leaves


def children(key: tuple[int, int, int], leaves: int) -> int:
    _, level, at = key
    return min(FANOUT, width(leaves, level - 1) - FANOUT * at)


class Steps:
    """The RDDs of the supersteps of one direction, each written to the scratch folder, whence later ones read it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, rdd: RDD) -> RDD:
        self.paths.append(f"{scratch(self.spark)}/cartolith-merkle-{uuid.uuid4().hex}")
        rdd.saveAsPickleFile(self.paths[-1])
        return self.spark.sparkContext.pickleFile(self.paths[-1])

    def drop(self) -> None:
        for path in self.paths:
            fs, at = _fs(self.spark, path)
            fs.delete(at, True)


def _gather(a: list, b: list) -> list:
    return a + b


def upward(steps: Steps, messages: RDD, trees: int, parts) -> list[RDD]:
    """Supersteps from the leaves: messages (parent, [(leaves of its tree, slot, level of the sender, digest)]).
    Per superstep the nodes it completed: (node, (digests of its children, their levels))."""

    def receive(item):
        key, got = item
        leaves = got[0][0]
        if len(got) < children(key, leaves):
            yield "wait", key, got
            return
        got = sorted(got, key=lambda x: x[1])
        below = [x[3] for x in got]
        yield "node", key, (below, [x[2] for x in got])
        over = parent(*key, leaves, trees)
        if over:
            yield "wait", over[0], [(over[2], over[1], key[1], digest(below))]

    out = []
    for p in parts:
        step = steps.write(messages.reduceByKey(_gather, p).flatMap(receive))
        out.append(step.filter(lambda x: x[0] == "node").map(lambda x: x[1:]))
        messages = step.filter(lambda x: x[0] == "wait").map(lambda x: x[1:])
    return out


def downward(steps: Steps, nodes: list[RDD], parts) -> RDD:
    """Reverse supersteps from the root: (node, (digests of its children, path)) of the nodes that have leaves.
    A path is a list of (slot, siblings) from the node up to the root."""

    def pass_on(item):
        key, (own, paths) = item
        tree, level, at = key
        paths = list(paths)
        for below, levels in own:
            path = paths[0] if paths else []  # the root has received none
            if 0 in levels:
                yield "known", key, (below, path)
            for slot, (_, lower) in enumerate(zip(below, levels, strict=True)):
                if lower:
                    child = (tree, lower, at * FANOUT + slot) if level > 1 or tree != TOP else (at * FANOUT + slot, lower, 0)
                    yield "path", child, [(slot, below[:slot] + below[slot + 1 :]), *path]
            return
        for path in paths:  # its node was completed before
            yield "path", key, path

    waiting = steps.spark.sparkContext.parallelize([], 1)
    known = []
    for step, p in zip(reversed(nodes), reversed(parts), strict=True):
        x = steps.write(step.cogroup(waiting, p).flatMap(pass_on))
        known.append(x.filter(lambda m: m[0] == "known").map(lambda m: m[1:]))
        waiting = x.filter(lambda m: m[0] == "path").map(lambda m: m[1:])
    return steps.spark.sparkContext.union(known) if known else waiting


def fold(leaf: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and the siblings on its path give."""
    for slot, siblings in path:
        leaf = digest([*siblings[:slot], leaf, *siblings[slot:]])
    return leaf


def _checked(item):
    """Rows of the leaves of one parent: (id, leaf, subroot, root, digest of the proof, folded root, verified)."""
    _, (leaves, known) = item
    run, path = next(iter(known), ([], []))
    ends: dict[int, tuple[bytes, bytes]] = {}  # subroot and root of a source's run, by the height of its tree
    for name, slot, rise, leaf, now in leaves:
        own = [(slot, run[:slot] + run[slot + 1 :]), *path] if run else []
        if rise not in ends or not rise:
            subroot = fold(leaf, own[:rise])
            ends[rise] = subroot, fold(subroot, own[rise:])
        subroot, root = ends[rise]
        proof = sha256(b"".join([x for _, siblings in own for x in siblings]).hex().encode()).hexdigest()
        folded = fold(now, own)
        yield name, leaf.hex(), subroot.hex(), root.hex(), proof, folded.hex(), folded == root


def manifest(leaves: DataFrame, by: str = "source", order: str = "doc_id") -> DataFrame:
    """(by, order, leaf, now) -> order, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row.
    ``leaf`` is the digest that the manifest holds, ``now`` that of the row as it is found when it is checked."""
    spark = leaves.sparkSession
    schema = f"`{order}` {leaves.schema[order].dataType.simpleString()}, {PROVED}"
    hashed = Written(leaves.select(F.col(by).alias("by"), F.col(order).alias("id"), "leaf", "now"), "leaves")
    d = Written(numbered(hashed.df, [F.col("by"), F.col("id"), F.col("leaf"), F.col("now")], "row", "sorted"), "rows").df
    hashed.drop()
    cuts = Written(d.groupBy("__part", "by").agg(F.min("row").alias("first"), F.count("*").alias("n")), "cuts").df
    trees = cuts.groupBy("by").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    trees = Written(numbered(trees, [F.col("first")], "tree", "trees").drop("__part"), "trees").df
    m, most, total = trees.agg(F.count("*"), F.max("n"), F.sum("n")).first()
    if not m:
        return spark.createDataFrame([], schema)
    # joined by range and source: no key has more rows than a range
    c, t = cuts.select("__part", "by").alias("c"), trees.alias("t")
    places = Written(c.join(t, F.col("c.by").eqNullSafe(F.col("t.by"))).select(F.col("__part").alias("part"), F.col("c.by").alias("of"), "first", "n", "tree"), "places").sized()
    x = d.join(places, (F.col("__part") == F.col("part")) & F.col("by").eqNullSafe(F.col("of")))

    def addressed(r):
        over = parent(r["tree"], 0, r["row"] - r["first"], r["n"], m) or (None, 0, 0)
        return *over, height(r["n"]), r["id"], bytes(r["leaf"]), bytes(r["now"])

    first, steps = Steps(spark), Steps(spark)
    own = first.write(x.select("tree", "row", "first", "n", "id", "leaf", "now").rdd.map(addressed))
    parts = [-(-total // (FANOUT**k * NODES)) + -(-m // NODES) for k in range(1, height(most) + height(m) + 1)]
    nodes = upward(steps, own.filter(lambda r: r[0] is not None).map(lambda r: (r[0], [(r[2], r[1], 0, r[5])])), m, parts)
    back = Steps(spark)
    known = downward(back, nodes, parts)
    steps.drop()  # the paths have been written
    mine = own.map(lambda r: (r[0], (r[4], r[1], r[3], r[5], r[6])))
    return spark.createDataFrame(mine.cogroup(known, -(-total // NODES)).flatMap(_checked), schema, verifySchema=False)


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    fields = {c: F.col(c) for c in FIELDS}
    d = d.withColumn("leaf", leaf_digest(fields))
    now = F.when(tampered, leaf_digest({**fields, "text": lowered(F.col("text"))})).otherwise(F.col("leaf"))
    return manifest(d.select("doc_id", "source", "leaf", now.alias("now")))


_FIELD = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in FIELDS[:4])
_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql() -> str:
    from .resampling import CRC, CRC_TABLE

    return f"""
with recursive crc as (select {CRC_TABLE} as crc_table),
d as (
  select doc_id, source, sha256({_LEAF} || {_FIELD.format("text")}) as leaf, case when {CRC.format("doc_id::varchar")} % 5 = 0 then sha256({_LEAF} || {_FIELD.format(_LOW)}) end as bad from documents, crc),
l as (select *, coalesce(bad, leaf) as now, dense_rank() over (order by source nulls first) - 1 as tree, row_number() over (partition by source order by doc_id nulls first, leaf, coalesce(bad, leaf)) - 1 as i, count(*) over (partition by source) as n from d),
up(tree, lvl, i, n, h) as (
  select tree, 0, i, n, leaf from l
  union all select tree, lvl + 1, i // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' order by i)) from up where n > 1 group by tree, lvl, i // {FANOUT}, n),
top(lvl, i, n, h) as (
  select 0, tree, (select count(distinct tree) from l), h from up where n = 1
  union all select lvl + 1, i // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' order by i)) from top where n > 1 group by lvl, i // {FANOUT}, n),
nodes as (select 0 as side, tree, lvl, i, n, h from up union all select 1, 0, lvl, i, n, h from top),
lf as (select row_number() over (order by tree, i) as id, * from l),
steps as (
  select id, 0 as side, lf.tree as tree, lvl, nodes.n, lf.i // ({FANOUT} ** lvl)::bigint as i from lf join (select distinct tree, lvl, n from up where n > 1) nodes on lf.tree = nodes.tree
  union all select id, 1, 0, lvl, nodes.n, lf.tree // ({FANOUT} ** lvl)::bigint from lf, (select distinct lvl, n from top where n > 1) nodes),
sib as (
  select s.id, s.side, s.lvl, coalesce(string_agg(x.h, '' order by x.i) filter (where x.i < s.i), '') as before, coalesce(string_agg(x.h, '' order by x.i) filter (where x.i > s.i), '') as after
  from steps s join nodes x on x.side = s.side and x.tree = s.tree and x.lvl = s.lvl and x.i // {FANOUT} = s.i // {FANOUT} group by s.id, s.side, s.lvl),
path as (select *, row_number() over (partition by id order by side, lvl) as k from sib),
folded(id, k, h) as (select id, 0, now from lf union all select f.id, f.k + 1, sha256(before || h || after) from folded f join path p on p.id = f.id and p.k = f.k + 1),
ends as (select id, arg_max(h, k) as folded_root from folded group by id),
proofs as (select id, sha256(string_agg(before || after, '' order by k)) as proof from path group by id)
select doc_id, leaf, u.h as subroot, r.h as root, coalesce(proof, sha256('')) as proof_sha256, folded_root, folded_root = r.h as verified
from lf join (select tree, h from up where n = 1) u using (tree) join (select h from top where n = 1) r on true join ends using (id) left join proofs using (id)"""


OP13_SQL = _sql()
