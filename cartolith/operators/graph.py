"""Connected components by contraction with pointer doubling."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only for a local master, where none is set."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("cartolith.shared.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="cartolith-")
        spark.conf.set("cartolith.shared.dir", where)
    return where.rstrip("/")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: lineage ends here and a lost executor costs nothing before it."""
    path = f"{shared_folder(df.sparkSession)}/cartolith-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id) and (a, b) -> (id, component): component is the least id reachable.

    Each round points every node at its least neighbour or itself, follows the pointers to their roots by doubling, and takes the
    roots' edges into the next round, where loops and doubles are gone: edges shrink fast, and the nodes are joined once a round
    only at the end.  A least id never points elsewhere, so the last root is the least.
    """
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    e = cut(edges.where("a <> b").select(*ends).distinct(), "edges")
    rounds = []
    while e.limit(1).count():
        least = e.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root"))  # b has a smaller neighbour; an a alone stays
        up = cut(least, "roots")
        while True:
            then = F.col("p.root")
            step = up.alias("u").join(up.alias("p"), F.col("u.root") == F.col("p.id"), "left")
            step = cut(step.select("u.id", F.coalesce(then, "u.root").alias("root"), then.isNotNull().alias("moved")), "roots")
            up = step.select("id", "root")
            if not step.where("moved").limit(1).count():
                break
        rounds.append(up)
        for end in ("a", "b"):
            e = e.join(up, F.col(end) == F.col("id"), "left").withColumn(end, F.coalesce("root", end)).drop("id", "root")
        e = cut(e.where("a <> b").select(*ends).distinct(), "edges")
    labels = nodes.select("id", F.col("id").alias("component")).distinct()
    for up in rounds:
        labels = labels.join(up.withColumnsRenamed({"id": "__id", "root": "__root"}), F.col("component") == F.col("__id"), "left")
        labels = labels.select("id", F.coalesce("__root", "component").alias("component"))
    return cut(labels, "labels")


def sums_to_root(nodes: DataFrame) -> DataFrame:
    """(id, parent, value) -> (id, root, total, depth): values summed from each node up to its root, which has no parent.

    Pointer doubling: in each round a node that has not reached its root adds what the ancestor it points to has summed, and
    points where that one points; so rounds grow with the logarithm of the depth, and each is written.  Only the ancestors
    pointed to are joined, which are fewer each round.  Nodes whose ancestors are not in the table have no row; cycles are an
    error.
    """
    x = nodes.select("id", F.coalesce("parent", "id").alias("root"), F.col("parent").alias("up"), F.col("value").cast("long").alias("total"), F.lit(1).cast("long").alias("depth"))
    x = cut(x, "sums")
    most = x.count().bit_length() + 1
    for _ in range(most + 1):
        todo = x.where("up is not null")
        if not todo.limit(1).count():
            return x.drop("up")
        heads = x.join(todo.select(F.col("up").alias("id")).distinct(), "id").select(F.col("id").alias("h"), *(F.col(k).alias(f"h_{k}") for k in ("root", "up", "total", "depth")))
        further = todo.join(heads, F.col("up") == F.col("h")).select("id", F.col("h_root").alias("root"), F.col("h_up").alias("up"), (F.col("total") + F.col("h_total")).alias("total"), (F.col("depth") + F.col("h_depth")).alias("depth"))
        x = cut(x.where("up is null").unionByName(further), "sums")
    raise ValueError("nodes form a cycle")
