"""Shared helpers: tables, scratch space on the cluster's shared folder, sized broadcasts, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Largest table, in bytes of Parquet, that is broadcast after its size was measured.
BROADCAST_BYTES = 4 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows handed to a Python worker at once: texts are long.
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share, of spark.checkpoint.dir; a temporary one only for a local master."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("cartolith.scratch.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="cartolith-")
        spark.conf.set("cartolith.scratch.dir", where)
    return where.rstrip("/")


@contextmanager
def set_to(spark: SparkSession, own: dict[str, str]):
    """Settings for what runs inside; the former ones come back."""
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


class Written:
    """A DataFrame written as Parquet into the scratch folder: lineage ends here and survives lost executors.
    ``group_bytes``: row groups of about that size, for tables of large rows, which are written and read a row group at a time."""

    def __init__(self, df: DataFrame, label: str, group_bytes: int | None = None):
        self.spark = df.sparkSession
        self.path = f"{scratch(self.spark)}/cartolith-{label}-{uuid.uuid4().hex}"
        self.schema = df.schema
        rows = int(self.spark.conf.get(BATCH, "10000"))
        # what this write shuffled is deleted when it is done
        own = {CLEANUP: "true", BATCH: str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS)}
        with set_to(self.spark, own):
            w = df.write
            if group_bytes:
                w = w.option("parquet.block.size", group_bytes).option("parquet.block.size.row.check.min", 4).option("parquet.page.size.row.check.min", 4)
            w.parquet(self.path)
        self.df = self.spark.read.schema(self.schema).parquet(self.path)

    def bytes(self) -> int:
        fs, at = _fs(self.spark, self.path)
        return fs.getContentSummary(at).getLength()

    def sized(self) -> DataFrame:
        """Marked for broadcast where its measured size allows; a plain table beyond that."""
        return F.broadcast(self.df) if self.bytes() <= BROADCAST_BYTES else self.df

    def drop(self) -> None:
        fs, at = _fs(self.spark, self.path)
        fs.delete(at, True)


def numbered(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """Adds the position, from 0, over the whole table in ``order``: ranges are sorted side by side, then laid end to end.
    ``order`` must be columns of df; rows equal in all of them are numbered in any order.  Also adds __part, the range."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id())
    s = Written(ranged, label).df.withColumns({"__part": F.shiftright("__m", 33), "__m": F.col("__m").bitwiseAND((1 << 33) - 1)})
    sizes = s.groupBy("__part").agg(F.count("*").alias("n"))  # as many rows as ranges
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = s.join(F.broadcast(sizes.select("__part", before.alias("__before"))), "__part")
    return x.withColumn(name, F.col("__before") + F.col("__m")).drop("__m", "__before")


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """Connected components of edges (a, b): one row (node, component) per node, component its smallest node.

    Alternating large-star and small-star steps, which join each edge with one minimum per node: no list of
    neighbours is ever gathered, a hub's edges are split by adaptive execution, rounds grow with the logarithm
    of the longest path, and each round is written to the scratch folder.
    """
    now = Written(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        label,
    )
    while True:
        e = now.df
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v")
            .where("u <> v")
            .distinct()
        )
        then = Written(small, label)
        changed = then.df.exceptAll(now.df).limit(1).count() + (0 if then.df.count() == now.df.count() else 1)
        now.drop()
        now = then
        if not changed:
            break
    e = now.df
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
