"""Relational operators that Spark has no word for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut


def distinct_on(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``; null keys are one group.  Spark prunes the window to its first row before
    the exchange.  Give a last order column that is unique, so that reruns agree."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def best_match(left: DataFrame, right: DataFrame, on: Column, key: list[str], order: list[Column], how: str = "left") -> DataFrame:
    """For each left row (unique by ``key``) the first matching right row: the join form of a LATERAL .. LIMIT 1."""
    return distinct_on(left.join(right, on, how), key, order)


def any_of_joins(left: DataFrame, right: DataFrame, conditions: list[Column], columns: list[Column]) -> DataFrame:
    """Distinct matches under any condition: one equi-join each, where a join on an OR would be a nested loop."""
    parts = [left.join(right, c).select(*columns) for c in conditions]
    return reduce(DataFrame.unionByName, parts).distinct()


def insert_first(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows inserted in turn, the first of equal keys wins."""
    ranked = reduce(DataFrame.unionByName, [t.withColumn("__turn", F.lit(i)) for i, t in enumerate(tables)])
    return distinct_on(ranked, keys, [F.col("__turn")]).drop("__turn")


def semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left_anti")


def unordered_pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")]


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; fails where a key occurs twice, as a unique index would."""
    bad = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if bad:
        raise ValueError(f"duplicate key {bad[0].asDict()}")
    return df


def theta_levels(df: DataFrame, area: str, levels: list[tuple[int, float]]) -> DataFrame:
    """One row per level whose least area the row reaches: an inequality join without a join."""
    fit = F.filter(F.array(*(F.struct(F.lit(z).alias("level"), F.lit(float(a)).alias("least")) for z, a in levels)), lambda x: F.col(area) >= x["least"])
    return df.withColumn("__l", F.explode(fit)).withColumn("level", F.col("__l.level")).drop("__l")


def numbered(df: DataFrame, order: list[Column], name: str = "rn") -> DataFrame:
    """Adds the row number over the whole table in ``order``: ranges are numbered side by side, then laid end to end."""
    ranged = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    s = cut(ranged.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy(*order))), "numbered")
    parts = s.groupBy("__part").agg(F.count("*").alias("n"))  # as many rows as partitions
    before = parts.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return s.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + F.col("__at")).drop("__part", "__before", "__at")


def looked_up(df: DataFrame, column: str, table: DataFrame, name: str) -> DataFrame:
    """Adds the code of a column's value: of the patterns that match it, case ignored, the first one's (spelling, code); else that
    of its exact spelling; else null.  ``table``: spelling, code, is_pattern.

    Values are looked up once each, not once a row: patterns meet the distinct values, spellings are an equi-join.
    """
    values = df.select(F.col(column).alias("__value")).where(f"`{column}` is not null").distinct()
    patterns = table.where("is_pattern").select("spelling", "code").distinct()
    hit = values.join(patterns, F.expr("__value ilike spelling")).groupBy(F.col("__value").alias("__hit")).agg(F.min(F.struct("spelling", "code"))["code"].alias("__first"))
    exact = table.where("not is_pattern").groupBy(F.col("spelling").alias("__said")).agg(F.min("code").alias("__exact"))
    codes = values.join(hit, F.col("__value") == F.col("__hit"), "left").join(exact, F.col("__value") == F.col("__said"), "left")
    codes = codes.select("__value", F.coalesce("__first", "__exact").alias(name))
    return df.join(codes, F.col(column) == F.col("__value"), "left").drop("__value")
