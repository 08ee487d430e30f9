"""Layers over a stream of features, beyond the batch engine: late points are dropped by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tiles import tile_x, tile_y


def tile_counts(points: DataFrame, zoom: int, window: str = "10 minutes", late: str = "10 minutes", time: str = "ts") -> DataFrame:
    """(ts, lon, lat) -> window, x, y, n: counts per tile and time window; works on streams and on tables alike."""
    p = points.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).withColumns({"x": tile_x(F.col("lon"), zoom), "y": tile_y(F.col("lat"), zoom)})
    return p.groupBy(F.window(time, window).alias("window"), "x", "y").agg(F.count("*").alias("n"))
