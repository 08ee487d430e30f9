from pyspark.sql import functions as F

from cartolith.plans.catalogue import points
from cartolith.streaming import tile_counts

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    table = points(lambda t: spark.read.parquet(f"{SF}/{t}.parquet")).select("ts", "lon", "lat")
    table.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    q = tile_counts(stream, 3, "1 day").writeStream.outputMode("complete").format("memory").queryName("tile_counts").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("tile_counts").select(F.col("window.start").alias("s"), "x", "y", "n")
    want = tile_counts(table, 3, "1 day").select(F.col("window.start").alias("s"), "x", "y", "n")
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
