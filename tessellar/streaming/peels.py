"""Peel manifests as a stream of files: each batch refreshes the index. Batches are idempotent by key, and the checkpoint
remembers which files were taken, so a run can be stopped and taken up again. There is no event time here, and so no
watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.operators import index
from tessellar.tables import shared_dir

ENTRY = "peel_idx int, z int, x int, y int, size_bytes long, feature_count long, theme_counts map<string,bigint>, bbox array<double>"


def take_in(spark: SparkSession, source: str, target: str, checkpoint: str, vintage: str, files_per_batch: int = 1):
    """Read new manifests below ``source`` and keep the index table below ``target``, one folder for each version."""

    def refresh(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        before = s.read.schema(index.TILES).parquet(f"{target}/v={number - 1}") if number else s.createDataFrame([], index.TILES)
        tiles = before
        # as many peels as files at most
        for r in batch.select("peel_idx").distinct().orderBy("peel_idx").collect():
            tiles = index.refresh(tiles, batch.filter(F.col("peel_idx") == r["peel_idx"]), r["peel_idx"], vintage)
        tiles.write.mode("overwrite").parquet(f"{target}/v={number}")

    stream = spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def demo(spark: SparkSession, tiles: DataFrame) -> DataFrame:
    """Two manifests through the stream; the last version of the index."""
    path = shared_dir(spark)
    for i, x in ((18, 32), (19, 34)):
        part = tiles.filter(F.col("x") == x).withColumn("peel_idx", F.lit(i)).select("peel_idx", "z", "x", "y", "size_bytes", "feature_count", "theme_counts", "bbox")
        part.coalesce(1).write.mode("append").parquet(f"{path}/in")
    take_in(spark, f"{path}/in", f"{path}/index", f"{path}/checkpoint", "2026-01-01T00:00:00Z").awaitTermination()
    return spark.read.schema(index.TILES).parquet(f"{path}/index/v=1").select("z", "x", "y", "feature_count")
