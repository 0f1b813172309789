"""What has been done, and what is left: joins of keys against ledgers and tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.functions import mercator as m


def todo(all_keys: DataFrame, ledger: DataFrame, *keys: str, on_disk: DataFrame | None = None) -> DataFrame:
    """Keys that the ledger has neither as done nor as empty, and that aren't on disk."""
    out = all_keys.join(ledger.filter(F.col("status").isin("done", "empty")).select(*keys), list(keys), "left_anti")
    return out if on_disk is None else out.join(on_disk.select(*keys), list(keys), "left_anti")


def present(candidates: DataFrame, on_disk: DataFrame, *keys: str) -> DataFrame:
    return candidates.join(on_disk.select(*keys), list(keys), "left_semi")


def downloads(listed: DataFrame, ledger: DataFrame, on_disk: DataFrame) -> DataFrame:
    """file_key, size_bytes and action (skip, requeue or fetch): a file counts as there if the ledger has it as done and the file on
    disk (file_key, disk_bytes) has the listed size."""
    out = listed.join(ledger.select("file_key", "status"), "file_key", "left").join(on_disk.select("file_key", "disk_bytes"), "file_key", "left")
    there = (F.col("status") == "done") & (F.col("disk_bytes") == F.col("size_bytes"))
    action = F.when(there, "skip").when(F.col("status").isNotNull(), "requeue").otherwise("fetch")
    return out.select("file_key", "size_bytes", action.alias("action"))


def upsert(ledger: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """New rows take the place of those with equal keys."""
    return ledger.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def replace(tiles: DataFrame, gone: DataFrame, new: DataFrame) -> DataFrame:
    """Without the tiles in ``gone`` and with those in ``new``."""
    return tiles.join(gone.select("z", "x", "y"), ["z", "x", "y"], "left_anti").unionByName(new)


def counts_match(cached: DataFrame, live: DataFrame, *keys: str) -> DataFrame:
    """``complete``: the count kept beside a tile (text) is the count of its rows."""
    out = cached.join(live.select(*keys, F.col("n").alias("_live")), list(keys), "left")
    return out.withColumn("complete", F.coalesce(F.expr("try_cast(cached as bigint)") == F.coalesce("_live", F.lit(0)), F.lit(False))).drop("_live")


def rollup(ledger: DataFrame) -> DataFrame:
    """Counts by status and bytes of what is done, for each theme."""
    n = lambda s: F.count_if(F.col("status") == s).alias(f"n_{s}")
    done = F.count_if(F.col("status") == "done")
    return ledger.groupBy("theme").agg(*[n(s) for s in ("done", "empty", "failed", "in_progress")], F.coalesce(F.sum(F.when(F.col("status") == "done", F.col("size_bytes"))), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("visited"), (done * 100.0 / F.count(F.lit(1))).alias("percent"))


def run_counters(tiles: DataFrame) -> DataFrame:
    return tiles.agg(F.count_if(F.col("status") == "done").alias("written"), F.count_if(F.col("status") == "empty").alias("empty"), F.count_if(F.col("oversize")).alias("oversize"), F.count_if(F.col("status") == "failed").alias("failed"))


def peels_left(spark, completed: list[int], start: int | None = None, limit: int | None = None, width: int = m.PEEL_DEG) -> DataFrame:
    """Peels in the order of work, without those completed, from ``start`` on."""
    n = m.peel_count(width)
    rows = spark.range(n).select(F.col("id").cast("int").alias("peel_idx")).withColumn("ord", F.pmod(F.col("peel_idx") - n // 2, F.lit(n)))
    rows = rows.filter(~F.col("peel_idx").isin(completed)) if completed else rows
    if start is not None:
        rows = rows.filter(F.col("ord") >= (start - n // 2) % n)
    rows = rows.orderBy("ord")
    return rows if limit is None else rows.limit(limit)
