"""A run over peels: each goes from features to written tiles and into the index. What is done is kept beside the tiles, so that a run
that ended goes on where it was, and a cycle ends when all peels are done."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.functions import mercator as m
from tessellar.operators import index, keys, ledger, pyramid, tiles
from tessellar.sources import manifests, sinks
from tessellar.tables import materialize

#: Fields of the state, in the ledger's names, and where the index of that state lies.
STATE = f"{manifests.STATE}, seq long, index string"
KEY = ["z", "x", "y"]


def now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def load_state(spark: SparkSession, root: str) -> dict:
    """The last state that was saved, or that of a run which hasn't begun."""
    rows = manifests.read_json(spark, f"{root}/state", STATE, lines=True).orderBy(F.col("seq").desc()).limit(1).collect()
    return rows[0].asDict() if rows else {"cycle": 1, "completed_peels_in_cycle": [], "last_completed_at": None, "started_at": now(), "release": None, "seq": 0, "index": None}


def save_state(spark: SparkSession, root: str, state: dict) -> dict:
    """States are added, never overwritten: the one with the highest number counts, so a save is whole or absent."""
    state = {**state, "seq": state["seq"] + 1}
    spark.createDataFrame([state], STATE).coalesce(1).write.mode("append").json(f"{root}/state")
    return state


def read_index(spark: SparkSession, path: str | None) -> tuple[DataFrame, DataFrame]:
    return (spark.read.schema(index.TILES).parquet(f"{path}/tiles"), spark.read.schema(index.PEELS).parquet(f"{path}/peels")) if path else index.empty_index(spark)


def tile_peel(features: DataFrame, peel_idx: int, path: str, budget: int, z_max: int, row_bytes: int, floor_z: int = m.Z_BUCKET) -> DataFrame:
    """Writes a peel's tiles and returns their manifest, with measured bytes. Tiles are split and merged by an estimate of bytes; a merged one
    that turns out to be over budget is split again, until none is."""
    own = keys.in_peels(features, own_columns=True).filter(F.col("peel_idx") == peel_idx).drop("peel_idx", "mercator_x", "mercator_y")
    rows = tiles.in_leaves(own, z_max)
    weight = F.lit(row_bytes)
    rows = materialize(pyramid.split_oversize(rows, tiles.manifest(rows, budget, weight), z_max))
    base = materialize(tiles.manifest(rows, budget, weight, z_of_extent=False))
    final = materialize(pyramid.merge_up(base, budget, floor_z).select(*KEY))
    sizes = sinks.write_tiles(pyramid.rekey(rows, final), path)
    while True:
        over, kids = pyramid.split_measured(final, base, sizes, budget)
        over, kids = materialize(over), materialize(kids)
        if over.isEmpty():
            break
        fresh = sinks.write_tiles(pyramid.rekey(rows, kids), path)
        sinks.delete_tiles(over, path)
        sizes = sizes.join(over, KEY, "left_anti").unionByName(fresh)
        final = materialize(final.join(over, KEY, "left_anti").unionByName(kids))
    return tiles.weighed(pyramid.entries(base, final, budget), sizes, budget).withColumnRenamed("weight", "size_bytes")


def run(spark: SparkSession, features: DataFrame, root: str, budget: int = m.TILE_BYTES, z_max: int = m.Z_MAX, row_bytes: int = 400, limit: int | None = None, release: str | None = None) -> dict:
    """Works off the peels that are left in the cycle, ``limit`` at most, and returns the state. A peel's tiles are written, then the index in a folder
    of its own, then the state that names it; whatever stops before that is done again."""
    state = load_state(spark, root)
    state["release"] = release or state["release"]
    # one row for each peel, 36 at ten degrees
    for r in ledger.peels_left(spark, state["completed_peels_in_cycle"], limit=limit).collect():
        peel, at = r["peel_idx"], now()
        done = materialize(tile_peel(features, peel, f"{root}/tiles", budget, z_max, row_bytes))
        old, peels = read_index(spark, state["index"])
        path = f"{root}/index/{state['cycle']:04d}-{peel:03d}-{state['seq']:06d}"
        index.refresh(old, done, peel, at).repartitionByRange(*KEY).sortWithinPartitions(*KEY).write.mode("overwrite").parquet(f"{path}/tiles")
        index.stamp(peels, peel, at).coalesce(1).write.mode("overwrite").parquet(f"{path}/peels")
        state |= {"completed_peels_in_cycle": sorted({*state["completed_peels_in_cycle"], peel}), "last_completed_at": now(), "index": path}
        state = save_state(spark, root, state)
    if len(state["completed_peels_in_cycle"]) >= m.peel_count():
        state = save_state(spark, root, {**state, "cycle": state["cycle"] + 1, "completed_peels_in_cycle": []})
    return state
