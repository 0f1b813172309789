"""The global index: a table of tiles with their vintage, and a table of peels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.functions import mercator as m

TILES = "z int, x int, y int, size_bytes long, feature_count long, theme_counts map<string,long>, bbox array<double>, vintage string"
PEELS = "peel_idx int, lng_lo double, lng_hi double, vintage string"
SCHEMA_VERSION = 1


def empty_index(spark: SparkSession, width: int = m.PEEL_DEG) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame([], TILES), spark.createDataFrame([(i, *m.peel_range(i, width), None) for i in range(m.peel_count(width))], PEELS)


def public(entries: DataFrame, vintage: str) -> DataFrame:
    """The fields of tile entries that consumers see."""
    has = lambda c, d: F.coalesce(F.col(c), d) if c in entries.columns else d
    return entries.select("z", "x", "y", F.col("size_bytes").cast("long").alias("size_bytes"), has("feature_count", F.lit(0)).cast("long").alias("feature_count"), has("theme_counts", F.create_map().cast("map<string,bigint>")).alias("theme_counts"), "bbox", F.lit(vintage).alias("vintage"))


def refresh(tiles: DataFrame, new: DataFrame, peel_idx: int, vintage: str, width: int = m.PEEL_DEG) -> DataFrame:
    """Tiles whose centre lies in the peel are replaced by the new ones, and so are tiles of equal address elsewhere, so
    that peels that share a bucket column leave no doubles."""
    lo, hi = m.peel_range(peel_idx, width)
    centre = m.centre_lng(F.col("bbox")[0], F.col("bbox")[2])
    kept = tiles.filter(~((centre >= lo) & (centre < hi)))
    return kept.join(new.select("z", "x", "y"), ["z", "x", "y"], "left_anti").unionByName(public(new, vintage))


def stamp(peels: DataFrame, peel_idx: int, vintage: str, width: int = m.PEEL_DEG) -> DataFrame:
    """The peel's vintage; a peel that isn't there is added."""
    spark = peels.sparkSession
    own = spark.createDataFrame([(peel_idx, *m.peel_range(peel_idx, width), vintage)], PEELS)
    return peels.filter(F.col("peel_idx") != peel_idx).unionByName(own)


def remove_peel(tiles: DataFrame, peel_idx: int, width: int = m.PEEL_DEG) -> DataFrame:
    return refresh(tiles, tiles.limit(0), peel_idx, "", width)


def viewport(tiles: DataFrame, west: float, south: float, east: float, north: float, z_min: int | None = None, z_max: int | None = None) -> DataFrame:
    """Tiles whose box overlaps the view; touching edges don't count."""
    w, s, e, n = (F.col("bbox")[i] for i in range(4))
    out = tiles.filter((e > west) & (w < east) & (n > south) & (s < north))
    if z_min is not None:
        out = out.filter(F.col("z") >= z_min)
    return out if z_max is None else out.filter(F.col("z") <= z_max)


def export(tiles: DataFrame, peels: DataFrame, path: str, cycle: int, generated_at: str) -> None:
    """The index as a folder of JSON: ``head`` (one row), ``tiles`` in order over as many files as there are
    partitions, and ``peels``."""
    head = tiles.agg(F.count(F.lit(1)).alias("tile_count")).select(F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(generated_at).alias("generated_at"), F.lit(cycle).alias("cycle"), "tile_count")
    head.write.mode("overwrite").json(f"{path}/head")
    tiles.orderBy("z", "x", "y").write.mode("overwrite").json(f"{path}/tiles")
    peels.orderBy("peel_idx").coalesce(1).write.mode("overwrite").json(f"{path}/peels")


def document(tiles: DataFrame, peels: DataFrame, cycle: int, generated_at: str) -> DataFrame:
    """The index as the lines of one JSON document (n, line): a head, the peels, and a tile a line, in order; joined by nothing they are the
    document. No row holds more than a tile or the peels."""
    body = tiles.select("z", "x", "y", F.to_json(F.struct("z", "x", "y", "size_bytes", "feature_count", "theme_counts", "bbox", "vintage")).alias("line"))
    head = tiles.agg(F.count(F.lit(1)).alias("tile_count"))
    peel_list = peels.agg(F.sort_array(F.collect_list(F.struct("peel_idx", "lng_lo", "lng_hi", "vintage"))).alias("peels"))
    first = F.to_json(F.struct(F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(generated_at).alias("generated_at"), F.lit(cycle).alias("cycle"), "tile_count", "peels"), {"ignoreNullFields": "false"})
    top = head.crossJoin(F.broadcast(peel_list)).select(F.lit(-1).alias("z"), F.lit(0).alias("x"), F.lit(0).alias("y"), F.regexp_replace(first, r"\}$", ',"tiles":[').alias("line"))
    tail = top.select(F.lit(1 << 30).alias("z"), "x", "y", F.lit("]}").alias("line"))
    # a comma before each tile but the first
    least = tiles.agg(F.min(F.struct("z", "x", "y")).alias("least"))
    body = body.crossJoin(F.broadcast(least)).select("z", "x", "y", F.concat(F.when(F.struct("z", "x", "y") == F.col("least"), "").otherwise(","), "line").alias("line"))
    return top.unionByName(body).unionByName(tail).orderBy("z", "x", "y")


def write_document(tiles: DataFrame, peels: DataFrame, path: str, cycle: int, generated_at: str) -> None:
    """The one file of ``document``, in a folder: for consumers that fetch a single file."""
    document(tiles, peels, cycle, generated_at).select("line").coalesce(1).write.mode("overwrite").text(path)
