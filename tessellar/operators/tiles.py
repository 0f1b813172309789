"""Tiles of features: which leaves a bucket's rows are in, and what each tile holds.

A range join of boxes and tile extents would plan as a nested loop. Instead each box brings the addresses of the tiles
that it can overlap, one more on each side against rounding, held to its own bucket before they are made, and
the exact test decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.functions import mercator as m
from tessellar.operators.keys import centred
from tessellar.sources.features import overlaps


def in_leaves(features: DataFrame, z: int) -> DataFrame:
    """A row for each leaf at zoom z >= 6 of the feature's own bucket that its box overlaps (z, x, y)."""
    if z < m.Z_BUCKET:
        raise ValueError(f"leaves lie at z={m.Z_BUCKET} or deeper: {z}")
    n, side = 1 << z, 1 << (z - m.Z_BUCKET)
    b = centred(features)
    col = lambda c: F.floor((F.col(f"bbox.{c}") + 180.0) / 360.0 * n)
    lat = lambda c: m.tile_y(m.clamp_lat(f"bbox.{c}"), z)
    lo = lambda c, bucket: F.greatest(c - 1, F.col(bucket) * side)
    hi = lambda c, bucket: F.least(c + 1, F.col(bucket) * side + side - 1)
    b = b.withColumns({"_a": lo(col("xmin"), "mercator_x"), "_b": hi(col("xmax"), "mercator_x"), "_c": lo(lat("ymax"), "mercator_y"), "_d": hi(lat("ymin"), "mercator_y")})
    # an outer explode with the guard inside: a filter on these bounds would be pushed down and repeat their formulas,
    # and rows without a tile go by the exact test
    each = lambda lo, hi: F.explode_outer(F.when(F.col(hi) >= F.col(lo), F.sequence(F.col(lo).cast("int"), F.col(hi).cast("int"))))
    b = b.withColumn("z", F.lit(z)).withColumn("x", each("_a", "_b")).withColumn("y", each("_c", "_d"))
    e = m.extent(z, "x", "y")
    return b.filter(overlaps(e["west"], e["south"], e["east"], e["north"])).drop("_a", "_b", "_c", "_d", "mercator_x", "mercator_y")


def counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows by tile and theme; partial sums meet, so a crowded tile costs no more than any other."""
    return rows.groupBy(*(keys or ("z", "x", "y")), "theme").agg(F.count(F.lit(1)).alias("n"))


def manifest(rows: DataFrame, budget: int, weight: Column | None = None, z_of_extent: bool = True) -> DataFrame:
    """A row for each tile with rows: feature_count, theme_counts, weight, oversize and bbox.

    ``weight``: of a row, 1 by default. Production replaces it by measured bytes, see ``weighed``.
    """
    w = F.lit(1) if weight is None else weight
    t = rows.groupBy("z", "x", "y", F.coalesce("theme", F.lit("unknown")).alias("theme")).agg(F.count(F.lit(1)).alias("n"), F.sum(w).cast("long").alias("w"))
    t = t.groupBy("z", "x", "y").agg(F.sum("n").alias("feature_count"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("theme", "n")))).alias("theme_counts"), F.sum("w").alias("weight"))
    t = t.withColumn("oversize", F.col("weight") > budget).withColumn("status", F.lit("done"))
    if z_of_extent:
        e = m.extent(F.col("z"), "x", "y")
        t = t.withColumn("bbox", F.array(e["west"], e["south"], e["east"], e["north"]))
    return t


def weighed(tiles: DataFrame, sizes: DataFrame, budget: int) -> DataFrame:
    """The manifest with measured bytes (z, x, y, size_bytes) for weights."""
    out = tiles.drop("weight", "oversize").join(sizes.select("z", "x", "y", F.col("size_bytes").alias("weight")), ["z", "x", "y"], "left")
    return out.withColumn("oversize", F.coalesce(F.col("weight") > budget, F.lit(False)))


def with_empty(tiles: DataFrame, all_keys: DataFrame) -> DataFrame:
    """Also the addresses without rows, as ``empty``."""
    return all_keys.select("z", "x", "y").join(tiles, ["z", "x", "y"], "left").withColumn("status", F.coalesce("status", F.lit("empty"))).fillna({"feature_count": 0, "weight": 0, "oversize": False})
