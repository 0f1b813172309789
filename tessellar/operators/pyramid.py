"""Splitting tiles that are over budget and merging sets of small siblings upward."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.functions import grid
from tessellar.functions import mercator as m
from tessellar.sources.features import overlaps
from tessellar.tables import materialize


def split_oversize(rows: DataFrame, tiles: DataFrame, z: int) -> DataFrame:
    """Rows (z, x, y, ...) of tiles: those of oversize tiles at zoom z go to the children that they overlap; a child without rows
    isn't there, and a child still over budget stays. One level only."""
    big = tiles.filter((F.col("z") == z) & F.col("oversize") & (F.col("status") == "done")).select("z", "x", "y")
    rest = rows.join(big, ["z", "x", "y"], "left_anti")
    parts = rows.join(big, ["z", "x", "y"]).withColumn("_k", F.explode(m.children("z", "x", "y")))
    parts = parts.withColumns({c: F.col(f"_k.{c}") for c in "zxy"}).drop("_k")
    e = m.extent(z + 1, "x", "y")
    return rest.unionByName(parts.filter(overlaps(e["west"], e["south"], e["east"], e["north"])))


def merge_up(tiles: DataFrame, budget: int, floor_z: int = 0, measures: tuple[str, ...] = ("feature_count",), count_empty: bool = False) -> DataFrame:
    """The tiles (z, x, y, weight, measures) after merging: from the deepest level up, four siblings become their parent if their weights
    sum to no more than the budget. Measures add up, so rows that straddle siblings count once for each.

    A loop over at most 15 levels of the manifest; a level holds the tiles of that zoom and the parents just made,
    and is cut from its past by a written table. ``count_empty``: addresses with status ``empty`` make up for siblings.
    """
    columns = ["z", "x", "y", "weight", *measures]
    if count_empty and "status" in tiles.columns:
        tiles = tiles.filter("status in ('done', 'empty')")
    elif "status" in tiles.columns:
        tiles = tiles.filter("status = 'done'")
    tiles = tiles.select(*columns)
    levels = sorted((r["z"] for r in tiles.select("z").distinct().collect()), reverse=True)
    if not levels:
        return tiles
    settled, up = [tiles.filter(F.col("z") <= floor_z)], None
    for z in range(levels[0], floor_z, -1):
        here = tiles.filter(F.col("z") == z)
        here = here if up is None else here.unionByName(up)
        key = {"_x": m.ancestor("x", 1), "_y": m.ancestor("y", 1)}
        groups = here.withColumns(key).groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("kids"), *[F.sum(c).alias(c) for c in columns[3:]])
        up = materialize(groups.filter((F.col("kids") == 4) & (F.col("weight") <= budget)).select(F.lit(z - 1).alias("z"), F.col("_x").alias("x"), F.col("_y").alias("y"), *columns[3:]))
        settled.append(here.withColumns(key).join(up.select(F.col("x").alias("_x"), F.col("y").alias("_y")), ["_x", "_y"], "left_anti").select(*columns))
    out = settled[0]
    for s in [*settled[1:], *([] if up is None else [up])]:
        out = out.unionByName(s)
    return out


def merge_step(tiles: DataFrame, budget: int) -> DataFrame:
    """One level: the parents that can form from the deepest tiles (z, x, y, weight, feature_count)."""
    deep = tiles.agg(F.coalesce(F.max("z"), F.lit(m.Z_MAX)).alias("_deep"))
    here = tiles.join(F.broadcast(deep), F.col("z") == F.col("_deep"))
    groups = here.groupBy((F.col("z") - 1).alias("z"), m.ancestor("x", 1).alias("x"), m.ancestor("y", 1).alias("y"))
    return groups.agg(F.count(F.lit(1)).alias("kids"), F.sum("weight").alias("weight"), F.sum("feature_count").alias("feature_count")).filter((F.col("kids") == 4) & (F.col("weight") <= budget)).drop("kids")


def rekey(rows: DataFrame, final: DataFrame, dedupe: str | None = None) -> DataFrame:
    """Rows of leaves with the tile of the merged set that holds their leaf. Ancestors are looked up once for each leaf, not for
    each row. ``dedupe``: a column by which a tile keeps one row each."""
    leaf = rows.select("z", "x", "y").distinct()
    up = leaf.withColumn("_d", F.explode(F.sequence(F.lit(0), F.col("z")))).withColumns({"_z": F.col("z") - F.col("_d"), "_x": m.ancestor("x", F.col("_d")), "_y": m.ancestor("y", F.col("_d"))})
    found = up.join(final.select(F.col("z").alias("_z"), F.col("x").alias("_x"), F.col("y").alias("_y")), ["_z", "_x", "_y"])
    out = rows.join(found.select("z", "x", "y", "_z", "_x", "_y"), ["z", "x", "y"]).drop("z", "x", "y").withColumnsRenamed({"_z": "z", "_x": "x", "_y": "y"})
    return out.dropDuplicates(["z", "x", "y", dedupe]) if dedupe else out


def entries(tiles: DataFrame, final: DataFrame, budget: int) -> DataFrame:
    """The manifest of the merged set: feature_count, theme_counts, weight, oversize, status and bbox of each final tile, added up over the
    tiles (with theme_counts) that it took in. Works on the manifest, not on rows."""
    up = rekey(tiles.filter("status = 'done'").select("z", "x", "y", "feature_count", "weight", "theme_counts"), final)
    themes = up.select("z", "x", "y", F.explode("theme_counts").alias("theme", "n")).groupBy("z", "x", "y", "theme").agg(F.sum("n").alias("n"))
    themes = themes.groupBy("z", "x", "y").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("theme", "n")))).alias("theme_counts"))
    out = up.groupBy("z", "x", "y").agg(F.sum("feature_count").alias("feature_count"), F.sum("weight").alias("weight")).join(themes, ["z", "x", "y"], "left")
    e = m.extent(F.col("z"), "x", "y")
    return out.withColumns({"oversize": F.col("weight") > budget, "status": F.lit("done"), "bbox": F.array(e["west"], e["south"], e["east"], e["north"])})


def split_measured(final: DataFrame, base: DataFrame, sizes: DataFrame, budget: int) -> tuple[DataFrame, DataFrame]:
    """(over, kids): merged tiles whose measured size_bytes is over budget, and the four that take the place of each. A tile of ``base`` wasn't
    merged and stays."""
    key = ["z", "x", "y"]
    over = final.select(*key).join(sizes.filter(F.col("size_bytes") > budget).select(*key), key, "left_semi").join(base.select(*key), key, "left_anti")
    kids = over.select(F.explode(m.children("z", "x", "y")).alias("k")).select("k.z", "k.x", "k.y")
    return over, kids


def quadtree(fine: DataFrame, budget: int, min_deg: float = grid.MIN_CELL_DEG, weight: str | None = None) -> DataFrame:
    """Tiles (theme, z, x, y, box, n, weight) of rows in 0.1 degree cells (theme, x, y, bbox): a tile over budget is split into quadrants
    until it is within, or no wider than ``min_deg``.

    A row whose box covers its tile is in all parts of the tile, so it goes on as a count that they inherit. Only rows with an
    edge inside a tile over budget are dealt to its quadrants, eight rounds at most: their copies grow with the length of
    their edges, not with their area, and the tiles with the result.
    """
    w = F.lit(1) if weight is None else F.col(weight)
    # a struct, so that rows without a theme meet
    rows = fine.select(F.struct("theme").alias("_t"), F.lit(0).alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "bbox", w.cast("long").alias("w"))
    rows = rows.withColumns(grid.cell_box(F.col("y"), F.col("x")))
    key, box = ["_t", "z", "x", "y"], ["west", "south", "east", "north"]
    covers = (F.col("bbox.xmin") <= F.col("west")) & (F.col("bbox.xmax") >= F.col("east")) & (F.col("bbox.ymin") <= F.col("south")) & (F.col("bbox.ymax") >= F.col("north"))
    measures = [F.count(F.lit(1)).alias("n"), F.sum("w").alias("weight"), F.count_if("_covers").alias("_n"), F.coalesce(F.sum(F.when(F.col("_covers"), F.col("w"))), F.lit(0)).alias("_w")]
    over = (F.col("weight") > budget) & (F.col("east") - F.col("west") > min_deg + 1e-9)
    done, kids = [], None
    while True:
        rows = rows.withColumn("_covers", covers)
        rows = rows if kids is None else materialize(rows)
        sums = rows.groupBy(*key, *box).agg(*measures)
        if kids is not None:
            own = sums.drop(*box).withColumnsRenamed({c: f"_own{c}" for c in ("n", "weight", "_n", "_w")})
            total = {"n": "_n", "weight": "_w", "_n": "_n", "_w": "_w"}
            sums = kids.join(own, key, "left").select(*key, *box, *[(F.col(b) + F.coalesce(f"_own{c}", F.lit(0))).alias(c) for c, b in total.items()]).filter("n > 0")
        sums = materialize(sums)
        done.append(sums.filter(~over))
        big = sums.filter(over)
        if big.isEmpty():
            break
        split = lambda df: df.withColumn("_k", F.explode(grid.quadrants())).withColumns({c: F.col(f"_k.{c}") for c in (*key[1:], *box)}).drop("_k")
        kids = split(big.select(*key, *box, "_n", "_w"))
        rows = split(rows.filter("not _covers").drop("_covers").join(big.select(*key), key, "left_semi")).filter(overlaps(*[F.col(c) for c in box]))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(F.col("_t.theme").alias("theme"), "z", "x", "y", *box, "n", "weight")
