"""``python -m tessellar.cli COMMAND``: the passes over feature files, each repeatable by itself."""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessellar.functions import mercator as m
from tessellar.functions.grid import Box
from tessellar.operators import cycle, index, keys, ledger, pyramid, tiles
from tessellar.plans import ladder
from tessellar.sources import features as src
from tessellar.sources import manifests, sinks
from tessellar.tables import sweep


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessellar", description=__doc__)
    p.add_argument("command", choices=["partition", "tiles", "run", "cells", "status", "viewport", "ladder"])
    p.add_argument("--input", nargs="+", help="Parquet files or folders, one for each theme")
    p.add_argument("--theme", nargs="+", choices=src.THEMES)
    p.add_argument("--output", required=False)
    p.add_argument("--bbox", nargs=4, type=float, metavar=("WEST", "SOUTH", "EAST", "NORTH"))
    p.add_argument("--budget", type=int, default=m.TILE_BYTES)
    p.add_argument("--z-max", type=int, default=m.Z_MAX)
    p.add_argument("--floor-z", type=int, default=0)
    p.add_argument("--row-bytes", type=int, default=400, help="estimated bytes of a row in a tile")
    p.add_argument("--limit", type=int, help="peels to work off in this run")
    p.add_argument("--release")
    p.add_argument("--dry-run", action="store_true")
    return p


def load(spark: SparkSession, a: argparse.Namespace):
    themes = a.theme or [None] * len(a.input)
    df = src.union_themes(*[src.read_features(spark, p, t) for p, t in zip(a.input, themes, strict=True)])
    return df.filter(src.overlaps(*a.bbox)) if a.bbox else df


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    if spark is not None:
        # the caller's session, whose tables others may read
        return command(a, spark)
    spark = SparkSession.builder.appName("tessellar").getOrCreate()
    try:
        command(a, spark)
    finally:
        logging.getLogger(__name__).info("swept %d bytes of intermediate tables", sweep(spark))


def command(a: argparse.Namespace, spark: SparkSession) -> None:
    if a.command == "partition":
        sinks.write_partitioned(keys.centred(load(spark, a)), a.output, "mercator_x", "mercator_y")
    elif a.command == "tiles":
        rows = tiles.in_leaves(load(spark, a), a.z_max)
        w = F.lit(a.row_bytes)
        rows = pyramid.split_oversize(rows, tiles.manifest(rows, a.budget, w), a.z_max)
        final = pyramid.merge_up(tiles.manifest(rows, a.budget, w, z_of_extent=False), a.budget, a.floor_z)
        if a.dry_run:
            final.groupBy("z").agg(F.count(F.lit(1)).alias("tiles"), F.sum("feature_count").alias("features")).orderBy("z").show()
            return
        out = pyramid.rekey(rows, final)
        sizes = sinks.write_tiles(out, f"{a.output}/tiles")
        entries = tiles.weighed(tiles.manifest(out, a.budget), sizes, a.budget).withColumnRenamed("weight", "size_bytes")
        manifests.write_json(entries, f"{a.output}/manifest")
    elif a.command == "run":
        state = cycle.load_state(spark, a.output)
        if a.dry_run:
            ledger.peels_left(spark, state["completed_peels_in_cycle"], limit=a.limit).show(1000)
            return
        state = cycle.run(spark, load(spark, a), a.output, a.budget, a.z_max, a.row_bytes, a.limit, a.release)
        index.write_document(*cycle.read_index(spark, state["index"]), f"{a.output}/index.json", state["cycle"], cycle.now())
    elif a.command == "cells":
        t = pyramid.quadtree(keys.fine_cells(keys.celled(load(spark, a), Box(*a.bbox) if a.bbox else None)), a.budget // a.row_bytes)
        t.groupBy("theme", "z").count().orderBy("theme", "z").show() if a.dry_run else sinks.write_table(t, a.output)
    elif a.command == "ladder":
        print(json.dumps(ladder.ladder(load(spark, a))))
    elif a.command == "status":
        ledger.rollup(spark.read.parquet(*a.input)).show(truncate=False)
    else:
        index.viewport(spark.read.schema(index.TILES).json(a.input), *a.bbox).orderBy("z", "x", "y").show(1000, truncate=False)


if __name__ == "__main__":
    main()
