"""One query for each operator, over the feature view of the test tables. Budgets and regions are small enough for the
test tables to split and merge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessellar.functions import grid, values
from tessellar.functions import mercator as m
from tessellar.operators import index, keys, ledger, pyramid, tiles
from tessellar.plans.view import features, plain
from tessellar.sources import manifests, sinks
from tessellar.sources import features as src
from tessellar.streaming import peels
from tessellar.tables import materialize, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

BAND = (0.0, 10.0)
CITY = grid.Box(12.0, 55.0, 12.5, 55.5)
REGION = grid.Box(-30.0, 30.0, 20.0, 60.0)
LEAF_Z, BUDGET, SPLIT_BUDGET = 8, 20, 50
VINTAGE = "2026-01-01T00:00:00Z"


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def box_columns() -> list:
    return [F.col(f"bbox.{c}").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]


@query
def features_scan(spark, sf):
    return features(spark, sf).select("id", "theme", *box_columns())


@query
def theme_counts(spark, sf):
    return plain(spark, sf).groupBy("theme").agg(F.count(F.lit(1)).alias("n"))


@query
def filtered_count(spark, sf):
    return features(spark, sf).filter(src.overlaps(*vars(REGION).values())).agg(F.count(F.lit(1)).alias("n"))


@query
def union_themes(spark, sf):
    f = features(spark, sf)
    parts = [f.filter(F.col("theme") == t) for t in src.THEMES]
    parts = [p.withColumn("extra", F.col("id") % 7) if i % 2 else p.withColumn("names", F.struct(F.col("theme").alias("common"))) for i, p in enumerate(parts)]
    return src.union_themes(*parts).groupBy("theme").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("extra").isNull()).alias("n_null_extra"), F.count("names.common").alias("n_names"))


@query
def theme_literal(spark, sf):
    f = features(spark, sf).filter(F.col("theme").isin(src.check_themes(["water", "land"])))
    return f.withColumn("theme", F.lit("water")).groupBy("theme").agg(F.count(F.lit(1)).alias("n"))


@query
def bbox_overlap(spark, sf):
    return features(spark, sf).filter(src.overlaps(*vars(CITY).values())).select("id")


@query
def region_filter(spark, sf):
    return keys.celled(features(spark, sf), REGION).select("id")


@query
def lng_band(spark, sf):
    return features(spark, sf).filter(src.lng_band(*BAND)).select("id")


@query
def z6_key(spark, sf):
    return keys.centred(features(spark, sf)).select("id", F.col("mercator_x").alias("x"), F.col("mercator_y").alias("y"))


@query
def z6_counts(spark, sf):
    return z6_key(spark, sf).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))


@query
def z6_theme_counts(spark, sf):
    return keys.centred(features(spark, sf)).groupBy(F.col("mercator_x").alias("x"), F.col("mercator_y").alias("y"), "theme").agg(F.count(F.lit(1)).alias("n"))


@query
def z14_key(spark, sf):
    return keys.keyed(features(spark, sf), m.Z_MAX).select("id", "x", "y")


def addresses(spark, zooms):
    z = spark.createDataFrame([(z,) for z in zooms], "z int")
    x = F.explode(F.sequence(F.lit(0), F.expr("cast(power(2, z) as int) - 1")))
    return z.withColumn("x", x).withColumn("y", x)


@query
def tile_extent(spark, sf):
    e = m.extent(F.col("z"), "x", "y")
    return addresses(spark, range(5)).select("z", "x", "y", *[F.round(c, 9).alias(k) for k, c in e.items()])


@query
def parent_child(spark, sf):
    k = addresses(spark, range(4)).withColumn("k", F.explode(m.children("z", "x", "y")))
    return k.select(F.col("k.z").alias("z"), F.col("k.x").alias("x"), F.col("k.y").alias("y"), m.ancestor("k.x", 1).alias("parent_x"), m.ancestor("k.y", 1).alias("parent_y"))


@query
def bucket_leaves(spark, sf):
    b = spark.createDataFrame([(33, 20), (0, 63)], "x6 int, y6 int")
    x, y = m.leaves("x6", "y6", LEAF_Z)
    return b.withColumn("x", F.explode(x)).withColumn("y", F.explode(y))


@query
def peel_table(spark, sf):
    return ledger.peels_left(spark, []).select("peel_idx", (F.col("peel_idx") * 10.0 - 180.0).alias("lng_lo"), (F.col("peel_idx") * 10.0 - 170.0).alias("lng_hi"), F.col("ord").cast("int").alias("ord"))


@query
def peel_order(spark, sf):
    return ledger.peels_left(spark, [18, 20], start=19, limit=10).select("peel_idx", F.col("ord").cast("int").alias("ord"))


@query
def peel_keys(spark, sf):
    rows = [(i, x, y) for i in range(m.peel_count()) for x, y in m.buckets_of_range(*m.peel_range(i))]
    return spark.createDataFrame(rows, "peel_idx int, x int, y int")


@query
def peel_partition(spark, sf):
    return keys.in_peels(features(spark, sf)).groupBy("peel_idx", F.col("mercator_x").alias("x"), F.col("mercator_y").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query
def peel_own_partition(spark, sf):
    return keys.in_peels(features(spark, sf), own_columns=True).groupBy("peel_idx", F.col("mercator_x").alias("x"), F.col("mercator_y").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query
def leaf_tiles(spark, sf):
    return tiles.counts(tiles.in_leaves(features(spark, sf), LEAF_Z))


def weights():
    return F.lit(1) + F.col("id") % 3


@query
def leaf_manifest(spark, sf):
    return tiles.manifest(tiles.in_leaves(features(spark, sf), LEAF_Z), BUDGET, weights()).select("z", "x", "y", "feature_count", "weight", "oversize")


@query
def leaf_theme_maps(spark, sf):
    t = tiles.manifest(tiles.in_leaves(features(spark, sf), m.Z_BUCKET), BUDGET)
    return t.select("z", "x", "y", F.coalesce(F.col("theme_counts")["water"], F.lit(0)).alias("water"), F.coalesce(F.col("theme_counts")["land"], F.lit(0)).alias("land"), F.size("theme_counts").alias("themes"), *[F.round(F.col("bbox")[i], 9).alias(c) for i, c in enumerate(("west", "south", "east", "north"))])


@query
def empty_tiles(spark, sf):
    t = tiles.manifest(tiles.in_leaves(features(spark, sf), m.Z_BUCKET), BUDGET)
    return tiles.with_empty(t, addresses(spark, [m.Z_BUCKET])).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("feature_count").alias("features"))


@query
def run_counters(spark, sf):
    t = tiles.manifest(tiles.in_leaves(features(spark, sf), m.Z_BUCKET), BUDGET)
    return ledger.run_counters(tiles.with_empty(t, addresses(spark, [m.Z_BUCKET])))


@query
def phase_a_split(spark, sf):
    rows = tiles.in_leaves(features(spark, sf), m.Z_BUCKET)
    out = pyramid.split_oversize(rows, tiles.manifest(rows, SPLIT_BUDGET), m.Z_BUCKET)
    return out.groupBy("z", "x", "y").agg(F.count(F.lit(1)).alias("n"))


def base_tiles(spark, sf, z=m.Z_BUCKET):
    return tiles.manifest(tiles.in_leaves(features(spark, sf), z), BUDGET, z_of_extent=False)


@query
def phase_b_step(spark, sf):
    return pyramid.merge_step(base_tiles(spark, sf), BUDGET).select("z", "x", "y", F.col("feature_count").alias("n"))


@query
def phase_b_full(spark, sf):
    return pyramid.merge_up(materialize(base_tiles(spark, sf)), BUDGET).select("z", "x", "y", F.col("feature_count").alias("n"))


@query
def phase_b_wide(spark, sf):
    return pyramid.merge_up(materialize(base_tiles(spark, sf)), 60).select("z", "x", "y", F.col("feature_count").alias("n"))


@query
def phase_b_floor6(spark, sf):
    return pyramid.merge_up(materialize(base_tiles(spark, sf, LEAF_Z)), BUDGET, floor_z=6).select("z", "x", "y", F.col("feature_count").alias("n"))


@query
def phase_b_rekey(spark, sf):
    rows = tiles.in_leaves(features(spark, sf), m.Z_BUCKET)
    final = pyramid.merge_up(materialize(base_tiles(spark, sf)), BUDGET)
    return pyramid.rekey(rows, final).groupBy("z", "x", "y", "theme").agg(F.count(F.lit(1)).alias("n"))


@query
def merged_entries(spark, sf):
    """The manifest of the merged set, with counts by theme."""
    base = materialize(tiles.manifest(tiles.in_leaves(features(spark, sf), m.Z_BUCKET), BUDGET))
    t = pyramid.entries(base, pyramid.merge_up(base, BUDGET), BUDGET)
    return t.select("z", "x", "y", "feature_count", "oversize", F.coalesce(F.col("theme_counts")["water"], F.lit(0)).alias("water"), F.size("theme_counts").alias("themes"), *[F.round(F.col("bbox")[i], 9).alias(c) for i, c in enumerate(("west", "south", "east", "north"))])


CELLS = ("_lon_lo", "_lon_hi", "_lat_lo", "_lat_hi")


@query
def cell_bounds(spark, sf):
    return features(spark, sf).filter(src.has_box()).withColumns(grid.cell_bounds()).select("id", *[F.col(c).alias(c[1:]) for c in CELLS])


@query
def span_clamp(spark, sf):
    return keys.celled(features(spark, sf)).select("id")


@query
def cell_extent(spark, sf):
    return keys.extents(keys.celled(features(spark, sf)))


@query
def fold_extents(spark, sf):
    c = keys.celled(features(spark, sf))
    per = c.groupBy("theme").agg(F.first("theme").alias("intermediate"), F.count(F.lit(1)).alias("rows"), F.min("_lon_lo").alias("lon_lo_min"), F.max("_lon_hi").alias("lon_hi_max"), F.min("_lat_lo").alias("lat_lo_min"), F.max("_lat_hi").alias("lat_hi_max"), F.sum(F.lit(10)).alias("bytes"))
    return manifests.fold_extents(per)


def coarse_counts(df):
    return df.groupBy("coarse_lon", "coarse_lat").agg(F.count(F.lit(1)).alias("n"))


@query
def coarse_explode(spark, sf):
    return coarse_counts(keys.coarse_cells(keys.celled(features(spark, sf))))


@query
def coarse_explode_region(spark, sf):
    return coarse_counts(keys.coarse_cells(keys.celled(features(spark, sf)), REGION))


@query
def coarse_explode_clipped(spark, sf):
    return coarse_counts(keys.coarse_cells(keys.celled(features(spark, sf)), REGION, clip=True))


@query
def fine_cells(spark, sf):
    return keys.fine_cells(keys.celled(features(spark, sf))).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))


@query
def region_fine_cells(spark, sf):
    rows = [(a, b) for lon in range(190, 195) for lat in range(143, 147) for a, b in grid.fine_cells(lon, lat, CITY)]
    return spark.createDataFrame(rows, "cell_lon int, cell_lat int")


def cell_tiles(spark, sf):
    """The quadtree with a third of what the fullest cell of a theme holds (3 at least) for a budget, so that it splits at every size of the tables."""
    fine = keys.fine_cells(keys.celled(features(spark, sf)))
    fullest = fine.groupBy("theme", "x", "y").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    return pyramid.quadtree(fine, max(3, fullest // 3))


@query
def quadtree(spark, sf):
    return cell_tiles(spark, sf).groupBy("z", "x", "y").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("themes"))


@query
def quadtree_plan(spark, sf):
    """A dry run: how many tiles each depth would get."""
    return cell_tiles(spark, sf).groupBy("z").agg(F.count(F.lit(1)).alias("tiles"), F.sum("n").alias("n"))


def status_table(spark, sf):
    s = F.when(F.col("mercator_y") % 5 == 0, "failed").when(F.col("mercator_y") % 5 == 1, "empty").when(F.col("mercator_y") % 5 == 2, "in_progress").otherwise("done")
    k = keys.centred(features(spark, sf)).groupBy("theme", "mercator_x", "mercator_y").agg(F.count(F.lit(1)).alias("n"))
    return k.select("theme", F.col("mercator_x").alias("x"), F.col("mercator_y").alias("y"), s.alias("status"), (F.col("n") * 1000).alias("size_bytes"), "n")


@query
def resume_todo(spark, sf):
    done = status_table(spark, sf).filter("theme = 'water'")
    every = spark.range(64).select(F.col("id").cast("int").alias("x")).crossJoin(spark.range(64).select(F.col("id").cast("int").alias("y")))
    on_disk = status_table(spark, sf).filter("theme = 'land' and x < 10").select("x", "y").distinct()
    return ledger.todo(every, done, "x", "y", on_disk=on_disk)


@query
def existing_buckets(spark, sf):
    want = spark.createDataFrame(m.buckets_of_range(*BAND), "x int, y int")
    return ledger.present(want, status_table(spark, sf).select("x", "y"), "x", "y")


@query
def bucket_sets(spark, sf):
    of = lambda t: status_table(spark, sf).filter(F.col("theme") == t).select("x", "y")
    water, land = of("water"), of("land")
    sets = {"union": water.union(land).distinct(), "intersect": water.intersect(land), "except": water.exceptAll(land)}
    out = [d.agg(F.lit(k).alias("set"), F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx")) for k, d in sets.items()]
    return out[0].union(out[1]).union(out[2])


@query
def bucket_counts(spark, sf):
    return status_table(spark, sf).agg(F.countDistinct("x", "y").alias("buckets"), F.sum("size_bytes").alias("bytes"))


@query
def status_rollup(spark, sf):
    return ledger.rollup(status_table(spark, sf)).select("theme", "n_done", "n_empty", "n_failed", "n_in_progress", "bytes", "visited", F.round("percent", 6).alias("percent"))


@query
def downloads(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    key = F.concat(F.lit("s3://data/part-"), F.col("o_orderkey").cast("string"), F.lit(".parquet"))
    listed = o.select(key.alias("file_key"), (F.col("o_orderkey") * 10).alias("size_bytes"))
    known = o.filter("o_orderkey % 3 <> 0").select(key.alias("file_key"), F.when(F.col("o_orderkey") % 3 == 1, "done").otherwise("failed").alias("status"))
    disk = o.filter("o_orderkey % 2 = 0").select(key.alias("file_key"), (F.col("o_orderkey") * 10 + F.when(F.col("o_orderkey") % 8 == 0, 1).otherwise(0)).alias("disk_bytes"))
    return ledger.downloads(listed, known, disk)


@query
def counts_match(spark, sf):
    live = status_table(spark, sf).filter("theme = 'water'").select("x", "y", "n")
    cached = status_table(spark, sf).filter("theme = 'water'").select("x", "y", F.when(F.col("x") % 4 == 0, "not-a-number").when(F.col("x") % 4 == 1, F.col("n").cast("string")).otherwise((F.col("n") + 1).cast("string")).alias("cached"))
    return ledger.counts_match(cached, live, "x", "y").select("x", "y", "complete")


@query
def upsert_tiles(spark, sf):
    t = status_table(spark, sf).filter("theme = 'water'").select("x", "y", "n")
    return ledger.upsert(t, t.filter("x % 2 = 0").withColumn("n", F.col("n") * 100), "x", "y")


@query
def sorted_manifest(spark, sf):
    t = base_tiles(spark, sf).withColumn("status", F.when(F.col("x") % 7 == 0, "failed").otherwise("done"))
    path = shared_dir(spark)
    manifests.write_json(t.select("z", "x", "y", "status", "feature_count", values.tile_key().alias("key"), values.flat_name().alias("name")), path)
    # rows are numbered as the one file holds them
    lines = spark.read.schema("z int, x int, y int, status string, feature_count long, key string, name string").json(path)
    return lines.select((F.monotonically_increasing_id() + 1).alias("place"), "z", "x", "y", "feature_count", "key", "name")


@query
def manifest_json(spark, sf):
    return manifests.as_json(base_tiles(spark, sf).select("z", "x", "y", F.col("weight").alias("size_bytes"), "feature_count"), "z", "x", "y", "size_bytes", "feature_count")


def index_tiles(spark, sf):
    t = tiles.manifest(tiles.in_leaves(features(spark, sf), m.Z_BUCKET), BUDGET).withColumnRenamed("weight", "size_bytes")
    return index.public(t, "2025-01-01T00:00:00Z")


@query
def index_refresh(spark, sf):
    old = index_tiles(spark, sf)
    new = old.filter("x = 33 or x = 32").withColumn("feature_count", F.col("feature_count") + 1).drop("vintage")
    return index.refresh(old, new, 18, VINTAGE).select("z", "x", "y", "feature_count", "vintage")


@query
def index_peels(spark, sf):
    _, p = index.empty_index(spark)
    return index.stamp(p, 18, VINTAGE)


@query
def index_remove_peel(spark, sf):
    return index.remove_peel(index_tiles(spark, sf), 18).select("z", "x", "y")


@query
def viewport(spark, sf):
    return index.viewport(index_tiles(spark, sf), -11.25, 30.0, 33.75, 60.0, 0, 6).select("z", "x", "y", "feature_count")


@query
def file_hash(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", values.short_digest(F.concat(F.lit("part-"), F.col("o_orderkey").cast("string"))).alias("digest"))


@query
def byte_names(spark, sf):
    n = F.pow(F.lit(10.0), F.col("o_orderkey") % 14) * (1 + F.col("o_orderkey") % 9)
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", n.alias("n"))
    return o.select("o_orderkey", values.format_bytes(F.col("n")).alias("size"), values.peel_name(F.col("o_orderkey") % 36).alias("peel"))


@query
def checked_names(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    tag = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 3 == 0, ".0").when(F.col("o_orderkey") % 3 == 1, "").otherwise(".x"))
    b = values.bucket_of_name(F.concat(F.lit("/a/z6_"), (F.col("o_orderkey") % 64).cast("string"), F.lit("_"), (F.col("o_custkey") % 64).cast("string"), F.lit(".parquet")))
    return o.select("o_orderkey", values.is_release(tag).alias("release"), b["x"].alias("x"), b["y"].alias("y"))


# ---- round trips over written files ----


@query
def partition_round_trip(spark, sf):
    """Buckets in key=value folders: written, listed, pruned and read back without the folders' keys."""
    path = shared_dir(spark)
    sinks.write_partitioned(keys.centred(features(spark, sf)), path, "mercator_x", "mercator_y", salt=4)
    back = src.read_features(spark, path, hive=True)
    one = back.filter("mercator_x = 34 and mercator_y = 20").count()
    return src.partition_keys(back, "mercator_x", "mercator_y").agg(F.count(F.lit(1)).alias("buckets"), F.lit(one).alias("rows_34_20"), F.lit("mercator_x" in src.read_features(spark, path).columns).alias("leaks"))


@query
def tile_round_trip(spark, sf):
    """Tiles of the merged pyramid's upper levels, each one file at its path, measured and read back."""
    rows = tiles.in_leaves(features(spark, sf), m.Z_BUCKET)
    final = pyramid.merge_up(materialize(tiles.manifest(rows, 400, z_of_extent=False)), 400)
    path = shared_dir(spark)
    sizes = sinks.write_tiles(pyramid.rekey(rows, final), path)
    files = src.list_files(spark, path).filter("path not like '%_stage%'")
    key = [F.regexp_extract("path", r"/(\d+)/(\d+)/(\d+)\.parquet$", i + 1).cast("int").alias(c) for i, c in enumerate("zxy")]
    return files.select(*key, F.col("size_bytes").alias("listed")).join(sizes, ["z", "x", "y"]).select("z", "x", "y", (F.col("listed") == F.col("size_bytes")).alias("same"))


@query
def manifest_round_trip(spark, sf):
    path = shared_dir(spark)
    manifests.write_json(base_tiles(spark, sf).select("z", "x", "y", "status", "feature_count", F.col("weight").alias("size_bytes")), path)
    return manifests.read_json(spark, path, manifests.TILE_LEDGER, lines=True).select("z", "x", "y", "status", "feature_count", "size_bytes")


@query
def sorted_files(spark, sf):
    path = shared_dir(spark)
    sinks.write_sorted(keys.celled(features(spark, sf)), path, "_lat_lo", "_lon_lo")
    back = spark.read.parquet(path).withColumns({"file": F.col("_metadata.file_path"), "at": F.col("_metadata.row_index"), "k": F.struct("_lat_lo", "_lon_lo")})
    before = F.lag("k").over(Window.partitionBy("file").orderBy("at"))
    files = back.withColumn("back", F.col("k") < before).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count_if("back").alias("back"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    # files hold ranges that don't overlap; there is a row for a file, so one window over them is small
    files = files.withColumn("apart", F.coalesce(F.col("lo") > F.lag("hi").over(Window.orderBy("lo")), F.lit(True)))
    return files.agg(F.sum("n").alias("n"), F.sum("back").alias("rows_out_of_order"), F.count_if(~F.col("apart")).alias("files_that_overlap"))


@query
def index_stream(spark, sf):
    """The index after a stream of peel manifests was taken in, batch by batch."""
    return peels.demo(spark, index_tiles(spark, sf).drop("vintage"))
