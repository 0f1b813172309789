"""Scalar functions, their columns, and hand-made cases at the edges."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessellar.functions import grid, values
from tessellar.functions import mercator as m
from tessellar.operators import index, keys, ledger, pyramid, tiles
from tessellar.sources import features as src
from tessellar.sources import manifests, sinks

POINTS = [(0, 0, 0), (0, 0, 14), (12.5683, 55.6761, 14), (12.5683, 55.6761, 6), (-122.4194, 37.7749, 14), (139.6917, 35.6895, 14), (-43.1729, -22.9068, 14), (174.7633, -36.8485, 14)]


@pytest.mark.parametrize("lng,lat,z", POINTS)
def test_a_point_lies_in_its_tile(lng, lat, z):
    w, s, e, n = m.tile_extent(z, *m.lng_lat_to_tile(lng, lat, z))
    assert w <= lng < e and s <= lat <= n


@given(st.floats(-180, 179.999), st.floats(-85, 85), st.integers(0, 16))
@settings(max_examples=200, deadline=None)
def test_any_point_lies_in_its_tile(lng, lat, z):
    w, s, e, n = m.tile_extent(z, *m.lng_lat_to_tile(lng, lat, z))
    assert w - 1e-9 <= lng <= e + 1e-9 and s - 1e-9 <= lat <= n + 1e-9


def test_poles_and_bad_arguments():
    assert m.lng_lat_to_tile(0, 89.5, 14)[1] == 0 and m.lng_lat_to_tile(0, -89.5, 14)[1] == 16383
    assert all(m.lng_lat_to_tile(x, y, 0) == (0, 0) for x, y in [(0, 0), (-180, 85), (179, -85), (10, 10), (-10, -10)])
    for bad in [(2, 4, 0), (2, 0, 4), (-1, 0, 0)]:
        with pytest.raises(ValueError):
            m.tile_extent(*bad)
    with pytest.raises(ValueError):
        m.lng_lat_to_tile(0, 0, -1)


@pytest.mark.parametrize("z", [0, 1, 2, 6, 10, 14, 15])
def test_extent_width(z):
    w, _, e, _ = m.tile_extent(z, 0, 0)
    assert math.isclose(e - w, 360 / 2**z)


def test_extents_meet():
    assert m.tile_extent(0, 0, 0) == pytest.approx((-180, -85.0511287798066, 180, 85.0511287798066))
    assert m.tile_extent(1, 0, 0)[2] == m.tile_extent(1, 1, 0)[0] == 0 and abs(m.tile_extent(1, 0, 0)[1]) < 1e-12


def test_bucket_ranges():
    ten = m.buckets_of_range(0, 10)
    assert len(ten) == 128 and {x for x, _ in ten} == {32, 33} and {y for _, y in ten} == set(range(64))
    assert len(m.buckets_of_range(-180, 180)) == 4096
    near = {y for _, y in m.buckets_of_range(0, 10, (-5, 5))}
    assert 32 in near and near <= set(range(28, 37))
    for bad in [((10, 0),), ((0, 10), (5, -5))]:
        with pytest.raises(ValueError):
            m.buckets_of_range(*bad[0], *bad[1:])


def test_peels_and_names():
    assert [m.peel_range(i) for i in (0, 18, 35)] == [(-180, -170), (0, 10), (170, 180)]
    assert list(m.peel_order()) == [*range(18, 36), *range(18)]
    assert m.tile_path(14, 8763, 5128) == "tiles/14/8763/5128.parquet" and grid.flat_name(10, 1023, 511) == "10_1023_511.parquet.gz"


def test_quadrants_and_children():
    b = grid.Box(0, 0, 1, 1)
    q = b.quadrants()
    assert sum(x.area for x in q) == b.area and all(x.width == 0.5 for x in q) and q[0] == grid.Box(0, 0, 0.5, 0.5)
    assert [grid.child_address(0, 3, 5, i) for i in range(4)] == [(1, 6, 10), (1, 7, 10), (1, 6, 11), (1, 7, 11)]
    assert len({grid.child_address(*grid.child_address(0, 3, 5, i), j) for i in range(4) for j in range(4)}) == 16
    assert grid.cell_address(1900, 1450)[:3] == (0, 1450, 1900)
    assert grid.depth_of(0.1) == 0 and grid.depth_of(0.001) == 7
    assert grid.cell_index(grid.Box(-180, -90, -179.9, -89.9)) == (0, 0)
    assert len(grid.fine_cells(10, 20)) == 100


def test_columns_equal_scalars(spark):
    rows = [(float(x), float(y)) for x in (-180, -12.3, 0, 77.7, 179.99) for y in (-89, -85, -1, 0, 45.5, 88)]
    df = spark.createDataFrame(rows, "lng double, lat double")
    for z in (0, 6, 14):
        got = df.select("lng", "lat", m.tile_x("lng", z).alias("x"), m.tile_y(m.clamp_lat("lat"), z).alias("y")).collect()
        assert all((r.x, r.y) == m.lng_lat_to_tile(r.lng, r.lat, z) for r in got)


def box(i, xmin, ymin, xmax, ymax, theme="water"):
    return (i, theme, tuple(map(float, (xmin, ymin, xmax, ymax))))


SCHEMA = "id long, theme string, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>"


def test_edges_of_tiles(spark):
    e = m.tile_extent(6, 33, 20)
    df = spark.createDataFrame([box(1, e[0], 55.0, e[0], 55.0), box(2, 179.5, 0, -179.5, 1), box(3, 6, 86, 7, 87), (4, "land", None), (5, "land", (None, None, None, None))], SCHEMA)
    got = {(r.id, r.mercator_x, r.mercator_y) for r in keys.centred(df).select("id", "mercator_x", "mercator_y").collect()}
    assert (5, 63, 63) in got and not any(i == 4 for i, _, _ in got)
    assert {r.id for r in tiles.in_leaves(df, 6).collect()} == set()  # a point on an edge, a wrapped box, beyond the limit
    assert keys.coarse_cells(keys.celled(df)).filter("id = 2").count() == 0


def test_nan_stops(spark):
    df = spark.createDataFrame([box(1, float("nan"), 0, 1, 1)], SCHEMA)
    with pytest.raises(Exception, match="NaN"):
        keys.centred(df).collect()


def test_seam_column_is_seen_by_both_peels(spark):
    df = spark.createDataFrame([box(1, 9.9, 50, 10.1, 50.1)], SCHEMA)
    assert {r.peel_idx for r in keys.in_peels(df).collect()} == {18, 19}


TILE = "z int, x int, y int, weight long, feature_count long, status string"


def test_merging(spark):
    kids = lambda x, y, w: [(6, 2 * x + i, 2 * y + j, w, w, "done") for i in (0, 1) for j in (0, 1)]
    rows = kids(0, 0, 5) + kids(1, 0, 6)[:3] + [(6, 3, 1, 0, 0, "empty")] + kids(2, 2, 6)
    out = {(r.z, r.x, r.y): r.weight for r in pyramid.merge_up(spark.createDataFrame(rows, TILE), 20).collect()}
    assert out[5, 0, 0] == 20 and (5, 1, 0) not in out and (5, 2, 2) not in out and sum(out.values()) == 20 + 18 + 24
    out = {(r.z, r.x, r.y) for r in pyramid.merge_up(spark.createDataFrame(rows, TILE), 20, count_empty=True).collect()}
    assert (5, 1, 0) in out
    assert pyramid.merge_up(spark.createDataFrame([], TILE), 20).count() == 0


def test_straddling_rows_count_for_each_child(spark):
    e = m.tile_extent(6, 33, 20)
    mid = (e[0] + e[2]) / 2
    df = spark.createDataFrame([box(1, mid - 0.1, 55.0, mid + 0.1, 55.1)], SCHEMA)
    rows = tiles.in_leaves(df, 6)
    assert rows.count() == 1
    split = pyramid.split_oversize(rows, tiles.manifest(rows, 0), 6)
    assert split.count() == 2 and {r.z for r in split.collect()} == {7}
    # one level only: a child over budget stays
    assert pyramid.split_oversize(split, tiles.manifest(split, 0), 6).count() == 2


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, ("x",))], "id long, names struct<a:string>")
    b = spark.createDataFrame([(2, ("y",), 3)], "id long, names struct<b:string>, n int")
    got = {r.id: r.asDict(True) for r in src.union_themes(a, b).collect()}
    assert got[1] == {"id": 1, "names": {"a": "x", "b": None}, "n": None} and got[2]["names"] == {"a": None, "b": "y"}
    with pytest.raises(ValueError):
        src.check_themes(["roads"])


def test_viewport_touching_edge(spark):
    t = spark.createDataFrame([(6, 32, 20, 1, 1, {}, [0.0, 50.0, 5.625, 52.0], "v")], index.TILES)
    assert index.viewport(t, 5.625, 50, 10, 52).count() == 0 and index.viewport(t, -180, -90, 180, 90).count() == 1
    assert index.viewport(t, 0, 50, 1, 51, z_min=7).count() == 0
    empty, peels = index.empty_index(spark)
    assert empty.count() == 0 and peels.count() == 36 and index.stamp(peels, 3, "v").filter("vintage = 'v'").count() == 1


def test_resume_matrix(spark):
    cached = spark.createDataFrame([(1, "42"), (2, "42"), (3, None), (4, "not-a-number")], "x int, cached string")
    live = spark.createDataFrame([(1, 42), (2, 99), (3, 42), (4, 42)], "x int, n long")
    assert {r.x: r.complete for r in ledger.counts_match(cached, live, "x").collect()} == {1: True, 2: False, 3: False, 4: False}


def test_manifests(spark, tmp_path):
    bad = tmp_path / "bad.json"
    bad.write_text("not json")
    assert manifests.read_json(spark, str(bad), manifests.TILE_LEDGER).count() == 0
    assert manifests.read_json(spark, str(tmp_path / "none.json"), manifests.TILE_LEDGER).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        manifests.read_json(spark, str(tmp_path / "none.json"), manifests.TILE_LEDGER, missing_ok=False)
    good = tmp_path / "good.json"
    good.write_text('[{"z":14,"x":1,"y":2,"status":"done","size_bytes":9},{"z":14,"x":1,"y":3,"status":"failed"}]')
    assert {(r.y, r.status) for r in manifests.read_json(spark, str(good), manifests.TILE_LEDGER).collect()} == {(2, "done"), (3, "failed")}
    none = manifests.fold_extents(spark.createDataFrame([("a", 0, 1, 2, 3, 4, 5)], manifests.FILE_EXTENT)).first()
    assert (none.files, none.lon_lo_min, none.lon_hi_max, none.lat_hi_max) == (0, 0, 3599, 1799)


def test_files(spark, tmp_path):
    df = spark.createDataFrame([box(i, i, 50, i + 0.5, 50.5) for i in range(5)], SCHEMA)
    sinks.write_single(df, str(tmp_path / "t"), "gzip")
    files = src.list_files(spark, str(tmp_path / "t")).collect()
    assert len(files) == 1 and files[0].size_bytes > 0 and src.list_files(spark, str(tmp_path / "none")).count() == 0
    assert len(src.file_hashes(spark, str(tmp_path / "t"), "*.parquet").first().sha256) == 64
    assert src.read_features(spark, str(tmp_path / "t"), "land", hive=False).select("theme").distinct().collect()[0].theme == "land"
    named = tmp_path / "z6_33_20.parquet"
    df.toArrow() and __import__("pyarrow.parquet").parquet.write_table(df.toArrow(), named)
    assert [tuple(r) for r in src.keys_in_names(spark.read.parquet(str(named))).collect()] == [(33, 20)]


def test_fetch(tmp_path):
    from tessellar.sources.fetch import fetch, fetch_all

    a = tmp_path / "a.bin"
    a.write_bytes(b"x" * 100)
    got = fetch(a.as_uri(), tmp_path / "out" / "a.bin", 100)
    assert got["status"] == "done" and len(got["sha256"]) == 64 and not list((tmp_path / "out").glob("*.part"))
    assert fetch(a.as_uri(), tmp_path / "out" / "b.bin", 99)["status"] == "failed"
    assert [r["status"] for r in fetch_all([((tmp_path / "none").as_uri(), str(tmp_path / "c"), 0)])] == ["failed"]


def test_arguments():
    assert values.check(values.RELEASE, "2026-04-15.0") == "2026-04-15.0"
    for p, bad in ((values.RELEASE, "2026-4-15"), (values.OBJECT_KEY, "s3://b/x;drop.parquet"), (values.MEMORY, "lots")):
        with pytest.raises(ValueError):
            values.check(p, bad)


def test_pushdown_and_plans(spark, tmp_path):
    """The scan takes the tests of the box over, and no range join becomes a nested loop."""
    df = spark.createDataFrame([box(i, i, 50, i + 0.5, 50.5) for i in range(5)], SCHEMA)
    sinks.write_table(df, str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scan = spark.read.parquet(str(tmp_path / "t")).filter(src.overlaps(0, 40, 2, 60)).select("id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(bbox.xmin,2.0)" in plan and "theme" not in plan
    plan = tiles.counts(tiles.in_leaves(df, 8))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("Exchange") <= 1


def test_command_line(spark, tmp_path, capsys):
    from tessellar import cli

    df = spark.createDataFrame([box(i, 12 + i / 100, 55, 12.01 + i / 100, 55.01) for i in range(20)], SCHEMA)
    sinks.write_table(df, str(tmp_path / "in"))
    cli.main(["tiles", "--input", str(tmp_path / "in"), "--theme", "water", "--output", str(tmp_path / "out"), "--z-max", "8", "--row-bytes", "1", "--budget", "100"], spark)
    got = manifests.read_json(spark, str(tmp_path / "out" / "manifest"), manifests.TILE_ENTRY, lines=True)
    assert got.agg(F.sum("feature_count")).first()[0] == 20 and list((tmp_path / "out" / "tiles").rglob("*.parquet"))
    cli.main(["cells", "--input", str(tmp_path / "in"), "--theme", "water", "--dry-run"], spark)
    assert "water" in capsys.readouterr().out


def test_quadtree_equals_plain_splitting(spark):
    """Counts inherited by covered tiles against splitting every row, down to the smallest tiles; rows without a theme too."""
    import random

    from tessellar.operators import keys, pyramid

    rnd = random.Random(5)
    rows = []
    for i in range(60):
        w, s = 10 + rnd.random() * 0.05, 50 + rnd.random() * 0.05
        rows.append((i, rnd.choice(["water", None]), (w, s, w + rnd.choice([0.0, 0.003, 0.15]), s + rnd.choice([0.0, 0.01, 0.15]))))
    df = spark.createDataFrame(rows, "id long, theme string, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    fine = keys.fine_cells(keys.celled(df))
    got = {(r.theme, r.z, r.x, r.y): r.n for r in pyramid.quadtree(fine, 3).collect()}
    want = {}

    def split(theme, address, box, inside):
        if len(inside) <= 3 or box.width <= 0.001 + 1e-9:
            if inside:
                want[(theme, *address)] = len(inside)
            return
        for q, part in enumerate(box.quadrants()):
            over = [b for b in inside if b[0] < part.east and b[2] > part.west and b[1] < part.north and b[3] > part.south]
            split(theme, grid.child_address(*address, q), part, over)

    cells = {}
    for r in fine.collect():
        cells.setdefault((r.theme, r.y, r.x), []).append(tuple(r.bbox))
    for (theme, lon, lat), inside in cells.items():
        z, x, y, box = grid.cell_address(lon, lat)
        split(theme, (z, x, y), box, inside)
    assert max(z for _, z, _, _ in want) == 7
    assert got == want


def test_merge_at_the_floor(spark):
    from tessellar.operators import pyramid

    tiles = spark.createDataFrame([(6, 1, 1, 5, 2)], "z int, x int, y int, weight long, feature_count long")
    assert [tuple(r) for r in pyramid.merge_up(tiles, 10, floor_z=6).collect()] == [(6, 1, 1, 5, 2)]
