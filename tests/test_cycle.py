"""A run over peels that stops and goes on, its files, its index and its document."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessellar.functions import mercator as m
from tessellar.operators import cycle, index, pyramid
from tessellar.plans.view import features
from tests.oracle import DATA


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    rows = features(spark, str(DATA / "sf0.001")).filter(F.col("bbox.xmin").between(0.5, 19)).cache()
    first = cycle.run(spark, rows, root, budget=20_000, z_max=7, row_bytes=400, limit=1, release="2026-01-01.0")
    return root, rows, first, cycle.run(spark, rows, root, budget=20_000, z_max=7, row_bytes=400, limit=1)


def test_a_run_goes_on(spark, done):
    root, rows, first, second = done
    order = list(m.peel_order())
    assert first["completed_peels_in_cycle"] == order[:1] and second["completed_peels_in_cycle"] == sorted(order[:2])
    assert cycle.load_state(spark, root) == second and second["release"] == "2026-01-01.0" and second["cycle"] == 1
    last = cycle.save_state(spark, root, {**second, "completed_peels_in_cycle": [i for i in range(36) if i != 5]})
    assert [r["peel_idx"] for r in cycle.ledger.peels_left(spark, last["completed_peels_in_cycle"]).collect()] == [5]
    assert cycle.run(spark, rows.limit(0), root, z_max=7)["cycle"] == 2
    assert cycle.load_state(spark, root)["completed_peels_in_cycle"] == []


def test_files_are_those_of_the_index(spark, done):
    root, rows, _, state = done
    t, peels = cycle.read_index(spark, state["index"])
    entries = {(r.z, r.x, r.y): r for r in t.collect()}
    files = {tuple(int(v.removesuffix(".parquet")) for v in p.parts[-3:]): p for p in Path(root, "tiles").rglob("*.parquet")}
    assert entries and entries.keys() == files.keys()
    for k, p in files.items():
        assert entries[k].size_bytes == p.stat().st_size
        assert spark.read.parquet(str(p)).count() == entries[k].feature_count == sum(entries[k].theme_counts.values())
    assert sum(r.vintage is not None for r in peels.collect()) == 2


def test_document(spark, done, tmp_path):
    root, _, _, state = done
    t, peels = cycle.read_index(spark, state["index"])
    index.write_document(t, peels, str(tmp_path / "doc"), 1, "2026-01-02T00:00:00Z")
    (part,) = (tmp_path / "doc").glob("part-*")
    doc = json.loads(part.read_text())
    assert list(doc) == ["schema_version", "generated_at", "cycle", "tile_count", "peels", "tiles"]
    assert doc["tile_count"] == len(doc["tiles"]) == t.count() and len(doc["peels"]) == 36 and doc["peels"][3]["vintage"] is None
    assert [(x["z"], x["x"], x["y"]) for x in doc["tiles"]] == sorted((x["z"], x["x"], x["y"]) for x in doc["tiles"])
    empty = index.document(*index.empty_index(spark), 0, "t").collect()
    assert json.loads("".join(r.line for r in empty))["tiles"] == []


def test_measured_sizes_split_merged_tiles(spark):
    final = spark.createDataFrame([(1, 0, 0), (2, 2, 2)], "z int, x int, y int")
    base = spark.createDataFrame([(2, 0, 0), (2, 1, 0), (2, 0, 1), (2, 1, 1), (2, 2, 2)], "z int, x int, y int")
    sizes = spark.createDataFrame([(1, 0, 0, 11), (2, 2, 2, 99)], "z int, x int, y int, size_bytes long")
    over, kids = pyramid.split_measured(final, base, sizes, 10)
    assert [tuple(r) for r in over.collect()] == [(1, 0, 0)] and {tuple(r) for r in kids.collect()} == {tuple(r) for r in base.collect()} - {(2, 2, 2)}


def test_sweep_and_ladder(spark, tmp_path):
    from tessellar import tables
    from tessellar.plans.ladder import ladder

    took = ladder(features(spark, str(DATA / "sf0.001")))
    assert list(took) == ["a_count", "b_read", "c_cells", "d_explode", "e_partition"] and all(v > 0 for v in took.values())
    path = tables.shared_dir(spark)
    spark.range(10).write.parquet(path)
    kept = dict(tables._made)
    tables._made.clear()
    tables._made[spark.sparkContext.applicationId] = [path, path + "-never-written"]
    assert tables.sweep(spark) > 0 and not Path(path).exists() and tables.sweep(spark) == 0
    tables._made.update(kept)
