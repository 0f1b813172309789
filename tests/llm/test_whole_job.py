"""Cases in which an operator would do less than the whole job."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tessellar.functions import mercator
from tessellar.llm import common, decontam, lm, neardup, quality, runindex
from tessellar.operators import pyramid, tiles
from tessellar.plans import queries as plans
from tests.llm.test_text_ops import removed, tokens, weighted
from tests.oracle import DATA


def low_gram(rng):
    """A gram whose hash is so small that it is the anchor of nearly every string that holds it."""
    data = rng.integers(97, 123, 200_000).astype(np.uint8)
    at = np.arange(len(data) - runindex.GRAM + 1)
    i = int(np.argmin(common.span_hash(common.prefix(data), at, at + runindex.GRAM)))
    return data[i : i + runindex.GRAM].tobytes().decode()


def test_split_anchors_see_matches_of_other_parts(spark):
    """op5: strings of a hot anchor that match within one part and stand alone in another."""
    rng = np.random.default_rng(12)
    text = lambda n: "".join(chr(x) for x in rng.integers(97, 123, n))
    hot, rows = low_gram(rng), []
    for _ in range(40):
        shared = text(80) + hot + text(100)
        rows += [(len(rows) + i, text(120) + shared + text(120)) for i in range(3)]
    out = runindex.dedup(spark.createDataFrame(rows, "doc_id long, text string"), limit=64, per_shard=16).collect()
    assert sorted((r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.removed), hashlib.sha256(r.kept).hexdigest()) for r in out) == removed(rows)


def test_thresholds_count_all_labelled_rows(spark):
    """op4: a language of few rows among more labels than the calibration once sampled."""
    few, n = 5000, 600_000
    lang = F.when(F.col("id") < few, "xx").otherwise("en").alias("lang")
    zero = [F.lit(0).cast("long").alias(c) for c in ("n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclaims")]
    stats = spark.range(n).select(F.col("id").alias("doc_id"), lang, *zero, *[F.lit(100).cast("long").alias(c) for c in ("n_words", "word_chars", "n_lines")], F.lit(False).alias("base_failed"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    out = {(r.lang, r.rule): r.n_good for r in quality.thresholds(stats, labels).collect()}
    assert {out["xx", "symbols"], out["xx", "repeats"]} == {few} and out["en", "symbols"] == n - few


def test_texts_shorter_than_an_item_are_compared(spark):
    """op7: an item less a few of its words, with no other word around it."""
    items = [(i, " ".join(f"i{i}w{j}" for j in range(n))) for i, n in enumerate([100, 40, 12, 5, 3])]
    docs = [(100 * i + less, " ".join(x.split()[less // 2 : len(x.split()) - (less + 1) // 2])) for i, x in items for less in range(25)]
    out = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = {}
    for (d, t) in docs:
        for i, x in items:
            k = min(5, len(tokens(x)))
            a, b = tokens(x, k), tokens(t, k)
            s = max((weighted(a, b[j : j + len(a)]) for j in range(max(1, len(b) - len(a) + 1))), default=0)
            if s >= 0.8:
                want[d, i] = (s, len(tokens(t)))
    got = {(r.doc_id, r.item_id): (r.similarity, r.n_words) for r in out.collect()}
    assert len(want) > 25 and got == want


def test_tile_round_trip_writes_all_features(spark):
    """tile_round_trip: the tiles of the pyramid over all features, each written and found again."""
    sf = str(DATA / "sf0.001")
    rows = tiles.in_leaves(plans.features(spark, sf), mercator.Z_BUCKET)
    final = pyramid.merge_up(common.materialize(tiles.manifest(rows, 400, z_of_extent=False)), 400)
    want = {tuple(r) for r in pyramid.rekey(rows, final).select("z", "x", "y").distinct().collect()}
    out = plans.tile_round_trip(spark, sf).collect()
    assert {(r.z, r.x, r.y) for r in out} == want and len(out) == len(want) and all(r.same for r in out)


def test_items_without_an_id_are_reported(spark):
    """op7: documents that hold benchmark items whose id is null."""
    items = [(None, "one two three four five six seven"), (None, "red green blue black white grey"), (4, "red green blue black white grey")]
    docs = [(1, "so " + items[0][1] + " it goes " + items[1][1]), (2, "nothing of that kind is in here")]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    out = decontam.contaminated(docs, items, block_bytes=40).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in out) == [(1, 0), (1, 0), (1, 4)]
    assert [r.doc_id for r in decontam.keep_clean(docs, items).collect()] == [2]


def test_rows_without_an_id_are_told_apart_by_text(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (None, text), (None, "quite another text of seven words"), (9, text + " more"), (None, text + " and more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {(r.doc_id, r.text) for r in neardup.keep_first(docs).collect()}
    assert kept == {rows[0], rows[2]}


def test_pipeline_lines_with_a_clashing_column(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a line\nb", 7), (2, "A line\nc", 8)], "doc_id long, text string, line_removed long")
    out = corpus_pipeline.STAGES[1][1](spark, docs, str(DATA / "sf0.001"))
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == [(1, "a line\nb", 7), (2, "c", 8)]


def test_chunks_are_bounded_by_bytes(spark):
    rows = spark.range(20_000).select(F.lit("f").alias("file"), "id", F.when(F.col("id") % 100 == 0, F.col("id") * 4000).when(F.col("id") % 7 == 0, 100_000).otherwise(F.col("id") % 16_384).alias("size"))
    chunks = rows.groupBy(lm.chunk_of(F.col("file"), F.col("id"), F.col("size")).alias("c")).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert all(c.s <= 1 << 26 or c.n == 1 for c in chunks) and len(chunks) < 300
    assert spark.range(1).select(lm.chunk_of(F.lit("f"), F.lit(1), F.lit(None).cast("int")).alias("c")).first().c is not None
