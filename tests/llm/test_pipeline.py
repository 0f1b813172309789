"""The pipeline's stages, each on what the one before kept."""

from __future__ import annotations

import corpus_pipeline
from tessellar.llm import toxicity
from tests.llm.test_text_ops import linked, later_lines, tokens
from tests.oracle import DATA

SF = str(DATA / "sf0.001")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, SF).cache()
        if name != "mixing":
            assert out.columns == columns
            after = {r.doc_id: r.text for r in out.collect()}
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            score = {r.doc_id: r.tox_score for r in toxicity.scan(docs, model, ["doc_id"]).collect()}
            assert after == {d: t for d, t in before if score[d] < 0.5} and len(after) > 0.8 * len(before)
        elif name == "line_dedup":
            gone = later_lines(before)
            assert after == {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in before}
        elif name == "near_dedup":
            assert after.keys() == {d for d, (_, c) in linked(before, 5).items() if c == d}
        elif name == "decontamination":
            grams = [set(tokens(x, 5)) for x in items]
            for d, t in before:
                own = set(tokens(t, 5))
                full = any(g <= own for g in grams)
                assert not (full and d in after) and (d in after or any(len(g & own) >= 0.6 * len(g) for g in grams))
        else:
            assert {r.doc_id for r in out.collect()} == {d for d, _ in before} and {"doc_id", "size", "source_size", "target", "taken"} <= set(out.columns)
        docs = out


def test_odd_rows_go_through(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "some words that are fine here", None, None, 1), (3, "some words that are fine here", None, None, 1), (None, "no id", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == (5 if name in ("toxicity", "line_dedup") else 4)
