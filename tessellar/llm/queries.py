"""The queries of the operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tessellar.llm import chat, common, decontam, linededup, lm, mixing, neardup, oracles, quality, runindex, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("line_removed").cast("long").alias("n_removed"), F.array_join("line_removed", ",").alias("line_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", lm.chunk_of(F.col("_metadata.file_path"), F.col("_metadata.row_index"), F.octet_length("text")).alias("chunk"))
    return lm.score(docs, F.col("chunk"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4's cutoffs under a risk that also few labels can bound."""
    return quality.cutoffs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), risk=0.3, delta=0.2).drop("p_value")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runindex.dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], rows.schema)
    return chat.read_back(chat.format_chat(rows.unionByName(more)))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), spans=False)
    return out.select("doc_id", "held_out", "score", "predicted", "n_words", "best")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(table(spark, sf_dir, "documents"), words=4)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.shared_dir(spark)
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    # either kind by a filter that the source takes; a revisit has no payload, so those of the others are stepped over for it
    whole = warc.read_warc(spark, path).filter("record_type = 'response'")
    revisit = warc.read_warc(spark, path, payload=False).filter("record_type = 'revisit'")
    own = [F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")]
    return whole.select("page_id", *own, "record_type", "refers_to").unionByName(revisit.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_mixing, op2_line_dedup, op3_lm_scoring, op4_quality_rules, quality_cutoffs, op5_suffix_dedup, op6_chat_formatting, op7_decontamination, op8_toxicity, op9_minhash, op10_warc, pipeline)}

ORACLES: dict[str, str] = {**oracles.ORACLES}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
