"""From raw documents to a training mix, in stages that each work on what the one before kept.

toxicity: documents that the segment search predicts to be toxic go.
line_dedup: lines with a word that an earlier line resembles go; a document whose lines all go stays, empty.
near_dedup: of documents linked by word-shingle similarity, the one with the smallest id stays.
decontamination: documents that hold a benchmark item go.
mixing: tells how many words of each document the mix takes.

All but the last return the columns of ``documents``; ``n_chars``, where it is among them, follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.llm import decontam, linededup, mixing, neardup, toxicity
from tessellar.llm.common import materialize


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.dedup(docs)
    # by position: the input may have a column of the added one's name
    names = [f"_kept{i}" for i in range(len(out.columns))]
    out = out.toDF(*names).select(*names[:-1]).toDF(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_first(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [("toxicity", _toxicity), ("line_dedup", _line_dedup), ("near_dedup", _near_dedup), ("decontamination", _decontamination), ("mixing", _mixing)]

#: The toxicity model and the fingerprints have no form in SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
