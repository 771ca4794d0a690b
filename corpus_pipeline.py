"""Training-corpus pipeline: every stage works on all that its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import langid, linededup, neardup, packing, qualitycrf
from millrace.llm.runtime import checkpoint_root, cut, remove, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose line-CRF score reaches the threshold."""
    return qualitycrf.keep_good(docs, qualitycrf.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a centroid of a known language."""
    return langid.keep_known(docs, langid.fit(table(spark, sf_dir, "documents")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs."""
    return linededup.remove_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return neardup.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("best_fit_packing", pack),
]

#: Trained classifiers can't be written as SQL; tests hold the pipeline against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again; a stage's table goes once the next one's is written, and the last one's input once that is cut."""
    docs, before = table(spark, sf_dir, "documents"), None
    root = f"{checkpoint_root(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        if before is not None:
            remove(spark, before)
        before = f"{root}/{name}"
    out = cut(STAGES[-1][1](spark, docs, sf_dir))  # where pieces go, without texts
    remove(spark, before)
    return out
