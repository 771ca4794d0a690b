"""Bounded training samples, and models fitted on an executor: the driver gets the finished model and never a text."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import held_out, text_of
from millrace.session import ship_package


def one_text_an_id(rows: DataFrame, *by: str) -> DataFrame:
    """One row for each value of ``by``, with the text of least hash: rows that repeat an id don't widen a sample. Combined map-side."""
    return rows.groupBy(*by).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> DataFrame:
    """doc_id, y, text: at most ``per_class`` texts of each label, of at most ``max_chars`` characters, outside the held-out fourth.

    The least hashes of doc_id are taken, so that the sample doesn't depend on the order of rows. Only ids are ranked; texts
    are fetched for the chosen ones, of which there are 2 * per_class at most."""
    marked = labels.where(~held_out()).where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    least = lambda y: marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    fit = docs.where(F.length("text").between(1, max_chars)).select("doc_id", F.col("text").cast("string").alias("text"))
    return one_text_an_id(fit.join(F.broadcast(least(0).union(least(1))), "doc_id"), "doc_id", "y")


def train(sample: DataFrame, order: list, key: str, fit: Callable[[pa.Array, list], object]):
    """fit(texts, keys) over a bounded sample in one executor task; a lost executor's task is run again on another. None for an empty sample."""
    ship_package(sample.sparkSession)
    rows = sample.withColumnRenamed(key, "key").repartition(1).sortWithinPartitions(*order).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts = [], []
        for batch in batches:
            keys += batch.column(0).to_pylist()
            texts.append(text_of(batch))
        if keys:
            model = fit(pa.concat_arrays(texts), keys)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = rows.mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else None


def train_labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int, fit: Callable[[pa.Array, list], object]):
    return train(labelled_sample(docs, labels, label, per_class, max_chars), [F.xxhash64("doc_id"), "doc_id"], "y", fit)
