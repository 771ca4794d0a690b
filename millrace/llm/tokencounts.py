"""Token counts: the exact histogram of encoded lengths, with suffix sums that answer any context limit.

Documents are encoded whole with a byte-level BPE and counted by length where they are read; only (length, count) pairs are
shuffled. Over the distinct lengths, suffix sums in two levels (inside ranges of lengths, and over the ranges) give for every
length L how many documents are at least as long, their tokens, and what all documents hold if cut at L. A limit between two
lengths takes the next greater length's suffix; ``at_limit`` does so.

Cases: null and empty texts have length 0; repeated rows count each; an empty table gives an empty histogram; strings of
special tokens in a text are ordinary text; bytes that aren't UTF-8 read as U+FFFD; extra columns pass by."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.runtime import blocks, cut, map_blocks, text_of
from millrace.session import ship_package

#: Lengths that share a range of the two-level suffix sums.
RANGE = 1024
_encoders: dict[int, object] = {}


def default_vocabulary() -> tuple[str, str]:
    """(path of the rank file, split pattern) of the public 50k byte-level BPE."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encoder(ranks: bytes, pattern: str):
    """A tiktoken encoding, made once in each worker."""
    import tiktoken

    key = hash((ranks, pattern))
    if key not in _encoders:
        pairs = (line.split() for line in ranks.splitlines() if line)
        _encoders[key] = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
    return _encoders[key]


def strings(text: pa.Array) -> list[str | None]:
    """Texts as Python strings; bytes that aren't UTF-8, which Spark's strings may hold, read as U+FFFD."""
    try:
        return text.to_pylist()
    except UnicodeDecodeError:
        return [None if t is None else t.decode("utf-8", "replace") for t in text.cast(pa.large_binary()).to_pylist()]


def length(enc, text: str) -> int:
    """Tokens of a whole text."""
    return len(enc.encode_ordinary(text)) if text else 0


def _shared(spark: SparkSession, path: str | None, pattern: str | None):
    """The vocabulary, of fixed size, as a broadcast, and the split pattern."""
    if path is None or pattern is None:
        path, pattern = default_vocabulary()
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read()), pattern


def lengths(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, length: the number of tokens of every whole text."""
    shared, pattern = _shared(docs.sparkSession, path, pattern)

    def count(text: pa.Array) -> list:
        enc = encoder(shared.value, pattern)
        return [pa.array([length(enc, t) for t in strings(text)], pa.int64())]

    return map_blocks(docs, count, ["doc_id"], [T.StructField("length", T.LongType())])


def histogram(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """length, n_docs: how many documents have each encoded length."""
    ship_package(docs.sparkSession)
    shared, pattern = _shared(docs.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        enc = encoder(shared.value, pattern)
        for batch in batches:
            sizes = []
            for lo, hi in blocks(batch):
                sizes += [length(enc, t) for t in strings(text_of(batch.slice(lo, hi - lo)))]
            value, n = np.unique(np.array(sizes, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n.astype(np.int64))], ["length", "n"])

    made = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "length long, n long")
    return made.groupBy("length").agg(F.sum("n").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For every length L: n_docs, docs_at_least, tokens_at_least, docs_below, tokens_below and truncated_total, the tokens of all
    documents cut at L. No window holds more than RANGE lengths, or the ranges, of which there are at most the longest text's tokens / RANGE."""
    rows = hist.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("tokens"), F.floor(F.col("length") / RANGE).cast("long").alias("part"))
    sums = rows.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    sums = sums.select("part", *[F.coalesce(F.sum(c).over(w), zero).alias(n) for c, w, n in (("d", after, "da"), ("t", after, "ta"), ("d", before, "db"), ("t", before, "tb"))])
    inner = Window.partitionBy("part").orderBy("length")
    below, least = inner.rowsBetween(Window.unboundedPreceding, -1), inner.rowsBetween(0, Window.unboundedFollowing)
    out = rows.join(sums, "part").select(
        "length",
        "n_docs",
        (F.sum("n_docs").over(least) + F.col("da")).alias("docs_at_least"),
        (F.sum("tokens").over(least) + F.col("ta")).alias("tokens_at_least"),
        (F.coalesce(F.sum("n_docs").over(below), zero) + F.col("db")).alias("docs_below"),
        (F.coalesce(F.sum("tokens").over(below), zero) + F.col("tb")).alias("tokens_below"),
    )
    return out.withColumn("truncated_total", F.col("tokens_below") + F.col("docs_at_least") * F.col("length"))


def at_limit(sums: DataFrame, limit: int) -> DataFrame:
    """One row: documents and tokens in all, documents longer than the limit, tokens if all are cut at the limit."""
    long = F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("n_docs"))), F.lit(0))
    kept = F.coalesce(F.sum(F.when(F.col("length") <= limit, F.col("n_docs") * F.col("length"))), F.lit(0))
    return sums.agg(F.sum("n_docs").alias("n_docs"), F.sum(F.col("n_docs") * F.col("length")).alias("n_tokens"), long.alias("docs_over"), (kept + long * limit).alias("truncated_total"))


def quantile(sums: DataFrame, q: float) -> int | None:
    """The least length that at least a share q of the documents doesn't exceed."""
    total = sums.agg(F.sum("n_docs")).first()[0]
    if not total:
        return None
    return sums.where((F.col("docs_below") + F.col("n_docs")) >= q * total).agg(F.min("length")).first()[0]


def counted(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    return suffix_sums(cut(histogram(docs, path, pattern)))  # both levels of sums read the histogram, and encoding costs most
