"""What the operators share: table access, lineage cuts and the Arrow driving loop."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import ship_package

#: Bytes and number of texts handed to a numpy kernel at once. A single longer text is a block of its own.
BLOCK_BYTES, BLOCK_ROWS = 1 << 20, 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that all executors share: the cluster's spark.checkpoint.dir; one of our own only where that is unset, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="millrace-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and cut lineage. The files go with the table's last use in sessions that set
    spark.cleaner.referenceTracking.cleanCheckpoints, as millrace.session does."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table lacks, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that we wrote, through Spark's own file systems."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal an aggregate's rows out by other columns than its keys. A join on the keys then shuffles both sides for itself, which is
    what lets AQE split the other side's hot keys; the aggregate's own partitioning would forbid it."""
    return df.repartition(*by)


def in_bucket(doc_id: str = "doc_id", of: int = 4) -> F.Column:
    """crc32 of the id's decimal text modulo ``of``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of


def held_out(doc_id: str = "doc_id") -> F.Column:
    return in_bucket(doc_id) == 2


def text_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The last column of that name as large_string; any other type is cast, so a void column reads as nulls."""
    column = batch.column(batch.schema.names.index(name))
    return column if pa.types.is_large_string(column.type) else column.cast(pa.large_string())


def ranges(text: pa.Array, limit: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``rows`` texts and about ``limit`` bytes."""
    import numpy as np

    off = offsets(text)
    lo, n = 0, len(text)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + rows)
        yield lo, hi
        lo = hi


def blocks(batch: pa.RecordBatch, name: str = "text", limit: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[tuple[int, int]]:
    return ranges(text_of(batch, name), limit, rows)


def offsets(text: pa.Array):
    import numpy as np

    if not len(text):
        return np.zeros(1, np.int64)
    return np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]


def map_blocks(df: DataFrame, fn: Callable, keep: list[str], out: list[T.StructField], text: str = "text", limit: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> DataFrame:
    """Run ``fn(text array) -> list of columns`` over blocks of whole texts; ``keep`` columns pass through unchanged."""
    ship_package(df.sparkSession)
    source = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep] + out)
    names = [f.name for f in schema.fields]
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in blocks(batch, limit=limit, rows=rows):
                part = batch.slice(lo, hi - lo)
                made = fn(text_of(part))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(n_keep)] + [pa.array(x) if not isinstance(x, pa.Array) else x for x in made], names)

    return source.mapInArrow(run, schema)


def filter_rows(df: DataFrame, keep_mask: Callable, text: str = "text", rows: int = BLOCK_ROWS) -> DataFrame:
    """Keep whole rows, every column untouched, for which ``keep_mask(text array)`` is true."""
    ship_package(df.sparkSession)
    at = df.columns.index(text)
    names = [f"c{i}" for i in range(len(df.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in blocks(batch, names[at], rows=rows):
                part = batch.slice(lo, hi - lo)
                yield part.filter(pa.array(keep_mask(text_of(part, names[at]))))

    inner = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, df.schema.fields)])
    return df.toDF(*names).mapInArrow(run, inner).toDF(*df.columns)
