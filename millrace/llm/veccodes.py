"""Vector code compression: vectors of integers are cut into parts, and each part is replaced by the number of its codebook's nearest entry.

Nearest entries are screened by one float32 matrix product for a block of rows. Rounding can move a product of n terms by no more than gamma times the
two lengths, in whatever order it is summed, so every entry's distance lies in a known interval; entries whose interval overlaps that of the
best are evaluated again in int64, and ties go to the lower index. Values too large for int64 squares are screened in float64 and evaluated in
Python's integers. Codebooks are of fixed size (parts * entries vectors), start as the vectors of the least ids and are moved by rounds of
assignment and componentwise floor(sum / count); each task sums its own rows, Spark adds the tasks' sums.

Cases: rows whose vector is null, empty, or holds null or non-finite components, or components of 2^43 and more, whose integers and sums can't be kept
exact here, take no part; nor do vectors of another dimension than most. Null ids are coded, but seed no codebook; of rows that repeat an id the least
vector seeds. A dimension that the parts don't divide gives the first parts one component more. Fewer rows than entries give
smaller codebooks. An error beyond 64 bits is null. Equal rows are coded each; an empty table gives an empty table; extra columns pass by."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.runtime import cut
from millrace.session import ship_package

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows screened at once; distinct labels whose sums are broadcast back to the rows.
BLOCK_ROWS, BROADCAST_LABELS = 2048, 100_000
LARGEST = 2.0**43


def edges(dims: int, parts: int) -> list[int]:
    """Where the parts of a vector begin, and the end of the last."""
    return [0, *np.cumsum([dims // parts + (k < dims % parts) for k in range(parts)]).tolist()]


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each row's nearest entry, exact, ties to the lower index. x and book: int64. Distances are Python integers where 64 bits don't do."""
    n, d = x.shape
    largest = int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    wide = d * (2 * largest) ** 2 >= 1 << 62
    kind, unit = (np.float64, 2.0**-53) if wide else (np.float32, 2.0**-24)
    xf, bf = x.astype(np.float64), book.astype(np.float64)
    square = (bf * bf).sum(1)
    # d products and sums, and the rounding of either factor to the narrower type
    gamma = (d + 4) * unit * 1.01
    near = gamma * np.sqrt((xf * xf).sum(1))[:, None] * np.sqrt(square)[None, :]
    product = (x.astype(kind) @ book.astype(kind).T).astype(np.float64)
    score = square[None, :] - 2.0 * product
    # what float64 itself may be off by in the sums above
    slack = 2.0 * near + (d + 8) * 2.0**-52 * (square[None, :] + 2.0 * np.abs(product)) + 1e-9
    best = (score + slack).min(1)
    row, col = np.nonzero(score - slack <= best[:, None])
    if wide:
        gap = x[row].astype(object) - book[col].astype(object)
    else:
        gap = x[row] - book[col]
    dist = (gap * gap).sum(1)
    by = np.lexsort((col, dist, row)) if not wide else np.array(sorted(range(len(row)), key=lambda i: (row[i], dist[i], col[i])), np.int64)
    head = by[np.searchsorted(row[by], np.arange(n))]
    return col[head], dist[head]


def integers(batch: pa.RecordBatch, column: int = 0) -> np.ndarray:
    """Rows of a list column of doubles as floor(SCALE * x)."""
    array = batch.column(column)
    flat = np.asarray(array.flatten(), np.float64)
    return np.floor(flat.reshape(len(array), -1) * SCALE).astype(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x (doubles) of the rows that take part; the dimension is the commonest."""
    e = F.col("embedding")
    fit = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.when(e.isNotNull() & (F.size(e) > 0) & fit, e.cast("array<double>")).alias("x")).where("x is not null")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(lo, BLOCK_ROWS)


def seeds(x: DataFrame, entries: int) -> np.ndarray:
    """Integer vectors of the least ids, one an id."""
    least = x.where("vec_id is not null").groupBy("vec_id").agg(F.min("x").alias("x")).orderBy("vec_id").limit(entries).collect()
    return np.floor(np.array([r["x"] for r in least], np.float64) * SCALE).astype(np.int64)


def _moved(x: DataFrame, books: list[np.ndarray], at: list[int]) -> list[np.ndarray]:
    """The codebooks after one round: floor(sum / count) of each entry's parts; unused entries stay."""
    shared = x.sparkSession.sparkContext.broadcast(books)  # parts * entries vectors, whatever the input
    parts, width = len(books), max(b - a for a, b in zip(at, at[1:]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        count = [np.zeros(len(b), np.int64) for b in own]
        total = [np.zeros((len(b), width), np.int64) for b in own]
        used = 0

        def flush():
            for p in range(parts):
                some = np.flatnonzero(count[p])
                if len(some):
                    sums = pa.FixedSizeListArray.from_arrays(pa.array(total[p][some].ravel()), width).cast(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), p, np.int32)), pa.array(some.astype(np.int32)), pa.array(count[p][some]), sums], ["part", "entry", "n", "sums"])
                count[p][:], total[p][:] = 0, 0

        for block in _blocks(batches):
            v = integers(block)
            reach = int(np.abs(v).max(initial=0)) * len(v)
            if used + reach >= 1 << 62:
                yield from flush()
                used = 0
            used += reach
            for p in range(parts):
                piece = v[:, at[p] : at[p + 1]]
                entry, _ = nearest_entries(piece, own[p])
                count[p] += np.bincount(entry, minlength=len(own[p]))
                np.add.at(total[p][:, : piece.shape[1]], entry, piece)
        yield from flush()

    made = x.select("x").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    sums = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    rows = made.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect()  # one a codebook entry at most
    out = [b.copy() for b in books]
    for r in rows:
        for k in range(at[r["part"] + 1] - at[r["part"]]):
            out[r["part"]][r["entry"], k] = int(r[f"s{k}"]) // r["n"]
    return out


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """One codebook (entries, components) for each part, of integers; none for a table without usable rows that have ids."""
    ship_package(vectors.sparkSession)
    x = _same_dims(usable(vectors))
    first = seeds(x, entries) if x is not None else []
    if not len(first):
        return []
    at = edges(first.shape[1], parts)
    books = [first[:, a:b].copy() for a, b in zip(at, at[1:])]
    for _ in range(rounds):
        books = _moved(x, books, at)
    return books


def _same_dims(x: DataFrame) -> DataFrame | None:
    dims = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return None if dims is None else x.where(F.size("x") == dims["d"])


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, codes (an index for each part) and error (squared distance to the entries; null beyond 64 bits) of every usable row."""
    ship_package(vectors.sparkSession)
    kind = vectors.schema["label"].dataType if "label" in vectors.columns else T.IntegerType()
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", kind), T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    if not books:
        return vectors.sparkSession.createDataFrame([], schema)
    at = [0, *np.cumsum([b.shape[1] for b in books]).tolist()]
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            v = integers(block, 2)
            found = [nearest_entries(v[:, at[p] : at[p + 1]], b) for p, b in enumerate(shared.value)]
            codes = np.stack([c for c, _ in found], 1).astype(np.int32)
            error = [sum(map(int, row)) for row in zip(*[d for _, d in found])]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), pa.array(list(codes), pa.list_(pa.int32())), pa.array([e if e < 1 << 63 else None for e in error], pa.int64())], schema.names
            )

    return usable(vectors).where(F.size("x") == at[-1]).mapInArrow(run, schema)


def decode(coded: DataFrame, books: list[np.ndarray], codes: str = "codes") -> DataFrame:
    """The rows with the integer vector ``restored`` that their codes stand for. Codebooks are of fixed size and are literals of the plan."""
    if not books:
        return coded.withColumn("restored", F.array().cast("array<long>"))
    entries = [F.from_json(F.lit(str(b.tolist())), "array<array<bigint>>") for b in books]
    return coded.withColumn("restored", F.flatten(F.array(*[F.get(e, F.get(codes, F.lit(p))) for p, e in enumerate(entries)])))


def fingerprint(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def digest(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (summed over equal labels) and codebooks_sha256."""
    books = fit(vectors, parts, entries, rounds)
    rows = encode(vectors, books)
    if books:
        rows = cut(rows)  # the sums of labels and their rows both read it
    labels = rows.groupBy("label").agg(F.when(F.count_if(F.col("error").isNull()) == 0, F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")).alias("label_error"))
    if books:
        labels = cut(labels)
        if labels.count() <= BROADCAST_LABELS:
            labels = F.broadcast(labels)
    sums = labels.withColumnRenamed("label", "__label")
    both = rows.join(sums, rows["label"].eqNullSafe(sums["__label"]), "left")
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return both.select("vec_id", code.alias("code"), "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))
