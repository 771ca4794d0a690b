"""Variable-capacity best-fit packing of documents into training sequences.

A document's length is its number of tokens by the public byte-level BPE, which it is encoded with whole, and one for its end. One longer
than the largest permitted length is cut into full sequences and a rest, between tokens. Pieces are dealt by hash into shards of bounded
size, equal ones too, for each is told from the others by its number among them; each shard is packed by itself: longest first,
into the open sequence with the least room that suffices. Where none has room, the size is opened whose cost for each token it can
expect to hold is least. This is done once for each largest size allowed, the cheapest packing is taken, and at last every
sequence is downsized to the least permitted length that holds its contents.

Cost of a sequence of length c: OVERHEAD + c + c*c / ATTENTION.

Cases: null texts count as empty, and an empty document is its end token alone; ties in length go by doc_id and piece;
rows that repeat a doc_id are packed each; a null doc_id is packed like others; strings of special tokens are ordinary text; an empty table gives an empty table; extra
columns pass by."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import tokencounts
from millrace.llm.runtime import cut
from millrace.session import ship_package

CAPACITIES = (1024, 2048, 4096, 8192, 16384)
OVERHEAD, ATTENTION = 128.0, 65536.0
#: Pieces in a shard, on average: what one task holds. Equal rows that are dealt out at once.
SHARD_ROWS, COPIES = 8192, 65536


def cost(c: float) -> float:
    return OVERHEAD + c + c * c / ATTENTION


def best_fit(lengths: list[int], sizes: tuple[int, ...]) -> tuple[list[int], list[int], list[int]]:
    """(bin of each item, offset of each item, contents of each bin) for items in decreasing order of length."""
    room: list[int] = []  # distinct amounts of room, ascending
    with_room: dict[int, list[int]] = {}
    bins, offsets, filled, capacity = [], [], [], []
    rest = sum(lengths)
    for size in lengths:
        at = bisect_left(room, size)
        if at < len(room):
            b = with_room[room[at]].pop()
            if not with_room[room[at]]:
                del with_room[room[at]]
                room.pop(at)
        else:
            c = min((c for c in sizes if c >= size), key=lambda c: cost(c) / min(c, rest))
            b = len(filled)
            filled.append(0)
            capacity.append(c)
        bins.append(b)
        offsets.append(filled[b])
        filled[b] += size
        rest -= size
        if left := capacity[b] - filled[b]:
            if left not in with_room:
                insort(room, left)
                with_room[left] = []
            with_room[left].append(b)
    return bins, offsets, filled


def pack_lengths(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """(bin, offset of each item; final capacity of each bin): the cheapest of the packings by largest size allowed."""
    caps = tuple(sorted(capacities))
    least = lambda n: caps[bisect_left(caps, n)]
    best = None
    for k in range(bisect_left(caps, max(lengths, default=0)), len(caps)):
        bins, offsets, filled = best_fit(lengths, caps[: k + 1])
        final = [least(n) for n in filled]
        total = sum(map(cost, final))
        if best is None or total < best[0]:
            best = total, bins, offsets, final
    return best[1:] if best else ([], [], [])


def pieces(docs: DataFrame, top: int, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, piece, start, length (in tokens) and copy, the number of a piece among equal ones."""
    sizes = tokencounts.lengths(docs, path, pattern).select("doc_id", (F.col("length") + 1).alias("n"))
    # equal rows are counted, not gathered, and dealt out again in arrays of bounded size
    equal = sizes.groupBy("doc_id", "n").agg(F.count("*").alias("rows"))
    many = equal.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / COPIES).cast("long"))))
    last = F.least(F.lit(COPIES).cast("long"), F.col("rows") - F.col("part") * COPIES) - 1
    each = many.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("copy", F.col("copy") + F.col("part") * COPIES)
    cuts = each.withColumn("piece", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / top) - 1).cast("int"))))
    start = F.col("piece") * F.lit(top).cast("long")
    return cuts.select("doc_id", "piece", start.alias("start"), F.least(F.lit(top).cast("long"), F.col("n") - start).alias("length"), "copy")


def pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, shard_rows: int = SHARD_ROWS, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, piece, start (first token of the piece), length (tokens), bin_id, bin_offset and capacity of every piece."""
    ship_package(docs.sparkSession)
    found = cut(pieces(docs, max(capacities), path, pattern))  # encoded once, counted and dealt
    shards = max(1, -(-found.count() // shard_rows))
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "length", "copy"), F.lit(shards)))

    def one(key, rows):
        rows = rows.take(pc.sort_indices(rows, [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]))
        bins, offsets, final = pack_lengths(rows["length"].to_pylist(), capacities)
        bins = np.array(bins, np.int64)
        made = [pa.array(bins + (key[0].as_py() << 32)), pa.array(offsets, pa.int64()), pa.array(np.array(final, np.int64)[bins])]
        # ids stay in Arrow: a null would turn a column of them into floats elsewhere
        return pa.table([rows[c] for c in ("doc_id", "piece", "start", "length")] + made, ["doc_id", "piece", "start", "length", "bin_id", "bin_offset", "capacity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("shard").applyInArrow(one, f"doc_id {kind}, piece int, start long, length long, bin_id long, bin_offset long, capacity long")
