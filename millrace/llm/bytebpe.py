"""Byte-level BPE encoding and decoding by a two-tier lookup.

A block of texts is cut into pre-tokens by the vocabulary's pattern, and each distinct pre-token of the block is encoded once. First tier: a minimal perfect
hash over the vocabulary (hash and displace: as many slots as entries, one displacement a bucket) gives the one entry that a pre-token could be; if
its bytes agree, that is the whole encoding. Second tier, for the rest: its bytes become a linked list, a heap holds neighbours whose union is in the
vocabulary by rank and place, and the least is merged until none is left, so a pre-token of n bytes takes n log n steps, however long.
Decoding concatenates the entries' bytes.

The vocabulary is of fixed size and goes out as a broadcast; its hash is made once in each worker.

Cases: null and empty texts have no tokens; texts of any length are encoded whole; strings of special tokens are ordinary text; repeated rows are encoded
each; unknown or null ids fail when decoded; an empty table gives an empty table; extra columns pass by."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.runtime import map_blocks
from millrace.llm.tokencounts import default_vocabulary
from millrace.session import ship_package

#: Keys that share a displacement, on average; merged pre-tokens, and their longest, that a worker remembers until it forgets all.
BUCKET, REMEMBERED, SHORT = 2, 1 << 18, 64
#: Bytes of text encoded together, and lists of ids decoded together.
BLOCK, ROWS = 4 << 20, 256
_MIX, _STEP = 0xFF51AFD7ED558CCD, 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


class PerfectHash:
    """A minimal perfect hash: key k of ``keys`` has a slot of its own among len(keys) slots."""

    def __init__(self, keys: list[bytes]):
        import xxhash

        self.digest = xxhash.xxh64_intdigest
        n = self.n = len(keys)
        self.buckets = max(1, n // BUCKET)
        by: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        hashes = [self.digest(k) for k in keys]
        if len(set(hashes)) < n:
            raise ValueError("two keys are the same, or hash alike")
        for k, h in enumerate(hashes):
            by[h % self.buckets].append((k, h))
        self.moved, self.key = [0] * self.buckets, [-1] * n
        order = sorted(range(self.buckets), key=lambda b: -len(by[b]))
        for b in order:
            if len(by[b]) < 2:
                continue
            d = 0
            while True:  # a displacement that puts all keys of the bucket into free slots of their own
                slots = [self._place(h, d) for _, h in by[b]]
                if len(set(slots)) == len(slots) and all(self.key[s] < 0 for s in slots):
                    break
                d += 1
            self.moved[b] = d
            for (k, _), s in zip(by[b], slots):
                self.key[s] = k
        free = (s for s in range(n) if self.key[s] < 0)
        for b in order:  # a bucket of one key names its slot
            if len(by[b]) == 1:
                s = next(free)
                self.moved[b], self.key[s] = -1 - s, by[b][0][0]
        self.moved_array, self.key_array = np.array(self.moved, np.int64), np.array(self.key, np.int64)

    def _place(self, h: int, d: int) -> int:
        x = ((h ^ (d * _STEP & _ALL)) * _MIX) & _ALL
        return (x ^ x >> 32) % self.n

    def find(self, keys: list[bytes]) -> np.ndarray:
        """For each byte string the only key that it could be, as its number; -1 if there are no keys."""
        if not self.n:
            return np.full(len(keys), -1)
        h = np.fromiter(map(self.digest, keys), np.uint64, len(keys))
        d = self.moved_array[(h % np.uint64(self.buckets)).astype(np.int64)]
        x = (h ^ (np.maximum(d, 0).astype(np.uint64) * np.uint64(_STEP))) * np.uint64(_MIX)
        x = ((x ^ (x >> np.uint64(32))) % np.uint64(self.n)).astype(np.int64)
        return self.key_array[np.where(d < 0, -1 - d, x)]


class Vocabulary:
    """Ranks of byte strings, behind a minimal perfect hash."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex

        pairs = [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in ranks.splitlines() if line)]
        self.words, self.rank = [w for w, _ in pairs], [r for _, r in pairs]
        self.hash = PerfectHash(self.words)
        order = np.argsort(np.array(self.rank, np.int64))
        self.ranks = np.array(self.rank, np.int64)[order]
        self.entries = pa.array(self.words, pa.large_binary()).take(order)
        self.split = regex.compile(pattern).findall
        self.memory: dict[bytes, list[int]] = {}
        known = dict(pairs)
        self.byte = [known.get(bytes([b])) for b in range(256)]
        #: rank of the union of two neighbours, by their ranks: every way to cut an entry into two entries
        self.union: list[dict[int, int]] = [{} for _ in range(max(self.rank, default=-1) + 2)]  # the last stands for what is before the first
        for w, r in pairs:
            for i in range(1, len(w)):
                if (a := known.get(w[:i])) is not None and (b := known.get(w[i:])) is not None:
                    self.union[a][b] = r

    def merge(self, word: bytes) -> list[int]:
        """Ranks of a byte string that isn't in the vocabulary as a whole. A heap entry is the rank of a union and its place; one that no longer fits is passed over."""
        n, union = len(word), self.union
        part = [*map(self.byte.__getitem__, word), -1]  # -1 stands before the first and behind the last
        if None in part:
            raise ValueError(f"the vocabulary lacks a byte of {word[:99]!r}")
        before, after, bits = list(range(-1, n)), list(range(1, n + 1)), n.bit_length()
        heap = [u << bits | i for i in range(n - 1) if (u := union[part[i]].get(part[i + 1])) is not None]
        heapify(heap)
        place = (1 << bits) - 1
        while heap:
            top = heappop(heap)
            i, r = top & place, top >> bits
            j = after[i]
            if union[part[i]].get(part[j]) != r:
                continue
            part[i], part[j] = r, -1
            after[i] = k = after[j]
            before[k] = i
            if (u := union[r].get(part[k])) is not None:
                heappush(heap, u << bits | i)
            h = before[i]
            if (u := union[part[h]].get(r)) is not None:
                heappush(heap, u << bits | h)
        return [p for p in part if p >= 0]

    def merged(self, word: bytes) -> list[int]:
        """merge, remembered for short words."""
        found = self.memory.get(word)
        if found is None:
            found = self.merge(word)
            if len(word) <= SHORT:
                if len(self.memory) >= REMEMBERED:
                    self.memory.clear()
                self.memory[word] = found
        return found

    def encode(self, texts: list[str | None]) -> pa.Array:
        """Ranks of each text; every distinct pre-token of them is looked up once."""
        words: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for k, t in enumerate(texts):
            if t:
                words += self.split(t)
            ends[k + 1] = len(words)
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        code = coded.indices.to_numpy()
        at = np.empty(len(coded.dictionary), np.int64)
        at[code] = np.arange(len(code))
        keys = [words[i].encode() for i in at.tolist()]
        whole = self.hash.find(keys)
        ids = [[self.rank[k]] if k >= 0 and self.words[k] == w else self.merged(w) for k, w in zip(whole.tolist(), keys)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
        begin = np.cumsum(size) - size
        take = size[code]
        stop = np.concatenate(([0], np.cumsum(take)))
        laid = flat[np.arange(stop[-1]) + np.repeat(begin[code] - stop[:-1], take)]
        return pa.ListArray.from_arrays(pa.array(stop[ends].astype(np.int32)), pa.array(laid))

    def decode(self, ids: pa.Array) -> pa.Array:
        """The bytes of each list of ids; null for a null list. All entries are laid end to end by one gather, and lists take their stretches of that."""
        lists = ids.cast(pa.large_list(pa.int64()))
        begin = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset : lists.offset + len(lists) + 1]
        flat = lists.values.slice(begin[0], begin[-1] - begin[0])
        if flat.null_count:
            raise ValueError("a null id")
        at = np.searchsorted(self.ranks, ids := flat.to_numpy())
        if (bad := self.ranks[np.minimum(at, len(self.ranks) - 1)] != ids).any():
            raise ValueError(f"unknown id {ids[bad][0]}")
        laid = self.entries.take(pa.array(at))
        end = np.frombuffer(laid.buffers()[1], np.int64)[laid.offset : laid.offset + len(laid) + 1]
        made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(end[begin - begin[0]].copy()), laid.buffers()[2]])
        return pc.if_else(lists.is_valid(), made, None)


_made: dict[tuple, Vocabulary] = {}


def vocabulary(ranks: bytes, pattern: str) -> Vocabulary:
    """The vocabulary, made once in each worker."""
    key = hash(ranks), pattern
    if key not in _made:
        _made.clear()
        _made[key] = Vocabulary(ranks, pattern)
    return _made[key]


def _shared(spark: SparkSession, path: str | None, pattern: str | None):
    """The rank file, of fixed size, as a broadcast, and the pattern."""
    if path is None or pattern is None:
        path, pattern = default_vocabulary()
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read()), pattern


def encode(docs: DataFrame, keep: list[str] | None = None, text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``keep`` (doc_id) and ids of every whole text."""
    shared, pattern = _shared(docs.sparkSession, path, pattern)
    run = lambda text: [vocabulary(shared.value, pattern).encode(text.to_pylist())]
    return map_blocks(docs, run, keep or ["doc_id"], [T.StructField("ids", T.ArrayType(T.IntegerType()))], text, BLOCK)


def decode(coded: DataFrame, keep: list[str] | None = None, ids: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``keep`` (all other columns) and decoded, the bytes of the ids; a null list gives null."""
    spark = coded.sparkSession
    ship_package(spark)
    shared, pattern = _shared(spark, path, pattern)
    keep = [c for c in coded.columns if c != ids] if keep is None else keep
    source = coded.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([T.StructField(c, coded.schema[c].dataType) for c in keep] + [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(shared.value, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                made = known.decode(part.column(len(keep))).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + [made], schema.names)

    return source.mapInArrow(run, schema)


def joined(ids: str | Column) -> Column:
    """Decimal ids, joined by one space."""
    return F.array_join((F.col(ids) if isinstance(ids, str) else ids).cast("array<string>"), " ")


def digest(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text, encoded and decoded again."""
    coded = encode(docs, path=path, pattern=pattern)
    coded = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined("ids").cast("binary"), 256).alias("ids_sha256"), "ids")
    back = decode(coded, path=path, pattern=pattern)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
