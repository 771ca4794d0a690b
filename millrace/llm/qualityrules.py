"""Quality rules: how far a document's character classes and common words diverge from its language's.

The common words of a language are learned: those found in most of its documents, counted over all of them, ties to the smaller hash.
Each document gets a histogram of character classes and one of its language's common words, all others being one more bin. Their sums
over all documents of a language are that language's first references; the final ones are the sums over those documents that the base
rules don't fail and that are no farther than TRIM from the first, so that junk doesn't blur what it is held against. A document passes
if the Jensen-Shannon distances (base 2, square root) from both stay within limits that widen for short texts, and if the base rules don't
fail it. Texts below the minimum lengths are judged by the base rules only.

Base counts: words are runs of bytes other than space and 0x09-0x0D; lines end at \\n.

Cases: null and empty texts have all counts 0, fail the base rules and aren't kept; documents of a null language, or of one with fewer
than MIN_DOCS documents, are held against all documents and their common words; a language with fewer than MIN_DOCS documents near its
first references keeps those; repeated rows get the same verdict; an empty table gives an empty table; extra columns pass by."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.runtime import blocks, cut, text_of
from millrace.llm.textblock import STEPS, TextBlock, U, distinct_pairs, mix
from millrace.session import ship_package

#: Documents that a language needs for references of its own, and common words learned for it.
MIN_DOCS, N_COMMON = 20, 60
#: Rows of a table of languages up to which it is broadcast (about 1.2 kB each); a larger one is joined by shuffling.
BROADCAST_ROWS = 10_000
#: Lengths from which the distances are judged.
MIN_CHARS, MIN_WORDS = 200, 40
#: Character distance from the first reference up to which a document counts for the final one.
TRIM = 0.2
#: Limit of a distance: LIMIT + WIDEN / sqrt(characters or words).
CHAR_LIMIT, CHAR_WIDEN = 0.12, 3.0
WORD_LIMIT, WORD_WIDEN = 0.21, 2.0
MIN_BASE_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8

_CLASSES = ("a-z", "A-Z", "0-9", " \t\v\f\r", "\n", ".", ",", "!?", "#*$%&|<>", "'\"()-:;", "other ASCII", "beyond ASCII")
_CLASS = np.full(256, 10, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
for _i, _chars in ((3, b" \t\v\f\r"), (4, b"\n"), (5, b"."), (6, b","), (7, b"!?"), (8, b"#*$%&|<>"), (9, b"'\"()-:;")):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _i
_CLASS[192:] = 11
N_CLASSES = len(_CLASSES)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_words(text: pa.Array, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each group's distinct words, A-Z lower-cased: group, hash, documents with the word, occurrences."""
    block = TextBlock(text, lower=True)
    s, e, d = block.words()
    h, g = block.span_hash(s, e), group[d]
    order = np.lexsort((d, h, g))
    h, g, d = h[order], g[order], d[order]
    word = np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))[: len(h)]
    doc = word | np.append(True, d[1:] != d[:-1])[: len(h)]
    at = np.flatnonzero(word)
    n_docs = np.add.reduceat(doc.astype(np.int64), at) if len(at) else at
    return g[at], h[at], n_docs, np.diff(np.append(at, len(h)))


def measure(text: pa.Array, group: np.ndarray | None = None, common: list[np.ndarray] | None = None) -> list:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, character classes, and counts of the words in ``common`` of the
    text's group (the last is all others)."""
    block = TextBlock(text)
    n, buf = block.n, block.buf
    s, e, d = block.words()
    h = block.span_hash(s, e)
    n_words = np.bincount(d, minlength=n)
    lead = (buf & 0xC0) != 0x80
    word_chars = block.per_doc(lead & ~block.space())
    n_symbols = block.per_doc(_SYMBOL[buf])
    ls, le, ld = block.lines()
    inked = np.searchsorted(s, le, "left") > np.searchsorted(s, ls, "left")
    lh, ld = block.span_hash(ls[inked], le[inked]), ld[inked]
    n_dup = np.bincount(ld, minlength=n) - np.bincount(distinct_pairs(lh, ld)[1], minlength=n)
    covered = np.zeros(len(h), bool)
    if len(h) >= WINDOW:
        at = np.flatnonzero(d[: len(d) - WINDOW + 1] == d[WINDOW - 1 :])
        g = np.zeros(len(at), U)
        for k in range(WINDOW):
            g += h[at + k] * STEPS[1 + k]
        g = mix(g + d[at].astype(U) * STEPS[30])
        order = np.argsort(g, kind="stable")
        same = g[order][1:] == g[order][:-1]
        twice = order[np.append(same, False) | np.append(False, same)] if len(order) else order
        delta = np.zeros(len(h) + 1, np.int64)
        np.add.at(delta, at[twice], 1)
        np.add.at(delta, at[twice] + WINDOW, -1)
        covered = np.cumsum(delta)[:-1] > 0
    n_repeat = np.bincount(d[covered], minlength=n)
    doc_of_byte = np.repeat(np.arange(n), np.diff(block.off))[lead]
    chars = np.bincount(doc_of_byte * N_CLASSES + _CLASS[buf[lead]], minlength=n * N_CLASSES)
    group = np.zeros(n, np.int64) if group is None else group
    keyed = [mix(x.astype(U) + np.full(len(x), g + 1, U) * STEPS[31]) for g, x in enumerate(common or [])]
    keys = np.concatenate(keyed) if keyed else np.zeros(0, U)
    cls = np.full(len(h), N_COMMON, np.int64)
    if len(keys) and len(h):
        which = np.concatenate([np.arange(len(x)) for x in keyed])
        order = np.argsort(keys)
        keys, which = keys[order], which[order]
        hw = mix(TextBlock(text, lower=True).span_hash(s, e) + (group[d] + 1).astype(U) * STEPS[31])
        at = np.minimum(np.searchsorted(keys, hw), len(keys) - 1)
        cls = np.where(keys[at] == hw, which[at], N_COMMON)
    words = np.bincount(d * (N_COMMON + 1) + cls, minlength=n * (N_COMMON + 1))
    lists = lambda x, k: pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), x.astype(np.int32))
    return [*(x.astype(np.int64) for x in (n_words, word_chars, n_symbols, n_dup, n_repeat)), lists(chars, N_CLASSES), lists(words, N_COMMON + 1)]


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p from the same row of q; rows are counts, a row without any is 0 away."""
    a = p / np.maximum(p.sum(1, keepdims=True), 1e-300)
    b = q / np.maximum(q.sum(1, keepdims=True), 1e-300)
    m = (a + b) / 2
    part = lambda x: np.where(x > 0, x * np.log2(np.where(x > 0, x, 1.0) / np.where(m > 0, m, 1.0)), 0.0).sum(1)
    d = np.sqrt(np.clip((part(a) + part(b)) / 2, 0.0, 1.0))
    return np.where((p.sum(1) > 0) & (q.sum(1) > 0), d, 0.0)


def _beside(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Left join with a table of a row a language; it is broadcast only if it has few rows."""
    return df.join(F.broadcast(side) if side.count() <= BROADCAST_ROWS else side, key, "left")


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word (hash), n_docs and n over all documents."""
    ship_package(docs.sparkSession)
    out = T.StructType([T.StructField("lang", docs.schema["lang"].dataType), *(T.StructField(c, T.LongType()) for c in ("word", "n_docs", "n"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in blocks(batch):
                part = batch.slice(lo, hi - lo)
                langs = part.column(0).dictionary_encode("encode")
                g, h, n_docs, n = count_words(text_of(part), np.asarray(langs.indices, np.int64))
                yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(g)), pa.array(h.view(np.int64)), pa.array(n_docs), pa.array(n)], out.names)

    return docs.select("lang", "text").mapInArrow(run, out).groupBy("lang", "word").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))


def common_words(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """grp and common (hashes) of every language with enough documents. Spark cuts each task's rows to N_COMMON a language before they move."""
    size = docs.groupBy(F.col("lang").alias("grp")).agg(F.count("*").alias("docs")).where(f"grp is not null and docs >= {MIN_DOCS}")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n_docs"), "word"))
    top = counts.where("lang is not null").withColumn("place", place).where(F.col("place") <= N_COMMON)
    lists = top.groupBy(F.col("lang").alias("grp")).agg(F.collect_list("word").alias("common"))
    return size.join(lists, "grp", "left").select("grp", F.coalesce("common", F.array().cast("array<long>")).alias("common"))


def measures(docs: DataFrame, lists: DataFrame, pooled: np.ndarray) -> DataFrame:
    """doc_id, grp (null: held against all documents), the base counts and both histograms of every document."""
    ints = T.ArrayType(T.IntegerType())
    source = _beside(docs.select("doc_id", F.col("lang").alias("grp"), "text"), lists, "grp")
    source = source.select("doc_id", F.when(F.col("common").isNotNull(), F.col("grp")).alias("grp"), "common", "text")
    made = [*(T.StructField(c, T.LongType()) for c in _BASE), T.StructField("chars", ints), T.StructField("words", ints)]
    out = T.StructType([*source.schema.fields[:2], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in blocks(batch):
                part = batch.slice(lo, hi - lo)
                code = np.asarray(part.column(1).dictionary_encode("mask").indices.fill_null(-1), np.int64) + 1
                lists = [pooled] * (int(code.max()) + 1)
                for g, row in zip(*np.unique(code, return_index=True)):
                    if g:
                        lists[g] = np.asarray(part.column(2)[int(row)].values, np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *measure(text_of(part), code, lists)], out.names)

    return source.mapInArrow(run, out)


def references(measured: DataFrame) -> DataFrame:
    """grp, docs, ref_chars and ref_words: sums of the histograms over all documents of each group."""
    total = lambda c, k: [F.sum(F.get(c, F.lit(i)).cast("long")).alias(f"{c}{i}") for i in range(k)]
    by = measured.groupBy("grp").agg(F.count("*").alias("docs"), *total("chars", N_CLASSES), *total("words", N_COMMON + 1))
    together = lambda c, k: F.array(*[F.col(f"{c}{i}") for i in range(k)]).alias(f"ref_{c}")
    return by.select("grp", "docs", together("chars", N_CLASSES), together("words", N_COMMON + 1))


def _pooled_chars(ref: DataFrame) -> list[int]:
    """Character classes of all groups together: one row."""
    r = ref.agg(*[F.sum(F.get("ref_chars", F.lit(i))) for i in range(N_CLASSES)]).first()
    return [x or 0 for x in r]


def _distances(measured: DataFrame, ref: DataFrame, chars: list[int], words: list[int]) -> DataFrame:
    """measured with base_failed, char_distance and word_distance from its group's references; chars and words stand in for none."""
    constant = lambda x: F.array(*[F.lit(int(i)).cast("long") for i in x])
    rows = _beside(measured, ref.where("grp is not null").select("grp", "ref_chars", "ref_words"), "grp")
    rows = rows.withColumns({"ref_chars": F.coalesce("ref_chars", constant(chars)), "ref_words": F.coalesce("ref_words", constant(words))})
    rows = rows.select(*measured.columns, "ref_chars", "ref_words")
    out = T.StructType([*measured.schema.fields, T.StructField("base_failed", T.BooleanType()), T.StructField("char_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType())])
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_repeat = np.asarray(batch.column(2)), np.asarray(batch.column(6))
            wide = lambda i, k: np.asarray(batch.column(i).flatten(), dtype=float).reshape(-1, k)
            dc = js_distance(wide(7, N_CLASSES), wide(9, N_CLASSES))
            dw = js_distance(wide(8, N_COMMON + 1), wide(10, N_COMMON + 1))
            failed = (n_words < MIN_BASE_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(failed), pa.array(dc), pa.array(dw)], names)

    return rows.mapInArrow(run, out)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, char_distance and word_distance of every document."""
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = cut(word_counts(docs))
    all_words = counts.groupBy("word").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))
    top = all_words.orderBy(F.desc("n_docs"), "word").limit(N_COMMON).collect()
    spare = (counts.agg(F.sum("n")).first()[0] or 0) - sum(r["n"] for r in top)
    words = [r["n"] for r in top] + [0] * (N_COMMON - len(top)) + [spare]
    pooled = np.array([r["word"] for r in top], np.int64)
    measured = cut(measures(docs, cut(common_words(docs, counts)), pooled))
    first = cut(references(measured))
    near = _distances(measured, first, _pooled_chars(first), words).where(f"not base_failed and char_distance <= {TRIM}")
    last = cut(references(near.select(*measured.columns)))
    trimmed = last.where(f"docs >= {MIN_DOCS}").select("grp", F.col("ref_chars").alias("c"), F.col("ref_words").alias("w"))
    ref = first.join(trimmed, "grp", "left").select("grp", F.coalesce("c", "ref_chars").alias("ref_chars"), F.coalesce("w", "ref_words").alias("ref_words"))
    n_chars = F.aggregate("chars", F.lit(0).cast("long"), lambda s, x: s + x)
    limit = lambda least, n, base, widen, d: (n >= least) & (F.col(d) > base + widen / F.sqrt(n))
    far = limit(MIN_CHARS, n_chars, CHAR_LIMIT, CHAR_WIDEN, "char_distance") | limit(MIN_WORDS, F.col("n_words"), WORD_LIMIT, WORD_WIDEN, "word_distance")
    found = _distances(measured, cut(ref), _pooled_chars(last), words).withColumn("kept", ~F.col("base_failed") & ~far)
    return found.select("doc_id", *_BASE, "base_failed", "kept", "char_distance", "word_distance")
