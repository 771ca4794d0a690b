"""Phrase collocations by Apriori passes: level by level, the frequent (k-1)-grams go to every task, which counts a k-gram only where both of its
overlapping subgrams are frequent; each phrase is then cut in two at its weakest place, by the level tables.

Texts are folded (A-Z to a-z), split into pieces at punctuation and line ends and those into words. A task codes the words of a block by number,
so that grams are told apart exactly, and counts those of the block. The passes of levels 2 and more let out 40-bit hashes of grams with their counts, which Spark
sums, map-side first: a hash that is found often enough may stand for a frequent gram, none else can. One last pass counts the grams of all levels
whose hash is such a one by their words, and that count decides. So hashes only decide what is worth counting; a gram let through by a
collision is counted over all its occurrences like any other and falls by its count.

What is broadcast of a level are its frequent grams' hashes, sorted, while there are at most EXACT of them; beyond that a bit map whose size
never passes BITS. If the bit map fills, more is counted, nothing is lost.

Cases: a null text is empty; a null language is "und"; words of other scripts and characters are words; texts of any length are taken whole;
repeated rows count each; an empty table gives an empty table; extra columns pass by unread."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.runtime import cut, ranges, text_of
from millrace.session import ship_package

#: Production parameters: least count, longest phrase in words, phrases reported for each language.
LEAST, LONGEST, TOP = 100, 5, 2000
#: Frequent grams of a level that are broadcast as hashes, and the bits that stand for them beyond that.
EXACT, BITS = 1 << 21, 1 << 28
#: Bytes of text that are counted together before anything is emitted.
BLOCK = 4 << 20
UNKNOWN = "und"
#: A byte that no UTF-8 text holds stands for the end of a piece.
_BREAK = b"\xff"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 0xFF if b in b".,;:!?" or 10 <= b <= 13 else b for b in range(256))
#: Hashes of grams keep 40 bits.
_DROPPED = np.uint64(24)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of the texts in order, with a break between pieces."""
    return _BREAK.join(texts).translate(_FOLD).replace(_BREAK, b" \xff ").split()


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    import xxhash

    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words)) >> _DROPPED


def gram_hashes(words: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the grams of ``size`` words that begin at ``start``, from the hashes of all words."""
    h = np.zeros(len(start), np.uint64)
    for k in range(size):
        h = (h ^ words[start + k]) * _PRIME
        h ^= h >> np.uint64(29)
    return h >> _DROPPED


class Known:
    """Which grams of a level may be frequent: sorted hashes, or a bit map. Never says no to a frequent one."""

    def __init__(self, hashes: np.ndarray | None = None, bitmap: np.ndarray | None = None):
        self.hashes, self.bitmap = hashes, bitmap

    def has(self, h: np.ndarray) -> np.ndarray:
        if self.bitmap is not None:
            slot = h & np.uint64(len(self.bitmap) * 64 - 1)
            return (self.bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
        if not len(self.hashes):
            return np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return self.hashes[at] == h


def count_words(texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """(word, count), and the number of all words under the empty one."""
    coded = pa.array(tokens(texts), pa.binary()).dictionary_encode()
    words, n = coded.dictionary, np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
    some = np.flatnonzero(np.arange(len(words)) != pc.index(words, pa.scalar(_BREAK)).as_py())
    return pa.concat_arrays([pa.array([b""]), words.take(some)]), pa.array(np.append(n[some].sum(), n[some]))


def grams(texts: list[bytes], lang: str, known: list[Known]) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray]]:
    """(columns of words, hashes, counts) of the block's distinct grams of 2, 3 ... words: of the known levels those that may be frequent, and of the level
    after them those whose subgrams both may be."""
    all_words = tokens(texts)
    coded = pa.array(all_words, pa.binary()).dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    at = np.empty(len(words), np.int64)
    at[code] = np.arange(len(code))
    hashes = word_hashes([all_words[i] for i in at.tolist()], lang)
    good = known[0].has(hashes)
    if (stop := pc.index(words, pa.scalar(_BREAK)).as_py()) >= 0:
        good[stop] = False
    gram, hashed = np.where(good, np.arange(len(good)), -1)[code], hashes[code]
    for size in range(2, len(known) + 2):
        both = np.flatnonzero((gram[:-1] >= 0) & (gram[1:] >= 0))
        h = gram_hashes(hashed, both, size)
        if size <= len(known):
            some = known[size - 1].has(h)
            both, h = both[some], h[some]
        _, first, same, n = np.unique(gram[both] << 32 | gram[both + 1], return_index=True, return_inverse=True, return_counts=True)
        gram = np.full(len(code), -1)
        gram[both] = same
        yield [words.take(code[both[first] + k]) for k in range(size)], h[first], n


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")


def _blocks(texts: DataFrame, count, schema: str) -> DataFrame:
    """``count(texts, lang)`` of every block of every language gives lists of columns, the first of them lang if the schema begins with it."""
    named = schema.startswith("lang")
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = text_of(batch)
            for lo, hi in ranges(text, BLOCK, max(1, len(text))):
                by: dict[str, list[bytes]] = {}
                for lang, t in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), text.slice(lo, hi - lo).cast(pa.large_binary()).to_pylist()):
                    by.setdefault(lang, []).append(t)
                for lang, some in by.items():
                    for columns in count(some, lang):
                        yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(columns[0])), *columns] if named else columns, names)

    return texts.mapInArrow(run, schema)


def _words(texts: DataFrame) -> DataFrame:
    def count(some: list[bytes], lang: str):
        phrase, n = count_words(some)
        yield [phrase.cast(pa.string()), n]

    return _blocks(texts, count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _slots(texts: DataFrame, known: list) -> DataFrame:
    """slot, f: counts of the next level's grams by hash."""

    def count(some: list[bytes], lang: str):
        *_, (_, h, n) = grams(some, lang, [b.value for b in known])
        yield [pa.array(h.view(np.int64)), pa.array(n.astype(np.int32))]

    return _blocks(texts, count, "slot long, n int").groupBy("slot").agg(F.sum("n").alias("f"))


def _phrases(texts: DataFrame, known: list) -> DataFrame:
    """lang, phrase, f of all grams of 2 words and more that may be frequent."""

    def count(some: list[bytes], lang: str):
        tables = [b.value for b in known]
        for words, _, n in grams(some, lang, tables):
            if len(words) <= len(tables):
                yield [pc.binary_join_element_wise(*words, b" ").cast(pa.string()), pa.array(n)]

    return _blocks(texts, count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _hashed(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([int(word_hashes([w.encode()], lang)[0]) for lang, w in pairs], pa.int64())], ["slot"])

    return words.select("lang", "phrase").mapInArrow(run, "slot long")


def _known(slots: DataFrame, exact: int, bits: int):
    """A level's frequent hashes as a broadcast of bounded size; None if there are none."""
    n = slots.count()
    if n == 0:
        return None
    if n <= exact:
        table = Known(hashes=np.sort(slots.select("slot").toPandas()["slot"].to_numpy(np.int64).view(np.uint64)))
    else:
        size = min(bits, 1 << (16 * n).bit_length())
        slot = F.col("slot").bitwiseAND(F.lit(size - 1))
        words = slots.select(F.shiftright(slot, 6).alias("w"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()  # size / 64 rows at most
        bitmap = np.zeros(size // 64, np.uint64)
        bitmap[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
        table = Known(bitmap=bitmap)
    return slots.sparkSession.sparkContext.broadcast(table)


def levels(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, exact: int = EXACT, bits: int = BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n: all words; lang, phrase, f of the frequent words; the same of the frequent phrases of 2 to ``longest`` words)."""
    ship_package(docs.sparkSession)
    texts = _texts(docs)
    often = F.col("f") >= least
    first = cut(_words(texts).where(often | (F.col("phrase") == "")))
    totals, words = first.where("phrase = ''").select("lang", F.col("f").alias("n")), first.where("phrase <> ''")
    known = [_known(cut(_hashed(words)), exact, bits)]
    while known[-1] is not None and len(known) < longest:
        known.append(_known(cut(_slots(texts, known).where(often)), exact, bits))
    known = [k for k in known if k is not None]  # whatever is longer is rarer still
    phrases = cut(_phrases(texts, known).where(often)) if len(known) > 1 else words.limit(0)
    return totals, words, phrases


def _scored(rows: DataFrame) -> DataFrame:
    """rows with score, floor(1000 * f * n / (l * r)) by integers of up to 38 digits."""
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    top = (wide("f") * wide("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    return rows.withColumn("__top", top).withColumn("__bottom", wide("l") * wide("r")).withColumn("score", F.expr("__top div __bottom")).drop("__top", "__bottom")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, exact: int = EXACT, bits: int = BITS) -> DataFrame:
    """Every frequent phrase of 2 words or more that no longer phrase explains: lang, phrase, size, a, cut, l, r, n, score."""
    totals, single, phrases = levels(docs, least, longest, exact, bits)
    parts = single.unionByName(phrases)
    words = F.split("phrase", " ")
    rows = phrases.withColumn("words", words).withColumn("size", F.size("words"))
    # a phrase as frequent as one of two more words is as frequent as the one between, so the next level decides
    longer = rows.where("size > 2").select("lang", "f", F.explode(F.array(*[F.array_join(F.slice("words", F.lit(k), F.col("size") - 1), " ") for k in (1, 2)])).alias("phrase"))
    own = rows.join(longer.distinct(), ["lang", "phrase", "f"], "left_anti")
    cuts = own.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("first", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ")).withColumn("rest", F.array_join(F.slice("words", F.col("cut") + 1, F.col("size")), " "))
    side = lambda of, n: parts.select("lang", F.col("phrase").alias(of), F.col("f").alias(n))
    scored = _scored(cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"]).join(totals, "lang"))
    worst = scored.groupBy("lang", "phrase", "size", F.col("f").alias("a"), "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    return worst.select("lang", "phrase", "size", "a", "w.cut", "w.l", "w.r", "n", "w.score")


def top(docs: DataFrame, first: int = TOP, **how) -> DataFrame:
    """Each language's ``first`` collocations by score, count and phrase: lang, rank, phrase, a, l, r, n, score."""
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(docs, **how).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
