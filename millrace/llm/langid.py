"""Language ID by nearest centroid: normalised TF-IDF vectors of hashed byte n-grams against several clustered centroids
per language by cosine, with distance-based rejection.

Cases: null texts and texts without a letter are ``und`` with score 0 and are rejected; bytes that aren't UTF-8 are no letters; ties go to the first language in
alphabetical order; repeated rows get the same answer; without training rows all texts are ``und``, none is rejected for
that alone; rows that repeat a doc_id count once in training, with one of their texts; an empty table gives an empty table; extra columns pass by."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.runtime import BLOCK_BYTES, cut, filter_rows, held_out, map_blocks, ranges
from millrace.llm.textblock import TextBlock
from millrace.llm.training import one_text_an_id, train

DIMS = 4096
#: Bounds of the training sample and model: languages (more are an error), texts a language and in all, characters a text, centroids a language.
MAX_LANGS, PER_LANG, MAX_TEXTS, MAX_CHARS, CENTROIDS = 1000, 600, 6000, 20_000, 3
#: Texts that are counted at once: a dense row each.
BLOCK_TEXTS = 512
#: Bytes that are counted at once, so that a long text takes no more memory than a block of short ones.
COUNT_BYTES = BLOCK_BYTES
#: A text of n distinct n-grams is rejected if it's farther than the language's limit + WIDEN / sqrt(n), so that short and repetitive
#: texts get more room. The limit is the median of the training texts' distances less their room, and SPREADS median absolute deviations.
WIDEN, SPREADS = 4.0, 24.0
TEMPERATURE = 0.03


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (n, DIMS), unit length
    lang_of: np.ndarray  # centroid -> language
    limit: np.ndarray  # language -> largest distance accepted, less the room for few n-grams


def counts(block: TextBlock) -> np.ndarray:
    """(texts, DIMS) counts of 1-, 2- and 3-byte n-grams of lower-cased texts, hashed; all that can't be part of a letter reads as a space."""
    out, end = np.zeros(block.n * DIMS, np.int64), len(block.buf)
    for lo in range(0, end, COUNT_BYTES):
        n = min(COUNT_BYTES, end - lo)
        buf = block.buf[lo : lo + n + 2]  # n-grams begin at n places, and the last ones reach two bytes on
        b = np.where(((buf >= 97) & (buf <= 122)) | (buf >= 128), buf, 32).astype(np.int64)
        doc = block.doc_of(np.arange(lo, lo + len(buf))) if COUNT_BYTES < end else np.repeat(np.arange(block.n), np.diff(block.off))
        out += np.bincount(doc[:n] * DIMS + b[:n], minlength=block.n * DIMS)
        if len(b) > 1:
            first, second = b[:-1][:n], b[1:][:n]
            two = doc[1:][:n] == doc[:-1][:n]
            g = (first * 0x9E3B + second * 0x61C9) * 0x2545F491 >> 13 & DIMS - 1
            out += np.bincount((doc[1:][:n] * DIMS + g)[two], minlength=block.n * DIMS)
        if len(b) > 2:
            three = doc[2:] == doc[:-2]
            g = (b[:-2] * 0x1B873593 + b[1:-1] * 0x3C6EF372 + b[2:] * 0x5BD1E995) * 0x27D4EB2F >> 17 & DIMS - 1
            out += np.bincount((doc[2:] * DIMS + g)[three], minlength=block.n * DIMS)
    return out.reshape(block.n, DIMS)


def vectors(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(c, dtype=np.float32) * idf
    return v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-9)


def room(c: np.ndarray) -> np.ndarray:
    """How much farther than its language's limit a text with these counts may be."""
    return WIDEN / np.sqrt(np.maximum((c > 0).sum(1), 1))


def _cluster(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from farthest-first seeds."""
    seeds = [v.mean(0)]
    while len(seeds) <= min(k, len(v)):
        seeds.append(v[np.argmin(np.max(v @ np.array(seeds).T, axis=1))])
    c = np.array(seeds[1:])
    for _ in range(12):
        near = np.argmax(v @ c.T, axis=1)
        c = np.array([v[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def _distance(c: np.ndarray, v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Distances of training texts from the nearest centroid, less their room."""
    return 1.0 - (v @ centroids.T).max(1) - room(c)


def _robust_limit(far: np.ndarray) -> float:
    middle = np.median(far)
    return float(middle + SPREADS * np.median(np.abs(far - middle)))


def sample(docs: DataFrame, per_lang: int, max_chars: int, max_langs: int) -> DataFrame:
    """lang, doc_id, text: of each language at most ``per_lang`` texts, those of the least hashes of doc_id outside the held-out fourth."""
    known = docs.where(~held_out()).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & F.length("text").between(1, max_chars))
    sizes = cut(known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")))
    n_langs = sizes.count()
    if n_langs > max_langs:
        raise ValueError(f"{n_langs} languages to learn, but the model is bounded by max_langs={max_langs}")
    per_lang = max(1, min(per_lang, MAX_TEXTS // max(1, n_langs)))
    u = (F.xxhash64("doc_id") / F.lit(2.0**64)) + 0.5
    rate = sizes.select("lang", (F.lit(1.5 * per_lang + 20.0) / F.col("ids")).alias("rate"))
    # a first cut by hash, so that few texts are shuffled; an id's rows become one, then each language's least hashes are taken
    some = known.select("lang", "doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(rate), "lang").where(u <= F.col("rate"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    return one_text_an_id(some, "lang", "doc_id").withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_lang).drop("r")


def fit_texts(text: pa.Array, lang: list[str], centroids: int = CENTROIDS) -> Model:
    """Train on texts and their languages, those of a language one behind the other."""
    langs = sorted(set(lang))
    c = {}
    at = {g: [] for g in langs}
    for lo, hi in ranges(text, rows=BLOCK_TEXTS):
        part = counts(TextBlock(text.slice(lo, hi - lo), lower=True)).astype(np.float32)
        for g in set(lang[lo:hi]):
            at[g].append(part[[x == g for x in lang[lo:hi]]])
    for g in langs:
        c[g] = np.concatenate(at.pop(g))
    n = sum(map(len, c.values()))
    idf = (np.log((1.0 + n) / (1.0 + sum((x > 0).sum(0) for x in c.values()))) + 1.0).astype(np.float32)
    cents, lang_of, limit = [], [], []
    for i, g in enumerate(langs):
        v = vectors(c[g], idf)
        # texts too far from the language's mean are left out, or junk would get centroids of its own
        far = _distance(c[g], v, _cluster(v, 1))
        own = _cluster(v[far <= _robust_limit(far)], centroids)
        limit.append(_robust_limit(_distance(c[g], v, own)))
        cents.append(own)
        lang_of += [i] * len(own)
    return Model(langs, idf, np.concatenate(cents).astype(np.float32), np.array(lang_of), np.array(limit))


def fit(docs: DataFrame, per_lang: int = PER_LANG, max_chars: int = MAX_CHARS, centroids: int = CENTROIDS, max_langs: int = MAX_LANGS) -> Model | None:
    """Train on a bounded sample, on an executor; None without training rows. More than ``max_langs`` languages are an error, none is dropped."""
    rows = sample(docs, per_lang, max_chars, max_langs)
    return train(rows, ["key", F.xxhash64("doc_id"), "doc_id"], "lang", lambda text, lang: fit_texts(text, lang, centroids))


def predict(model: Model | None, text: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether the text is rejected."""
    block = TextBlock(text, lower=True)
    low = (block.buf >= 97) & (block.buf <= 122)
    letters = block.per_doc(low) > 0
    for i in np.flatnonzero(~letters & (block.per_doc(block.buf >= 128) > 0)):
        letters[i] = any(ch.isalpha() for ch in block.buf[block.off[i] : block.off[i + 1]].tobytes().decode("utf-8", "replace"))
    if model is None:
        return ["und"] * block.n, np.zeros(block.n), ~letters
    c = counts(block)
    sim = vectors(c, model.idf) @ model.centroids.T
    by = np.stack([sim[:, model.lang_of == i].max(1) for i in range(len(model.langs))], axis=1)
    best = by.argmax(1)
    top = by[np.arange(block.n), best]
    score = 1.0 / np.exp((by - top[:, None]).astype(float) / TEMPERATURE).sum(1)
    far = 1.0 - top > np.minimum(1.0, model.limit[best] + room(c))
    return [model.langs[b] if ok else "und" for b, ok in zip(best, letters)], np.where(letters, score, 0.0), far | ~letters


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    made = map_blocks(docs, lambda text: list(predict(model, text)), ["doc_id"], fields, rows=BLOCK_TEXTS)
    return made.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows, with all their columns, that aren't rejected."""
    return filter_rows(docs, lambda text: ~predict(model, text)[2], rows=BLOCK_TEXTS)
