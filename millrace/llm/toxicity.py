"""Toxicity: a linear-chain CRF tags toxic tokens, forward-backward marginals give spans and a document score.

Token labels come from the labelled texts: a token of a toxic text is toxic if its word, or a prefix of it, is found in
toxic texts and next to never in others (a lower confidence bound of the log odds). The CRF then sees those log odds, the
neighbours' and the token's shape. A text's score is a noisy-or of all its tokens' marginals, calibrated on the training texts: each token makes
the text toxic with log odds that are a linear function of its own, so one certain token is enough and weak ones need company.

Cases: null and empty texts and texts without words score 0 and have no spans; repeated rows score alike, for a score depends on
the text only; rows that repeat a doc_id count once in training, with one of their texts; without labels of both kinds every text
scores 0; an empty table gives an empty table; extra columns pass by."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.chain import ChainCRF
from millrace.llm.runtime import held_out, map_blocks, ranges
from millrace.llm.textblock import STEPS, TextBlock, distinct_pairs, mix
from millrace.llm.training import train_labelled

THRESHOLD = 0.3
#: Bounds of the training sample: texts for each label, characters in a text, tokens in all.
PER_CLASS, MAX_CHARS, MAX_TOKENS = 2500, 20_000, 2_000_000
#: Lengths in bytes of the prefixes that count besides the word; 0 is the word.
PARTS = (0, 4, 5, 6)
#: A toxic token's word or prefix stands in so many contexts at least, however large the sample.
MIN_CONTEXTS, BOUND = 3, 1.8
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("marginal", T.DoubleType())]))
_EDGE = np.zeros(256, bool)
_EDGE[np.frombuffer(b".,;:!?\"'()[]*-_", np.uint8)] = True


@dataclass
class Model:
    keys: list[np.ndarray]  # for each part, sorted hashes
    odds: list[np.ndarray]  # and their log odds' lower bounds
    crf: ChainCRF
    slope: float = 1.0  # of the noisy-or over a text's tokens
    shift: float = 0.0


def tokens(block: TextBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words without punctuation at their edges; one that is all punctuation stays."""
    ws, we, wd = block.words()
    s, e = ws.copy(), we.copy()
    for _ in range(3):
        e -= (e - s > 1) & _EDGE[block.buf[e - 1]] if len(e) else 0
        s += (e - s > 1) & _EDGE[block.buf[s]] if len(s) else 0
    return s, e, wd


def part_hashes(block: TextBlock, s: np.ndarray, e: np.ndarray) -> list[np.ndarray]:
    return [block.span_hash(s, e if not k else np.minimum(e, s + k)) for k in PARTS]


def token_features(block: TextBlock, s, e, wd, hashes, keys, odds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, first token of its text?, strongest log odds) of every token."""
    n = len(s)
    cols = []
    for h, k, o in zip(hashes, keys, odds):
        at = np.minimum(np.searchsorted(k, h), max(len(k) - 1, 0))
        cols.append(np.where(k[at] == h, o[at], 0.0) if len(k) else np.zeros(n))
    best = np.max(cols, axis=0) if n else np.zeros(0)
    first = np.append(True, wd[1:] != wd[:-1]) if n else np.zeros(0, bool)
    last = np.append(first[1:], True) if n else np.zeros(0, bool)
    before = np.where(first, 0.0, np.roll(best, 1))
    after = np.where(last, 0.0, np.roll(best, -1))
    x = np.stack([*cols, best, before, after, np.minimum(e - s, 30) / 10.0], axis=1)
    return x, first, best


def _contexts(whole: np.ndarray, wd: np.ndarray) -> np.ndarray:
    """A hash of the words on both sides of every token."""
    first = np.append(True, wd[1:] != wd[:-1])
    left = np.where(first, np.uint64(0), np.roll(whole, 1))
    right = np.where(np.append(first[1:], True), np.uint64(0), np.roll(whole, -1))
    return mix(left * STEPS[2] + right * STEPS[3])


def _evidence(blocks: list[TextBlock], toxic: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Keys and log odds of the words and prefixes that tell toxic texts from others."""
    found: list[list[np.ndarray]] = [[] for _ in PARTS]
    contexts, marks = [], []
    for block, y in zip(blocks, toxic):
        s, e, wd = tokens(block)
        if not len(s):
            continue
        hashes = part_hashes(block, s, e)
        block.forget()
        for to, h in zip(found, hashes):
            to.append(h)
        # a word counts once in each context, or the chance words of a text that is copied over and over would pass for toxic
        contexts.append(_contexts(hashes[0], wd))
        marks.append(y[wd])
    if not contexts:
        return [np.zeros(0, np.uint64)] * len(PARTS), [np.zeros(0)] * len(PARTS)
    context, mark = np.concatenate(contexts), np.concatenate(marks)
    n1, n0 = (1.0 + sum(k.sum() for k in side) for side in (toxic, [~y for y in toxic]))
    keys, odds = [], []
    for part in found:
        k, inv = np.unique(np.concatenate(part), return_inverse=True)
        part.clear()
        t, c = (np.bincount(distinct_pairs(context[of], inv[of])[1], minlength=len(k)).astype(float) for of in (mark, ~mark))
        low = np.log((t + 0.5) / n1) - np.log((c + 0.5) / n0) - 1.5 * np.sqrt(1.0 / (t + 0.5) + 1.0 / (c + 0.5))
        use = (t >= MIN_CONTEXTS) & (low > 1.0)
        keys.append(k[use])
        odds.append(low[use])
    return keys, odds


def fit_texts(text: pa.Array, y: list) -> Model | None:
    """Train on texts in the order given, block by block, up to MAX_TOKENS tokens; None if one of the labels is missing."""
    y = np.array(y, bool)
    if not len(y) or y.all() or not y.any():
        return None
    blocks, toxic, n = [], [], 0
    for lo, hi in ranges(text):
        blocks.append(TextBlock(text.slice(lo, hi - lo), lower=True))
        toxic.append(y[lo:hi])
        n += len(tokens(blocks[-1])[0])
        if n >= MAX_TOKENS:
            break
    keys, odds = _evidence(blocks, toxic)
    xs, ys, firsts = [], [], []
    for block, label in zip(blocks, toxic):
        s, e, wd = tokens(block)
        x, first, best = token_features(block, s, e, wd, part_hashes(block, s, e), keys, odds)
        block.forget()
        # texts far apart in length weigh alike if plain tokens far from any evidence are thinned out
        near = (best > 0) | np.append(best[1:] > 0, False) | np.append(False, best[:-1] > 0) | first | (np.arange(len(best)) % 64 == 0) if len(best) else first
        xs.append(x[near].astype(np.float32))
        ys.append((label[wd] & (best > BOUND))[near])
        firsts.append(first[near])
    crf = ChainCRF(l2=1e-5, steps=200).fit(np.concatenate(xs), np.concatenate(ys), np.concatenate(firsts))
    model = Model(keys, odds, crf)
    cells = []
    for k, block in enumerate(blocks):
        _, _, wd, p = token_marginals(model, block)
        # equal log odds, to a quarter, of a text's tokens count together
        cells.append(np.column_stack((wd + sum(b.n for b in blocks[:k]), np.round(4.0 * log_odds(p)))))
        block.forget()
    cells, times = np.unique(np.concatenate(cells), axis=0, return_counts=True)
    model.slope, model.shift = noisy_or(cells[:, 1] / 4.0, cells[:, 0].astype(np.int64), times, np.concatenate(toxic))
    return model


def noisy_or(odds: np.ndarray, of: np.ndarray, times: np.ndarray, y: np.ndarray, steps: int = 400) -> tuple[float, float]:
    """(slope, shift) by maximum likelihood of a calibrated noisy-or: a token of log odds x makes its text toxic with log odds
    slope * x + shift, and some texts are labelled toxic for reasons that no token shows. ``times``: how often a token counts."""
    theta = np.array([0.0, -2.0, -4.0])  # logarithm of the slope, shift, log odds of the unexplained
    m, v = np.zeros(3), np.zeros(3)
    n = len(y)
    for i in range(1, steps + 1):
        slope, leak = np.exp(theta[0]), 1.0 / (1.0 + np.exp(-theta[2]))
        x = slope * odds + theta[1]
        chance = times / (1.0 + np.exp(-np.clip(x, -500, 500)))
        none = np.exp(-np.bincount(of, times * np.logaddexp(0.0, x), n)) * (1.0 - leak)
        none = np.clip(none, 1e-9, 1.0 - 1e-9)
        pull = np.where(y, none / (1.0 - none), -1.0)  # of the log likelihood by the sum in the exponent
        g = np.array([(pull * np.bincount(of, chance * odds, n)).sum() * slope, (pull * np.bincount(of, chance, n)).sum(), (pull * leak).sum()]) / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.05 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return float(np.exp(theta[0])), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model | None:
    """Train on a bounded sample of labelled texts, on an executor."""
    return train_labelled(docs, labels, "toxic", per_class, max_chars, fit_texts)


def token_marginals(model: Model, block: TextBlock):
    s, e, wd = tokens(block)
    x, first, _ = token_features(block, s, e, wd, part_hashes(block, s, e), model.keys, model.odds)
    return s, e, wd, model.crf.predict(x, first)


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-12, 1.0 - 1e-12)
    return np.log(p) - np.log1p(-p)


def scores(model: Model | None, text: pa.Array, at_least: float = 0.5) -> tuple[np.ndarray, pa.Array]:
    """Score of each text, and its tagged spans: runs of tokens of marginal ``at_least`` as (start, end, highest marginal), in code points."""
    block = TextBlock(text, lower=True)
    if model is None:
        return np.zeros(block.n), _span_lists(block, *(np.zeros(0, np.int64),) * 3, np.zeros(0), at_least)
    s, e, wd, p = token_marginals(model, block)
    none = np.bincount(wd, np.logaddexp(0.0, model.slope * log_odds(p) + model.shift), block.n)
    return -np.expm1(-none), _span_lists(block, s, e, wd, p, at_least)


def _span_lists(block: TextBlock, s: np.ndarray, e: np.ndarray, wd: np.ndarray, p: np.ndarray, at_least: float) -> pa.Array:
    hit = np.flatnonzero(p >= at_least)
    new = np.append(True, (np.diff(hit) > 1) | (np.diff(wd[hit]) > 0)) if len(hit) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(hit))[: len(begin)] - 1
    of = wd[hit[begin]]
    points = np.concatenate(([0], np.cumsum((block.buf & 0xC0) != 0x80)))
    at = lambda byte: points[byte] - points[block.off[:-1][of]]
    top = np.maximum.reduceat(p[hit], begin) if len(hit) else np.zeros(0)
    parts = [pa.array(at(s[hit[begin]]).astype(np.int64)), pa.array(at(e[hit[last]]).astype(np.int64)), pa.array(top)]
    off = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=block.n)))).astype(np.int32)
    return pa.ListArray.from_arrays(off, pa.StructArray.from_arrays(parts, ["start", "end", "marginal"]))


def spans(model: Model, text: str, at_least: float = 0.5) -> list[tuple[int, int, str, float]]:
    """Tagged runs of tokens of one text as (start, end, words, highest marginal), in code points."""
    found = scores(model, pa.array([text], pa.large_string()), at_least)[1][0].as_py()
    return [(x["start"], x["end"], text[x["start"] : x["end"]], x["marginal"]) for x in found]


def score_documents(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and spans, an array of (start, end, marginal) with offsets in code points, end exclusive."""
    made = map_blocks(docs, lambda text: list(scores(model, text)), ["doc_id"], [T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS)])
    return made.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
