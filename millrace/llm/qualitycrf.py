"""Quality classifier: a linear-chain CRF labels every line good or bad, and a text's score is the length-weighted mean of
its lines' forward-backward marginals.

Cases: null and empty texts, and texts of blank lines, have no evidence and get the score ``EMPTY_SCORE``; ties and repeated
rows score alike because a score depends on the text only; rows that repeat a doc_id count once in training, with one of their texts; extra columns pass by; an empty table gives an empty table;
without labels of both kinds every text scores 0.5."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.chain import ChainCRF
from millrace.llm.runtime import filter_rows, held_out, map_blocks, ranges
from millrace.llm.textblock import TextBlock
from millrace.llm.training import train_labelled

THRESHOLD = 0.7
EMPTY_SCORE = 0.0
#: Bounds of the training sample: texts for each label, characters in a text, lines in all.
PER_CLASS, MAX_CHARS, MAX_LINES = 1500, 20_000, 400_000
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>{}[]\\^~=@_+", np.uint8)] = True


def line_features(block: TextBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, first line of its text?, weight, text number) of every non-blank line, with its neighbours' features."""
    ls, le, ld = block.lines()
    ws, we, wd = block.words()
    lo, hi = np.searchsorted(ws, ls, "left"), np.searchsorted(ws, le, "left")
    keep = hi > lo
    ls, le, ld, lo, hi = ls[keep], le[keep], ld[keep], lo[keep], hi[keep]
    n = (hi - lo).astype(float)
    buf = block.buf

    def share(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
        return (total[le] - total[ls]) / np.maximum(ink, 1.0)

    size = (we - ws).astype(np.int64)
    total = np.concatenate(([0], np.cumsum(size)))
    ink = (total[hi] - total[lo]).astype(float)
    h = block.span_hash(ws, we)

    def words_share(flag: np.ndarray) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
        return (run[hi] - run[lo]) / n

    same = np.append(False, (h[1:] == h[:-1]) & (wd[1:] == wd[:-1]))
    last = buf[we - 1] if len(we) else np.zeros(0, np.uint8)
    head = buf[ws] if len(ws) else np.zeros(0, np.uint8)
    own = np.stack(
        [
            np.log1p(n),
            share((buf >= 65) & (buf <= 90)),
            share(_SYMBOL[buf]),
            share(buf == 33),
            share((buf >= 48) & (buf <= 57)),
            share(buf >= 128),
            np.minimum(ink / n, 40.0) / 10.0,
            words_share(same),
            words_share(_SYMBOL[last]),
            words_share((last == 33) | (last == 63)),
            words_share((last == 46) | (last == 44)),
            words_share((head >= 65) & (head <= 90)),
            words_share(size == 1),
        ],
        axis=1,
    ) if len(ls) else np.zeros((0, 13))
    first = np.append(True, ld[1:] != ld[:-1]) if len(ld) else np.zeros(0, bool)
    end = np.append(first[1:], True) if len(ld) else np.zeros(0, bool)
    before = np.where(first[:, None], own, np.roll(own, 1, axis=0)) if len(own) else own
    after = np.where(end[:, None], own, np.roll(own, -1, axis=0)) if len(own) else own
    return np.concatenate((own, before, after), axis=1), first, ink, ld


def fit_texts(text: pa.Array, y: list) -> ChainCRF | None:
    """Train on texts in the order given, block by block, up to MAX_LINES lines; each line takes its text's label. None if a label is missing."""
    if len(set(y)) < 2:
        return None
    made, n = [], 0
    for lo, hi in ranges(text):
        x, first, _, ld = line_features(TextBlock(text.slice(lo, hi - lo)))
        made.append((x.astype(np.float32), first, np.array(y[lo:hi], bool)[ld]))
        n += len(first)
        if n >= MAX_LINES:
            break
    x, first, good = (np.concatenate(part) for part in zip(*made))
    last = len(first) if n <= MAX_LINES else int(np.flatnonzero(first[: MAX_LINES + 1])[-1]) or MAX_LINES  # whole texts, if more than one fits
    return ChainCRF().fit(x[:last], good[:last], first[:last]) if good[:last].any() and not good[:last].all() else None


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> ChainCRF | None:
    """Train on a bounded sample of labelled texts, on an executor."""
    return train_labelled(docs, labels, "quality", per_class, max_chars, fit_texts)


def scores(model: ChainCRF | None, text: pa.Array) -> np.ndarray:
    """Length-weighted mean probability that a text's lines are good."""
    block = TextBlock(text)
    if model is None:
        return np.full(block.n, 0.5)
    x, first, weight, ld = line_features(block)
    p = model.predict(x, first)
    top = np.bincount(ld, p * weight, block.n)
    ink = np.bincount(ld, weight, block.n)
    return np.where(ink > 0, np.clip(top / np.maximum(ink, 1.0), 0.0, 1.0), EMPTY_SCORE)


def line_labels(model: ChainCRF, text: str) -> list[tuple[str, float]]:
    """Every non-blank line with its probability of being good."""
    block = TextBlock(pa.array([text], pa.large_string()))
    x, first, _, _ = line_features(block)
    return list(zip([s for s in text.split("\n") if s.strip(" \t\v\f\r")], model.predict(x, first).tolist()))


def score_documents(docs: DataFrame, model: ChainCRF | None, threshold: float = THRESHOLD) -> DataFrame:
    made = map_blocks(docs, lambda text: [scores(model, text)], ["doc_id"], [T.StructField("score", T.DoubleType())])
    return made.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: ChainCRF | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold; all rows if there is no model."""
    return docs if model is None else filter_rows(docs, lambda text: scores(model, text) >= threshold)
