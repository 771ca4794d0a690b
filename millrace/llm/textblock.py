"""Vectorised views of a block of texts: words, lines and 64-bit content hashes, straight from Arrow's UTF-8 buffer.

A word is a maximal run of bytes other than space and 0x09-0x0D; a line is what stands between \\n characters.
Hashes are polynomials over random byte values modulo 2**64, so any span's hash is a difference of prefix sums."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from millrace.llm.runtime import offsets

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = int(_rng.integers(1, 2**62)) * 4 + 1
BASE_INV = pow(BASE, -1, 2**64)
STEPS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer (xor-shift-multiply)."""
    x = x ^ (x >> U(31))
    x = x * U(0x9E3779B97F4A7C15)
    x = x ^ (x >> U(29))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.empty(size, U)
        have[0] = 1
        done, factor = 1, base
        while done < size:  # squares the step each time
            have[done : 2 * done] = have[:done] * U(factor)
            done, factor = 2 * done, factor * factor % 2**64
        if size <= 1 << 21:
            _powers[base] = have
    return have[:n]


class TextBlock:
    """buf: all bytes; off: where each text starts and ends; null texts are empty and flagged."""

    def __init__(self, text: pa.Array, lower: bool = False):
        off = offsets(text)
        data = text.buffers()[2] if len(text) else None
        raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
        self.off = (off - off[0]).astype(np.int64)
        self.n = len(self.off) - 1
        self.null = np.asarray(text.is_null()) if self.n else np.zeros(0, bool)
        if lower:
            raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
        self.buf = raw
        self._prefix = None

    def forget(self) -> None:
        """Let go of the prefix hashes, which take eight bytes for each byte of text."""
        self._prefix = None

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each text."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.off[1:]] - total[self.off[:-1]]

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, "right") - 1

    def space(self) -> np.ndarray:
        return (self.buf == 32) | ((self.buf >= 9) & (self.buf <= 13))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of every word."""
        ink = ~self.space()
        if not len(ink):
            z = np.zeros(0, np.int64)
            return z, z, z
        first, last = np.zeros(len(ink), bool), np.zeros(len(ink), bool)
        lo, hi = self.off[:-1], self.off[1:]
        full = hi > lo
        first[lo[full]] = True
        last[hi[full] - 1] = True
        starts = np.flatnonzero(ink & (first | ~np.concatenate(([False], ink[:-1]))))
        ends = np.flatnonzero(ink & (last | ~np.concatenate((ink[1:], [False])))) + 1
        return starts, ends, self.doc_of(starts)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of every line; an empty text has one empty line, a null text has none."""
        breaks = np.flatnonzero(self.buf == 10)
        live = np.flatnonzero(~self.null)
        starts = np.concatenate((self.off[:-1][live], breaks + 1))
        doc = np.concatenate((live, self.doc_of(breaks)))
        order = np.lexsort((starts, doc))
        starts, doc = starts[order], doc[order]
        ends = np.empty_like(starts)
        if len(starts):
            ends[:-1] = starts[1:] - 1
            last = np.append(doc[1:] != doc[:-1], True)
            ends[last] = self.off[1:][doc[last]]
        return starts, ends, doc

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self._prefix is None:
            self._prefix = np.zeros(len(self.buf) + 1, U)
            np.cumsum(BYTE_VALUE[self.buf] * _power(BASE, len(self.buf)), out=self._prefix[1:])
        back = _power(BASE_INV, max(1, len(self.buf) + 1))
        return mix((self._prefix[ends] - self._prefix[starts]) * back[starts] + (ends - starts).astype(U) * STEPS[0])


def shingles(word_hash: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words, a shorter text being one run: (hash, text number, words per text)."""
    n_words = np.bincount(doc, minlength=n_docs).astype(np.int64)
    m = len(word_hash) - size + 1
    if m > 0:
        full = np.flatnonzero(doc[: m] == doc[size - 1 :])
        h = np.zeros(len(full), U)
        for k in range(size):
            h += word_hash[full + k] * STEPS[1 + k]
        out, at = [mix(h)], [doc[full]]
    else:
        out, at = [], []
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        begin = np.cumsum(n_words) - n_words
        h = n_words[short].astype(U) * STEPS[40]
        for k in range(size - 1):
            has = n_words[short] > k
            h[has] += word_hash[begin[short[has]] + k] * STEPS[1 + k]
        out.append(mix(h))
        at.append(short)
    if not out:
        return np.zeros(0, U), np.zeros(0, np.int64), n_words
    return np.concatenate(out), np.concatenate(at), n_words


def distinct_pairs(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, key), ordered by text number then key."""
    if not len(key):
        return key, doc
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))
    return key[new], doc[new]
