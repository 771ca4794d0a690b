"""The numpy kernels against plain Python."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import chain, langid, neardup, packing, pieces, qualitycrf, qualityrules, tokencounts, toxicity, vptree
from millrace.llm.textblock import TextBlock, shingles

WORD = re.compile("[^\x20\x09-\x0d]+")
TEXTS = ["", None, "a", " \n\t ", "Ab c\x0bd\x1ce é\n\nab C", "x " * 30, "línea uno\nlínea uno\n", "one two three", "\n", "tail\r\n", "日本 語　テ", "#$ |*&", "a b c d e f g h a b c d e f g h i"]


def arr(texts):
    return pa.array(texts, pa.large_string())


@pytest.mark.parametrize("offset", [0, 3])
def test_words_and_lines(offset):
    block = TextBlock(arr(["skip"] * offset + TEXTS).slice(offset))
    s, e, d = block.words()
    raw = bytes(block.buf)
    for i, t in enumerate(TEXTS):
        assert [raw[a:b].decode() for a, b in zip(s[d == i], e[d == i])] == WORD.findall(t or "")
    ls, le, ld = block.lines()
    for i, t in enumerate(TEXTS):
        assert [raw[a:b].decode() for a, b in zip(ls[ld == i], le[ld == i])] == ([] if t is None else t.split("\n"))


def test_span_hashes_and_shingles_tell_texts_apart():
    texts = ["a b c d", "a b c d", "b c d a", "a b", "b a", "a", "", "ab", "a b c d e"]
    block = TextBlock(arr(texts))
    s, e, d = block.words()
    h, at, n = shingles(block.span_hash(s, e), d, block.n, 4)
    got = [frozenset(h[at == i].tolist()) for i in range(len(texts))]
    want = [frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else []) for w in map(str.split, texts)]
    assert [len(x) for x in got] == [len(x) for x in want]
    assert all((len(a & b) == len(c & f)) for a, c in zip(got, want) for b, f in zip(got, want))


def test_empty_blocks():
    for texts in ([], [None], [""]):
        block = TextBlock(arr(texts))
        assert len(block.words()[0]) == 0
        assert len(qualityrules.measure(arr(texts))[0]) == len(texts)
        assert len(qualitycrf.scores(None, arr(texts))) == len(texts)
        assert len(toxicity.scores(None, arr(texts))[0]) == len(texts)
        assert langid.predict(None, arr(texts))[0] == ["und"] * len(texts)
        assert neardup.text_sets(arr(texts), 4)[2] == len(texts)


def brute_base(t):
    t = t or ""
    w = WORD.findall(t)
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i : i + 8])] > 1:
            cover |= set(range(i, i + 8))
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)]


def test_base_counts():
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choices(["a", "b", "é|", "<x>\n"], k=rng.randint(0, 60))) for _ in range(60)]
    got = qualityrules.measure(arr(texts))
    assert [list(map(int, r)) for r in zip(*got[:5])] == [brute_base(t) for t in texts]
    assert np.array(got[6].to_pylist()).sum(1).tolist() == [len(WORD.findall(t or "")) for t in texts]


def test_js_distance():
    d = qualityrules.js_distance(np.array([[1.0, 0], [1, 1], [0, 0], [3, 1]]), np.array([[0, 1.0], [2, 2], [1, 1], [1, 3]]))
    a, b = (0.75, 0.25), (0.25, 0.75)
    want = math.sqrt(sum(0.5 * sum(p * math.log2(p / 0.5) for p in q) for q in (a, b)))
    assert d.tolist() == pytest.approx([1.0, 0.0, 0.0, want])


def brute_marginals(e1, first, trans, start):
    """By enumeration, text by text."""
    import itertools

    out, at = [], [i for i, f in enumerate(first) if f] + [len(first)]
    for a, b in zip(at, at[1:]):
        total, on = 0.0, np.zeros(b - a)
        for y in itertools.product((0, 1), repeat=b - a):
            s = start[y[0]] + sum(e1[a + i] * v for i, v in enumerate(y)) + sum(trans[p, q] for p, q in zip(y, y[1:]))
            total += math.exp(s)
            on += math.exp(s) * np.array(y)
        out += (on / total).tolist()
    return out


def test_chain_marginals():
    rng = np.random.default_rng(3)
    lengths = [1, 5, 9, 2, 1, 7] * 12
    first = np.concatenate([[True] + [False] * (n - 1) for n in lengths])
    e1, trans, start = rng.normal(0, 2, len(first)), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)
    p, xi = chain.marginals(e1, first, trans, start, pairs=True)
    assert p.tolist() == pytest.approx(brute_marginals(e1, first, trans, start), abs=1e-9)
    assert xi.sum() == pytest.approx((~first).sum())
    long = chain.marginals(np.full(50_000, 3.0), np.arange(50_000) == 0, trans, start)
    assert np.isfinite(long).all()


def test_sketch_estimates_similarity_and_fills():
    rng = np.random.default_rng(1)
    sizes = [1, 2, 7, 300, 0, 300]
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in sizes]
    sets[5] = np.concatenate((sets[3][:270], rng.integers(0, 2**63, 30, dtype=np.uint64)))
    h, d = np.concatenate(sets), np.repeat(np.arange(6), sizes)
    sk = neardup.sketch(h, d, 6, 125)
    assert (sk[[0, 1, 2, 3, 5]] != neardup.EMPTY).all() and (sk[4] == neardup.EMPTY).all()
    assert abs((sk[3] == sk[5]).mean() - 270 / 330) < 0.12
    again = neardup.sketch(np.concatenate((h, h[:1])), np.concatenate((d, d[:1])), 6, 125)
    assert (again == sk).all()


def test_packing_invariants():
    rng = random.Random(2)
    for n in (0, 1, 2, 300):
        sizes = sorted((rng.choice([1, 5, 900, 1024, 1025, 3000, 16384, rng.randint(1, 16384)]) for _ in range(n)), reverse=True)
        bins, offsets, final = packing.pack_lengths(sizes)
        content = Counter()
        for s, b, o in zip(sizes, bins, offsets):
            assert o == content[b]
            content[b] += s
        assert all(content[b] <= c and c in packing.CAPACITIES and not any(k < c and k >= content[b] for k in packing.CAPACITIES) for b, c in enumerate(final))
        if n == 300:
            single = min(sum(packing.cost(16384) for _ in set(packing.best_fit(sizes, (16384,))[0])), sum(packing.cost(next(c for c in packing.CAPACITIES if c >= s)) for s in sizes))
            assert sum(map(packing.cost, final)) <= single
    assert packing.best_fit([6, 5, 4, 3, 2], (10,))[0] == [0, 1, 0, 1, 1]


def searched(ids, x, qids, q, k, factor):
    """One shard of all rows, equal vectors being one point."""
    points, at = np.unique(x, axis=0, return_inverse=True)
    of = [np.sort(ids[at == k]) for k in range(len(points))]
    top = np.sqrt((points * points).sum(1)).max() * (1 + 1e-12)
    shard = vptree.Shard(vptree.Tree(vptree.lift(points, top)), points, np.concatenate(of), np.concatenate(([0], np.cumsum([len(i) for i in of]))))
    out = vptree.search_shard(shard, qids, q, k, factor, np.full(len(q), -2.0))
    return out.query_id.to_numpy(), out.vec_id.to_numpy(), out.score.to_numpy()


def test_vptree_exact_at_factor_one():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 8)) * rng.uniform(0.2, 3, (3000, 1))
    x[100:400] = x[100]
    x[5] = 0.5 * x[6]
    ids = rng.permutation(3000).astype(np.int64) * 3
    q = np.flatnonzero(ids % 20 == 0)
    qi, vi, sc = searched(ids, x, ids[q], x[q], 20, 1.0)
    score = vptree.exact_scores(np.repeat(x, len(q), 0), np.tile(x[q], (len(x), 1))).reshape(len(x), len(q))
    for k, i in enumerate(q):
        order = [j for j in np.lexsort((ids, -score[:, k])) if j != i][:20]
        assert vi[qi == ids[i]].tolist() == ids[order].tolist() and sc[qi == ids[i]].tolist() == score[order, k].tolist()
    loose = searched(ids, x, ids[q], x[q], 20, vptree.FACTOR)
    pairs = set(zip(qi.tolist(), vi.tolist()))
    assert len(pairs & set(zip(loose[0].tolist(), loose[1].tolist()))) >= 0.9 * len(pairs)
    few = searched(ids[:5], x[:5], ids[:5], x[:5], 20, 1.0)
    assert Counter(few[0].tolist()) == {int(i): 4 for i in ids[:5]}


@pytest.fixture(scope="module")
def model():
    with open(pieces.default_model(), "rb") as f:
        return pieces.Model(f.read())


def odd_texts(model, n=400):
    rng = random.Random(1)
    pool = [p.replace("▁", " ") for p in model.pieces[259:]]
    chars = [c for p in model.pieces for c in p]
    return ["", " ", "   ", "  hello   world\n\nfoo\tbar é x", "aaaaaaaaaaaaaaaa aaaa", "日本語 テキスト 🎉🎉", "function(x){return x*2;}    \r\n", "w" * 3000] + ["".join(rng.choices(pool, k=12)) for _ in range(n)] + ["".join(rng.choices(chars, k=40)) for _ in range(n)]


def test_pieces_equal_the_library(model):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=pieces.default_model())
    texts = odd_texts(model)
    made = model.encode(texts)
    assert [np.frombuffer(b, np.int32).tolist() for b in made] == sp.encode(texts)
    assert [model.decode(b) for b in made] == [t.replace("▁", " ") for t in texts]
    assert model.encode([None]) == [b""]


def as_unigram(data):
    """The same model file with trainer_spec.model_type set to unigram: the field is one varint behind its tag."""
    at = data.rfind(b"\x18\x02", 0, len(data))
    while at >= 0:
        changed = data[: at + 1] + b"\x01" + data[at + 2 :]
        if pieces._model_type(changed) == 1:
            return changed
        at = data.rfind(b"\x18\x02", 0, at)
    return None


def test_unigram_takes_the_best_sum(model):
    with open(pieces.default_model(), "rb") as f:
        data = as_unigram(f.read())
    assert data is not None
    uni = pieces.Model(data)
    assert not uni.bpe
    texts = [t for t in odd_texts(model, 40) if len(t) < 200]
    for t, b in zip(texts, uni.encode(texts)):
        assert uni.decode(b) == t.replace("▁", " ")
    score = {p: s for p, s, i in zip(uni.pieces, uni.score, range(uni.n)) if i >= 259}
    for w in ("▁hello", "▁internationalization", "aaaaaaa", "▁▁▁x"):
        best = [0.0] + [-math.inf] * len(w)
        for t in range(1, len(w) + 1):
            best[t] = max((best[t - k] + score[w[t - k : t]] for k in range(1, min(t, uni.longest) + 1) if w[t - k : t] in score), default=-math.inf)
        ids = np.frombuffer(uni.learn({w})[w], np.int32)
        assert uni.score[ids].sum() == pytest.approx(best[-1])


def test_token_length_of_long_runs():
    path, pattern = tokencounts.default_vocabulary()
    with open(path, "rb") as f:
        enc = tokencounts.encoder(f.read(), pattern)
    assert tokencounts.length(enc, None) == tokencounts.length(enc, "") == 0
    assert tokencounts.length(enc, "<|endoftext|>") > 1
    assert tokencounts.length(enc, "word " * 40_000) >= 40_000 and tokencounts.length(enc, "a" * 100_000) > 1000


def test_language_vectors():
    b = TextBlock(arr(["abc", "", "abé"]))
    c = langid.counts(b)
    assert c.sum(1).tolist() == [6, 0, 9]
    v = langid.vectors(c, np.ones(langid.DIMS, np.float32))
    assert np.linalg.norm(v, axis=1).tolist() == pytest.approx([1, 0, 1], abs=1e-5)


def test_language_needs_letters():
    m = langid.Model(["x"], np.ones(langid.DIMS, np.float32), np.ones((1, langid.DIMS), np.float32) / 64, np.array([0]), np.array([1.0]))
    lang, score, rejected = langid.predict(m, arr(["123 !?", None, "", "日本", "٣", "a1"]))
    assert lang == ["und", "und", "und", "x", "und", "x"] and score[:3].tolist() == [0, 0, 0] and rejected.tolist() == [True, True, True, False, True, False]


def test_language_of_broken_utf8():
    m = langid.Model(["x"], np.ones(langid.DIMS, np.float32), np.ones((1, langid.DIMS), np.float32) / 64, np.array([0]), np.array([1.0]))
    broken = pa.array([b"8 \xff\xfe\xc3 11", b"\xff", b"\xed\xa0\x80", b"\xff \xc3\xa9", None, b"a\xff"], pa.large_binary()).view(pa.large_string())
    lang, score, rejected = langid.predict(m, broken)
    assert lang == ["und", "und", "und", "x", "und", "x"] and score[:3].tolist() == [0, 0, 0] and rejected.tolist() == [True, True, True, False, True, False]
    assert tokencounts.strings(broken[3:]) == ["\ufffd \u00e9", None, "a\ufffd"]


def test_language_counts_of_long_texts(monkeypatch):
    """In pieces as at once, and without the memory of 64-bit numbers for each byte of a long text."""
    blocks = [TextBlock(arr(texts), lower=True) for texts in (TEXTS, ["abcdé" * 30], ["", None, "a", "bc", ""], [])]
    want = [langid.counts(b) for b in blocks]
    for step in (1, 2, 3, 7):
        monkeypatch.setattr(langid, "COUNT_BYTES", step)
        assert all((langid.counts(b) == w).all() for b, w in zip(blocks, want))
    monkeypatch.undo()
    long = TextBlock(arr(["one more word " * 600_000]))
    tracemalloc.start()
    langid.counts(long)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(long.buf)
