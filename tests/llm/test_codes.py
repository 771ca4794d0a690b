"""Phrases, vector codes and byte-level BPE against plain restatements, the library's results and awkward tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from conftest import SMALL
from test_operators import ODD, odd_rows
from test_operators import none, odd  # noqa: F401

from millrace.llm import bytebpe, phrases, veccodes
from millrace.llm.queries import QUERIES


def brute_phrases(rows, least, longest, first):
    """All phrases counted, cut and filtered, word for word as the contract says."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        often = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = {q[i : i + k] for q, b in often.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * b >= 100 * count[q[i : i + k]]}
        rows = []
        for p, a in often.items():
            if p not in inside:
                score, _, l, r = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def phrase_rows(df, **how):
    return sorted(tuple(r) for r in phrases.top(df, **how).collect())


@pytest.mark.parametrize("exact", [phrases.EXACT, 0])
def test_phrases_against_brute_force(spark, exact):
    """With the levels broadcast as hashes and as a bit map, so small here that it lets much through."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    got = phrase_rows(docs, least=8, first=300, exact=exact, bits=1 << 10)
    assert len(got) > 300 and got == brute_phrases(rows, 8, 5, 300)


def test_phrases_odd(odd, none):  # noqa: F811
    rows = [(r[2], r[1]) for r in odd_rows()]
    for least in (1, 2, 30):
        assert phrase_rows(odd, least=least) == brute_phrases(rows, least, 5, 2000)
    assert phrase_rows(none) == []


def test_phrases_of_hard_texts(spark):
    """Ties, overlaps, pieces, scripts, languages named like unknown ones, one very long text, products beyond 64 bits."""
    rng = random.Random(3)
    rows = [("und", "a a a a a"), (None, "a a a"), ("x", "É é A\ta"), ("x", "é é a a"), ("x", "a\x0bb\x0ca b\ra b"), ("y", "b. a b; a b! a"), ("y", " ".join(rng.choices("abc", k=30_000))), ("y", "漢 字 漢 字"), ("z", None), ("z", "")]
    df = spark.createDataFrame(rows, "lang string, text string")
    for least in (1, 2, 400):
        assert phrase_rows(df, least=least) == brute_phrases(rows, least, 5, 2000)
    big = spark.createDataFrame([(10**13, 10**14, 10**13, 3 * 10**11), (7, 10**14, 7, 100)], "f long, n long, l long, r long")
    assert [r.score for r in phrases._scored(big).collect()] == [1000 * 10**14 // (3 * 10**11), 1000 * 10**14 // 100]


def test_longer_phrases_stop_early(spark):
    df = spark.createDataFrame([("en", "one two. " * 5)], "lang string, text string")
    assert phrase_rows(df, least=5) == [("en", 1, "one two", 5, 5, 5, 10, 2000)]
    assert phrase_rows(df, least=6) == []


def brute_codes(rows, parts, entries, rounds, scale=1024):
    """Lloyd's rounds in Python's integers."""
    kept = [(i, label, [int(np.floor(float(v) * scale)) for v in x]) for i, x, label in rows if x and all(v is not None and np.isfinite(v) for v in x)]
    w = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    seeds = {}
    for i, _, v in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[2])):
        seeds.setdefault(i, v)
    first = [seeds[i] for i in sorted(seeds)][:entries]
    books = [[cut(v, p) for v in first] for p in range(parts)]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, _, v in kept:
                groups[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for k, some in groups.items():
                books[p][k] = [sum(c) // len(some) for c in zip(*some)]
    out = []
    for i, label, v in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    sums = Counter()
    for _, label, _, e in out:
        sums[label] += e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, code, e, sums[label], digest) for i, label, code, e in out), key=str)


def code_rows(df, **how):
    return sorted((tuple(r) for r in veccodes.digest(df, **how).collect()), key=str)


def test_codes_against_brute_force(spark):
    e = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in e.limit(120).collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    assert code_rows(df, entries=24, rounds=3) == brute_codes(rows, 4, 24, 3)


def test_codes_odd(spark):
    nan, inf = float("nan"), float("inf")
    v = lambda *x: [float(t) for t in x]
    rows = [
        (3, v(1, 2, 3, -4), 1), (3, v(1, 2, 3, -5), 1), (1, v(0, 0, 0, 0), None), (2, v(-0.0001, 0, 0, 0), None), (None, v(9, 9, 9, 9), 2), (4, None, 1), (5, [nan, 0.0, 0.0, 0.0], 1),
        (6, [0.0, -inf, 0.0, 0.0], 1), (7, [None, 0.0, 0.0, 0.0], 1), (8, v(1, 2, 3, -4), 1), (8, v(1, 2, 3, -4), 1), (9, [], 3), (10, v(1e6, -1e6, 3e5, 2.5), 4), (11, v(1e6 + 0.25, -1e6, 3e5, 2.5), 4),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, code string, error string").repartition(3)
    for entries in (1, 2, 3, 256):
        assert code_rows(df, entries=entries) == brute_codes(rows, 4, entries, 4)
    # another dimension than most, and components that the parts don't divide
    more = df.select("vec_id", "embedding", "label").union(spark.createDataFrame([(0, v(1, 2, 3), 1)], "vec_id long, embedding array<double>, label int"))
    assert code_rows(more, entries=3) == brute_codes(rows, 4, 3, 4)
    five = spark.createDataFrame([(i, v(i, 1, 2, 3, 4)) for i in range(9)], "vec_id long, embedding array<double>")
    assert veccodes.edges(5, 4) == [0, 2, 3, 4, 5] and {r.error for r in veccodes.digest(five).collect()} == {0}
    # an error beyond 64 bits
    far = spark.createDataFrame([(1, v(0, 0, 0, 0), 1), (2, v(8e12, 0, 0, 0), 1), (3, v(1, 0, 0, 0), 2)], "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: (r.error, r.label_error) for r in veccodes.digest(far, entries=1, rounds=0).collect()} == {1: (0, None), 2: (None, None), 3: (1 << 20, 1 << 20)}
    assert veccodes.digest(df.where("false")).count() == 0


@pytest.mark.parametrize("reach", [3, 2**12, 2**24, 2**27, 2**40])
def test_screening_is_exact(reach):
    """Near ties by the thousand, at sizes where float32 can't tell entries apart, and beyond what int64 holds."""
    rng = np.random.default_rng(reach)
    book = rng.integers(-reach, reach, (64, 16))
    book[32:] = book[:32] + rng.integers(-1, 2, (32, 16))
    x = book[rng.integers(0, 64, 400)] + rng.integers(-1, 2, (400, 16))
    col, dist = veccodes.nearest_entries(x, book)
    for v, c, d in zip(x.tolist(), col.tolist(), dist.tolist()):
        assert (d, c) == min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book.tolist()))


def test_codes_restore(spark):
    e = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    books = veccodes.fit(e, entries=16, rounds=2)
    for r in veccodes.decode(veccodes.encode(e, books), books).limit(20).collect():
        assert r.restored == [v for p, c in enumerate(r.codes) for v in books[p][c].tolist()]


@pytest.fixture(scope="module")
def vocabulary():
    path, pattern = bytebpe.default_vocabulary()
    with open(path, "rb") as f:
        return bytebpe.Vocabulary(f.read(), pattern)


@pytest.fixture(scope="module")
def library(vocabulary):
    _, pattern = bytebpe.default_vocabulary()
    return tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=dict(zip(vocabulary.words, vocabulary.rank)), special_tokens={})


def test_perfect_hash_is_minimal(vocabulary):
    h = vocabulary.hash
    assert sorted(h.key) == list(range(len(vocabulary.words)))
    assert h.find(vocabulary.words).tolist() == list(range(len(vocabulary.words)))
    assert bytebpe.PerfectHash([]).find([b"a"]).tolist() == [-1] and bytebpe.PerfectHash([b"a"]).find([b"b"]).tolist() == [0]
    with pytest.raises(ValueError):
        bytebpe.PerfectHash([b"a", b"a"])


def test_bpe_equals_the_library(vocabulary, library):
    rng = random.Random(7)
    bits = ["a", "b", "é", "  ", "\n", "'s", "'ll", "9", "漢", "　", "<|endoftext|>", "-", "\r\n", "aaaa", "\x1c", "\x85", "😀", "́", "zq"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(2000)] + [chr(c) + "a" + chr(c) * 3 for c in range(0, 0x11000) if not 0xD800 <= c < 0xE000]
    encoded = vocabulary.encode(texts).to_pylist()
    for t, ids in zip(texts, encoded):
        assert ids == library.encode_ordinary(t), t
    lists = pa.array([None, *encoded, []], pa.list_(pa.int32()))
    want = [None, *(t.encode() for t in texts), b""]
    assert vocabulary.decode(lists).to_pylist() == want and vocabulary.decode(lists.slice(7, 30)).to_pylist() == want[7:37]
    for bad in ([[1, None]], [[1, 60_000]], [[-1]]):
        with pytest.raises(ValueError):
            vocabulary.decode(pa.array(bad, pa.list_(pa.int32())))


def test_bpe_of_long_words(vocabulary, library):
    rng = random.Random(8)
    for t in ("a" * 300_000, "ab" * 50_000, "".join(rng.choices("abcdeé", k=100_000)), " " * 100_000, "word " * 200_000):
        assert vocabulary.encode([t]).to_pylist()[0] == library.encode_ordinary(t)


def test_bpe_forgets(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bytebpe, "REMEMBERED", 3)
    texts = [f"zqx{k}vw" for k in range(50)]
    assert vocabulary.encode(texts).to_pylist() == [library.encode_ordinary(t) for t in texts]
    assert len(vocabulary.memory) <= 3


def bpe_rows(texts, library):
    out = []
    for i, t in texts:
        ids = library.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_bpe_query(spark, odd, none, library):  # noqa: F811
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = QUERIES["op13_two_tier_byte_bpe"](spark, SMALL)
    assert sorted((tuple(r) for r in got.collect()), key=str) == bpe_rows([(r.doc_id, r.text) for r in docs.collect()], library)
    assert sorted((tuple(r) for r in bytebpe.digest(odd).collect()), key=str) == bpe_rows([r[:2] for r in odd_rows()], library)
    assert bytebpe.digest(none).count() == 0
    back = bytebpe.decode(bytebpe.encode(odd, ["doc_id", "kept"]))
    assert back.columns == ["doc_id", "kept", "decoded"] and sorted((r.decoded.decode() for r in back.collect())) == sorted(r[1] or "" for r in odd_rows())
    assert ODD.startswith("doc_id")
